"""Whitening against numpy on the whole table, and odd vectors."""

import math

import numpy as np
import pytest

from lodestock.llm import whitening
from lodestock.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, components=8):
    """Per row: id and deviation; and whitened rows, shares of the components."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(components, int((values > len(values) * np.finfo(float).eps * values[0]).sum()))
    return deviation, centred @ basis[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check(rows, vectors):
    """One row per vector and component, equal to numpy's but for one sign per component."""
    deviation, whitened, shares = plain(vectors)
    wanted = sorted((v[0] is not None, v[0] or 0, c + 1, deviation[i]) for i, v in enumerate(vectors) for c in range(len(shares)))
    assert sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["component"], r["deviation"]) for r in rows) == wanted
    assert {r["n"] for r in rows} == {len(vectors)} and {r["identity_error"] for r in rows if r["identity_error"] > 1e-9} == set()
    for c in range(len(shares)):
        ours = sorted((str(r["vec_id"]), r["whitened"]) for r in rows if r["component"] == c + 1)
        got = np.array([z for _, z in ours])
        theirs = [np.array([z for _, z in sorted((str(v[0]), s * w) for v, w in zip(vectors, whitened[:, c]))]) for s in (1, -1)]
        assert min(np.abs(got - t).max() for t in theirs) < 1e-6
        shown = {r["explained"] for r in rows if r["component"] == c + 1}
        assert len(shown) == 1 and shown.pop() == pytest.approx(shares[c], rel=1e-9)


def test_whole_table(spark):
    vectors = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op13_embedding_whitening"](spark, FOLDER).collect(), vectors)


def test_several_blocks_each_way(spark, monkeypatch):
    """Blocks of a few rows and columns, so every product meets blocks in both dimensions."""
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 5)
    rng = np.random.default_rng(4)
    vectors = [(i, [float(np.float32(a)) for a in rng.normal(size=12) * np.arange(1, 13)]) for i in range(150)]
    frame = spark.createDataFrame(vectors, SCHEMA).repartition(7)
    check(whitening.whiten(frame).collect(), vectors)


def test_odd_vectors(spark):
    rng = np.random.default_rng(6)
    good = [(i % 30 if i % 9 else None, [float(np.float32(a)) for a in rng.normal(size=4) * [1, 2, 3, 4]]) for i in range(40)]
    odd = [
        (100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 2.0, 3.0]), (104, [1.0, 2.0, 3.0]),
        (105, [float("inf"), 0.0, 0.0, 0.0]), (106, [0.0, 0.0, float("-inf"), 0.0]), (107, [1.0] * 5),
    ]
    frame = spark.createDataFrame([(*r, "own", 1) for r in good + good[:3] + odd], f"{SCHEMA}, component string, row int")
    check(whitening.whiten(frame).collect(), good + good[:3])


def test_few_dimensions_and_no_spread(spark):
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]  # one direction only
    found = whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 20 and found[0]["explained"] == pytest.approx(1)
    check(found, line)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.limit(1)).count() == 0
    empty = whitening.whiten(same.limit(0))
    assert empty.count() == 0 and empty.columns == found[0].__fields__
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0


def test_deviations_beyond_a_long_are_null(spark):
    vectors = [(i, [float(1 << 40) * (i % 2), float(i)]) for i in range(6)]
    found = whitening.whiten(spark.createDataFrame(vectors, SCHEMA)).collect()
    assert {r["deviation"] for r in found} == {None} and {r["n"] for r in found} == {6}
    huge = whitening.whiten(spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])], SCHEMA)).collect()
    # Integers end at the ends of a long; the middle row stays exact.
    assert {r["deviation"] for r in huge} == {None, 100001**2 + 3072**2}


def test_rows_are_numbered_without_gaps(spark):
    frame = spark.createDataFrame([(i, [float(i)]) for i in range(50)], SCHEMA).repartition(6)
    rows = whitening.integer_rows(frame.filter("vec_id % 3 > 0"))
    assert sorted(r["row"] for r in rows.collect()) == list(range(rows.count()))
