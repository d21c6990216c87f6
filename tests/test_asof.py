"""As-of joins against a plain look-up, over blocks that cut keys."""

import random

import pytest
from support import rows

from lodestock.operators.asof import as_of_join, fill_as_of


def plain(left, right, strict):
    out = {}
    for number, key, time in left:
        known = [(t, v) for k, t, v in right if None not in (key, time, t) and k == key and (t < time or not strict and t == time)]
        out[number] = max(known)[1] if known else None
    return out


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("blocks", [1, 13])
def test_one_hot_key_over_many_blocks(spark, strict, blocks):
    rng = random.Random(blocks)
    keys = ["hot"] * 8 + ["b", "c", None]
    left = [(i, rng.choice(keys), rng.choice([None, *range(60)])) for i in range(500)]
    right = [(rng.choice(keys), rng.choice([None, *range(60)]), rng.randint(0, 9)) for _ in range(200)]
    frames = spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, t int, v int")
    got = as_of_join(*frames, ["k"], "t", "t", ["v"], strict=strict, blocks=blocks)
    assert got.columns == ["id", "k", "t", "v"]
    assert {r["id"]: r["v"] for r in got.collect()} == plain(left, right, strict) and got.count() == len(left)


def test_few_records_far_back(spark):
    """The last record may lie many blocks before the rows that need it."""
    left = spark.createDataFrame([(i, "k", i) for i in range(100, 600)], "id int, k string, t int")
    right = spark.createDataFrame([("k", 5, "old"), ("k", 300, "new"), ("other", 400, "x")], "k string, t int, v string")
    got = {r["id"]: r["v"] for r in as_of_join(left, right, ["k"], "t", "t", ["v"], blocks=20).collect()}
    assert got == {i: "old" if i <= 300 else "new" for i in range(100, 600)}


def test_ties_repeats_and_names(spark):
    left = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, "a", 5)], "`row id` int, k string, t int")
    right = spark.createDataFrame([("a", 4, 1, "x"), ("a", 4, 3, "y"), ("a", 4, 2, "z"), ("a", 4, 3, None)], "k string, t int, o int, t2 string")
    got = as_of_join(left, right, ["k"], "t", "t", ["t2", "o"], tie=["o"], prefix="last_")
    assert got.columns == ["row id", "k", "t", "last_t2", "last_o"]
    assert rows(got) == [(1, "a", 5, "y", 3), (1, "a", 5, "y", 3), (2, "a", 5, "y", 3)] or sorted(rows(got)) == [(1, "a", 5, "y", 3)] * 2 + [(2, "a", 5, "y", 3)]
    assert as_of_join(left, right.limit(0), ["k"], "t", "t", ["o"]).filter("o IS NULL").count() == 3
    assert as_of_join(left.limit(0), right, ["k"], "t", "t", ["o"]).count() == 0


def test_filled_from_what_was_known_then(spark):
    data = [("S", "2024-01-01", None), ("S", "2024-02-01", "id1"), ("S", "2024-03-01", None), ("S", "2024-04-01", "id2"), ("S", "2024-04-01", None), ("S", "2024-05-01", None)]
    df = spark.createDataFrame(data, "name string, day string, id string")
    got = sorted(rows(fill_as_of(df, df, ["name"], "id", "day", "day")), key=str)
    wanted = [(n, d, {"2024-01-01": None, "2024-03-01": "id1", "2024-05-01": "id2"}.get(d, v) if (v is None and d != "2024-04-01") else v or "id1") for n, d, v in data]
    assert got == sorted(wanted, key=str)
