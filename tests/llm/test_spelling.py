"""Spelling variants against all pairs, and the index behind them."""

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lodestock.llm import spelling
from lodestock.llm.fm_index import WordIndex, code_points, sorted_rotations
from lodestock.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert by_key(QUERIES["op11_spelling_variants"](spark, FOLDER).collect()) == by_key(brute.spelling(docs))


def test_rotations_are_sorted():
    rng = np.random.default_rng(2)
    for text in ([0, 1], [1, 1, 2, 0, 1, 0], rng.integers(0, 3, 90).tolist() + [9]):
        turned = [text[i:] + text[:i] for i in range(len(text))]
        assert sorted_rotations(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: turned[i])


WORDS = st.lists(st.text("abcé", min_size=4, max_size=9), min_size=1, max_size=40, unique=True)


@settings(max_examples=60, deadline=None)
@given(WORDS)
def test_searches_find_each_near_word_once(words):
    """Both sides of the scheme together, over all words as one shard."""
    counts = np.arange(len(words)) * 7 % 5 + 1
    near = np.zeros(len(words), int)
    best = [(0, "")] * len(words)
    for side in (0, 1):
        for change in (-1, 0, 1):
            n, top, order = spelling._search(words, counts, words, np.full(len(words), change), side)
            near += n
            for i in np.flatnonzero(n):
                j = order[top[i]]
                best[i] = min(best[i], (-counts[j], words[j]))
    plain = [[v for v in words if brute.one_edit_apart(w, v)] for w in words]
    assert near.tolist() == [len(p) for p in plain]
    all_counts = dict(zip(words, counts, strict=True))
    assert best == [min([(-all_counts[v], v) for v in p], default=(0, "")) for p in plain]


def test_wide_and_narrow_intervals_branch_alike():
    words = [a + b + "xyz" for a in "abcdefgh" for b in "abcdefgh"]
    index = WordIndex(words)
    whole = (np.array([0]), np.array([0]), np.array([index.words]))
    states = index.extend(whole, np.array([index.codes(code_points(["z"])[0])[0]]))
    found = index.branch(states)  # 64 ranks, more than the alphabet has letters
    assert len(found[0]) == 1 and found[2][0] - found[1][0] == 64
    queries = index.codes(code_points(["abxyz"])[0]).reshape(1, 5)
    _, hits = index.one_error(queries, 3, 0)
    assert sorted(words[i] for i in hits) == sorted(w for w in words if brute.one_edit_apart("abxyz", w))


def test_small_shards_give_the_same(spark):
    """Classes larger than a shard: parts of the words meet parts of the searches."""
    words = [(f"common{a}{b}", 10 * i + j) for i, a in enumerate("abcdefghij") for j, b in enumerate("klmnopqrst")]
    words += [(f"{a}{b}common", 7) for a in "abcd" for b in "klmn"] + [("commonk", 500), ("lonely", 3)]
    frame = spark.createDataFrame([(w, n + 3) for w, n in words], "word string, n long")
    plain = by_key(spelling.near_words(frame).collect())
    assert plain == by_key(spelling.near_words(frame, shard_words=7).collect())
    near = {r[0]: r[2] for r in plain}
    assert near["commonak"] == 19 and near["commonk"] == 10 and near["lonely"] == 0


HARD = [
    (1, "Colour colour COLOUR colour color"), (2, "colour color colors colors colors"), (3, None), (4, ""), (5, " \n\t"),
    (6, "Ünïcode ünïcode Ünïcode ünïcöde"), (6, "Ünïcode ünïcode Ünïcode ünïcöde"), (7, "×÷×÷× ×÷×÷× ×÷×÷× ĀĀĀĀĀ"),
    (None, "colour colour colour flavour"), (None, "colour colour colour flavour"), (8, "a" * 3000 + " " + "a" * 3001),
    (9, "a" * 3000 + " " + "a" * 3001), (9, "a" * 3000 + " " + "a" * 3001 + " flavour\x00flavor"), (10, "short shor shor shor 日本日本日本 shortly"),
]


def test_odd_rows(spark):
    frame = spark.createDataFrame([(*r, "own") for r in HARD], "doc_id long, text string, word string")
    assert by_key(spelling.variants(frame).collect()) == by_key(brute.spelling(HARD))
    assert spelling.variants(frame.limit(0)).count() == 0
    assert spelling.variants(frame.filter("text IS NULL")).count() == 0


def test_deleted_letters_are_found(spark):
    """The contract's own slips: a run whose checksum 97 divides loses a letter in that document."""
    docs = [(i, "Bücherregal wandschrank") for i in range(800)]
    rows = by_key(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), min_count=1).collect())
    assert rows == by_key(brute.spelling(docs, min_count=1)) and {r[2] for r in rows} == {"Bücherregal".lower(), "wandschrank"}


def test_roots_follow_forms(spark):
    rows = [("w0", None), ("w1", "w0"), ("w2", "w1"), ("w3", "w2"), ("v", "w0"), ("alone", None)]
    found = spelling.with_roots(spark.createDataFrame(rows, "word string, form string")).select("word", "root").collect()
    assert sorted(map(tuple, found)) == [("alone", "alone"), ("v", "w0"), *[(f"w{i}", "w0") for i in range(4)]]


def test_counts_in_small_holds(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    docs = spark.createDataFrame(HARD[:3] * 4, "doc_id long, text string")
    assert sorted(map(tuple, spelling.word_counts(docs).collect())) == sorted((r[0], r[3]) for r in brute.spelling(HARD[:3] * 4))


@pytest.mark.parametrize("run", ["abcde", "àbçdé", "ééééé"])
def test_letters_go_by_code_point(run):
    for h in range(97 * 7):
        at = h % len(run)
        assert spelling.without_letter(run.encode(), h).decode() == run[:at] + run[at + 1 :]


def test_cells_hold_no_more_than_a_shard(spark):
    """One class of 500 words: four parts, each met by all parts of its searches."""
    names = [f"stem{i:04d}".translate({48 + d: 97 + d for d in range(10)}) for i in range(500)]
    entries = spelling._entries(spark.createDataFrame([(w, 3) for w in names], "word string, n long"))
    assert entries.count() == 8 * 500
    cells = spelling._cells(entries, 4, 150).filter("shard = -1 AND side = 0").groupBy(*spelling.CELL)
    sizes = cells.agg(F.count_if(F.col("change").isNull()).alias("places")).collect()
    assert sum(r["places"] for r in sizes) >= 500 and max(r["places"] for r in sizes) < 200
