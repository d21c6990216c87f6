"""Exact dedup against plain grouping, and the index with insertion, deletion and growth."""

from hashlib import sha256

import brute
import pytest
from hypothesis import given, settings, strategies as st

from lodestock.llm import exact_dedup
from lodestock.llm.cuckoo import SLOTS, CuckooIndex
from lodestock.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ODD = [
    (1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "same text "), (9, "x" * 50_000),
    (9, "X" * 50_000), (10, "twice"), (10, "twice"), (None, "same text"), (None, "no id"), (None, "NO ID"), (-5, "low"), (-(1 << 63), "Low"),
    (None, "low"),
]


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=str)


def key(i: int) -> bytes:
    return sha256(str(i).encode()).digest()


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert by_key(QUERIES["op12_exact_dedup"](spark, FOLDER).collect()) == by_key(brute.exact_groups(docs))


@pytest.mark.parametrize("hot", [1, 4096])
def test_odd_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", hot)  # with 1, no group is hot
    frame = spark.createDataFrame([(*r, "own") for r in ODD], "doc_id long, text string, keep_id string")
    assert by_key(exact_dedup.mark_copies(frame).collect()) == by_key(brute.exact_groups(ODD))
    assert exact_dedup.mark_copies(frame.limit(0)).count() == 0
    left = exact_dedup.drop_copies(frame)
    assert left.columns == frame.columns
    kept = [r[:2] for r in zip(*zip(*ODD)) if False] or [(r["doc_id"], r["text"]) for r in left.collect()]
    groups = {}
    for doc, text in ODD:
        groups.setdefault((text or "").translate(brute.LOWER), []).append(doc)
    tops = sorted((max(ids, key=lambda d: (d is not None, d or 0)) for ids in groups.values()), key=str)
    assert sorted((doc for doc, _ in kept), key=str) == tops
    assert {r["keep_id"] for r in left.collect()} == {"own"}


def test_index_holds_what_is_live():
    index = CuckooIndex(1)
    for i in range(5000):
        index.insert(key(i), i)
    assert index.buckets > 1 and index.live == 5000 == sum(map(bool, index.marks))
    assert all(index.values[index.find(key(i))] == i for i in range(5000)) and index.find(key(5001)) == -1
    assert [index.delete(key(i)) for i in range(0, 5000, 2)] == list(range(0, 5000, 2)) and index.delete(key(0)) is None
    assert [index.find(key(i)) >= 0 for i in range(6)] == [False, True] * 3 and index.live == 2500
    index.insert(key(0), "again")
    assert dict(index.items())[key(0)] == "again" and len(dict(index.items())) == 2501


def test_marks_that_agree_are_told_apart():
    """Equal first ten bytes: the same mark and buckets, more of them than the two buckets hold."""
    alike = [key(7)[:10] + bytes([i]) * 22 for i in range(2 * SLOTS)]
    index = CuckooIndex()
    for i, k in enumerate(alike):
        index.insert(k, i)
    assert [index.values[index.find(k)] for k in alike] == list(range(2 * SLOTS))
    assert index.find(key(7)) == -1 and index.delete(alike[3]) == 3 and index.find(alike[4]) >= 0 and index.find(alike[3]) == -1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 40)), max_size=300))
def test_index_behaves_as_a_dictionary(steps):
    index, plain = CuckooIndex(1), {}
    for add, i in steps:
        if not add:
            assert index.delete(key(i)) == plain.pop(i, None)
        elif i in plain:
            assert index.values[index.find(key(i))] == plain[i]
        else:
            index.insert(key(i), i * 3)
            plain[i] = i * 3
        assert index.live == len(plain)
    assert dict(index.items()) == {key(i): v for i, v in plain.items()}


def live(index):
    return {r["_digest"]: (r["_keep"], r["_size"]) for r in exact_dedup.live_texts(index).collect()}


def test_index_over_batches(spark):
    """Later documents add to live texts, withdrawn texts leave, and come back as new."""
    frame = lambda rows: exact_dedup.digest_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    a, b, c = (sha256(t).digest() for t in (b"a", b"b", b"c"))
    first = exact_dedup.build_index(frame([(1, "a"), (2, "A"), (3, "b"), (None, "c")]), shard_texts=2)
    assert live(first) == {a: (2, 2), b: (3, 1), c: (None, 1)}
    second = exact_dedup.update_index(first, frame([(9, "a"), (1, "B"), (4, "c")]), frame([(77, "B")]))
    assert live(second) == {a: (9, 3), b: (1, 1), c: (4, 2)}
    third = exact_dedup.update_index(second, withdrawn=frame([(None, "a"), (0, "unknown")]))
    assert live(third) == {b: (1, 1), c: (4, 2)}
    assert live(exact_dedup.update_index(third, added=frame([(5, "a")])))[a] == (5, 1)


def test_folds_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FOLD_ROWS", 2)
    docs = [(i, f"t{i % 7}") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert by_key(exact_dedup.mark_copies(frame).collect()) == by_key(brute.exact_groups(docs))
