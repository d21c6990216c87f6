"""Phrases, stems, and the search for similar names, against plain versions."""

import random
import re
import time

import pytest
from hypothesis import given, settings, strategies as st
from support import rows
from pyspark.sql import functions as F

from lodestock.ml import stems
from lodestock.operators import similarity
from lodestock.operators.name_search import Groups, Trie, bucket_links
from lodestock.plans import phrases

# Examples given with the rules of the published algorithm.
STEMS = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing
conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file
happy happi sky sky relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform
radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow inference infer
airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll generalizations gener oscillators oscil
""".split()


@pytest.mark.parametrize("word, stem", zip(STEMS[::2], STEMS[1::2]))
def test_stems(word, stem):
    assert stems.stem(word) == stem


def test_tokens_that_have_no_stem():
    assert [stems.stem(w) for w in ("is", "a", "__", "_12s", "müller", "the", "", "HOPEFUL")] == ["is", "a", "__", "_12s", "müller", "the", "", "hope"]


def test_stem_frequencies(spark):
    docs = [(1, ["hope", "hopeful", "hopes", "cat"]), (2, ["cats", "hoping", None]), (3, []), (4, None)]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    assert rows(stems.stem_counts(df, "id", "tokens"), "id", "stem") == [(1, "cat", 1), (1, "hope", 3), (2, "cat", 1), (2, "hope", 1)]
    found = {r["stem"]: (r["documents"], r["n"], round(r["weight"], 6)) for r in stems.stem_frequencies(df, "id", "tokens").collect()}
    assert found == {"cat": (2, 2, 1.510826), "hope": (2, 4, 1.510826)}


def test_stem_weights_of_the_whole_table(spark):
    from collections import Counter

    from pyspark.ml.feature import StopWordsRemover

    from lodestock.catalog import QUERIES
    from lodestock.ml import text

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(text.tokens(F.lower("text")).alias("t")).collect()
    stop, held, times = set(StopWordsRemover.loadDefaultStopWords("english")), Counter(), Counter()
    for r in docs:
        found = [stems.stem(w) for w in r["t"] if w not in stop]
        times.update(found)
        held.update(set(found))
    got = {r["stem"]: (r["documents"], r["n"]) for r in QUERIES["stem_weights"].build(spark, folder).collect()}
    assert got == {s: (held[s], times[s]) for s in held}


PHRASES = ["the", "of the", "net price", "a b a", "price", "naïve", "x_y", "..", "the"]


def plain_count(low, phrase):
    word = r"[^\W]"
    return len(re.findall(f"(?<!{word}){re.escape(phrase)}(?!{word})", low))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["the", "of", "net", "price", "a", "b", " ", " ", ".", "..", "naïve", "x_y", "_", "é"]), max_size=14))
def test_hits_are_those_of_patterns(parts):
    low = "".join(parts)
    found = phrases.hits(phrases.phrase_automaton(PHRASES), low)
    assert {PHRASES[i]: n for i, n in found.items()} == {p: n for p in PHRASES if (n := plain_count(low, p))}


def test_counts_as_columns_and_rows(spark):
    docs = [("d1", "The net price; net NET-price the_net"), ("d2", None), ("d3", "nothing"), ("d4", "of THE of the")]
    df = spark.createDataFrame(docs, "id string, t string")
    wide = phrases.phrase_counts(df, "id", "t", ["the", "net price", "of the"])
    assert wide.columns == ["id", "the", "net price", "of the", "total"]
    assert rows(wide, "id") == [("d1", 1, 1, 0, 2), ("d4", 2, 0, 2, 4)]
    assert rows(phrases.phrase_hits(df, "id", "t", ["net", "Net", "of the"]), "id", "phrase") == [("d1", "Net", 3), ("d1", "net", 3), ("d4", "of the", 2)]
    with pytest.raises(ValueError):
        phrases.phrase_automaton(["a", ""])


def test_many_phrases_cost_little_more_than_few():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    texts = [" ".join(word() for _ in range(20_000)) for _ in range(8)]
    few, many = ([f"{word()} {word()}" for _ in range(n)] for n in (10, 500))

    def seconds(listed):
        automaton, best = phrases.phrase_automaton(listed), float("inf")
        for _ in range(3):
            start = time.perf_counter()
            for t in texts:
                phrases.hits(automaton, t)
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(many) < 2.5 * seconds(few)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=9), min_size=1, max_size=25, unique=True), st.integers(0, 4))
def test_trie_links_all_that_are_near(names, reach):
    groups = Groups()
    edges = list(bucket_links(names, names, lambda _: reach, groups))
    assert all(edits(a, b) <= reach for a, b in edges) and len(edges) < len(names)
    for a in names:
        for b in names:
            if edits(a, b) <= reach:
                assert groups.find(a) == groups.find(b)


def test_a_group_that_is_linked_is_not_searched():
    names = [f"the-same-long-name-of-a-supplier-{a}{b}{c}" for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    groups = Groups()
    trie = Trie(names, groups)
    list(trie.links(names[0], 3))
    assert trie.root.uniform is not None and list(trie.links(names[100], 3)) == []


def dense(n):
    return [f"north-american-precision-fasteners-{i:04d}" for i in range(n)]


def test_edges_of_a_dense_group_grow_with_its_names(spark):
    """39-letter names within four edits of each other: at most one edge per name and task, not all pairs."""
    counts = []
    for n in (60, 240):
        names = spark.createDataFrame([(x,) for x in dense(n)], "name string")
        counts.append(similarity.long_name_edges(names, 90).count())
    assert counts[1] < 5 * counts[0]
    groups = similarity.group_similar(spark.createDataFrame([(x,) for x in dense(120)], "name string"))
    assert groups.agg(F.count_distinct("group_key")).first()[0] == 1


def test_cut_buckets_give_the_same_groups(spark, monkeypatch):
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdefgh ", k=36)) for _ in range(12)]
    names = {"".join(c if rng.random() > 0.06 else rng.choice("xyz") for c in b) for b in base for _ in range(9)} | {b.strip() for b in base}
    frame = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    whole = {r["name"]: r["group_key"] for r in similarity.group_similar(frame).collect()}
    monkeypatch.setattr(similarity._bucket_edges, "__defaults__", (4,))
    assert {r["name"]: r["group_key"] for r in similarity.group_similar(frame).collect()} == whole
    plain = sorted({n.strip() for n in names if n.strip()})
    for a in plain:
        for b in plain:
            if edits(a, b) <= max(len(a), len(b)) * 10 // 100:
                assert whole[a] == whole[b]
