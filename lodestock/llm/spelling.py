"""Groups of spelling variants, found by a bidirectional FM-index.

Words are counted over all texts.  Two words are near if one inserted, deleted
or replaced code point makes them equal.  Then one of the halves of the first is
whole in the second, at the same end: the search matches that half exactly and
extends across the other, allowing one error (see ``fm_index``).

The vocabulary is dealt to index shards by what a search matches exactly: a word
of length ``l`` lies at its first ``(l - 1) // 2`` and at its last ``l // 2`` code
points, the least that any search for it can match, and a search goes to those
places for its three target lengths.  So no word is compared with the whole
vocabulary.  A class of words with the same half that outgrows a shard is cut in
parts, and so are the searches for it: every part of the words meets every part
of the searches, each in a task of its own.  At most ``8 V / SHARD_WORDS``
classes of a vocabulary of V words are that large; only those are broadcast.

Pairs that share the left half are left to the search over the reversed words,
so each pair comes once and a shard returns one row per word: the number of near
words and the best one.  A word has no more near words than one edit can make.

A word's form is its near word of largest count, at least twice its own.  Counts
rise along forms, so they make a forest; roots are handed down level by level.
The join is by form, which no more words share than are near it.

Defined results: null and empty texts have no words; a null id counts as an
empty one in the checksum; rows of equal id are counted each; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, release
from .batches import as_bytes, blocks, id_and_text
from .fm_index import WordIndex, code_points

SHARD_WORDS = 50_000
HELD_WORDS = 400_000
DROP_EACH = 97
MIN_LENGTH, MIN_COUNT = 5, 3
FORM_FACTOR = 2

# The letters a-z and U+00C0 to U+00FF, the latter two bytes in UTF-8.
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
ASCII_RUNS = bytes(c if 97 <= c <= 122 else 32 for c in range(256))
FOUND = "word string, n long, near long, best_n long, best string"


def runs_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters of a UTF-8 text, A-Z in lower case."""
    low = text.lower()  # of bytes: A-Z only
    return low.translate(ASCII_RUNS).split() if low.isascii() else RUN.findall(low)


def without_letter(run: bytes, checksum: int) -> bytes:
    """The run without the code point that the checksum names."""
    plain = run.decode()
    at = checksum % len(plain)
    return (plain[:at] + plain[at + 1 :]).encode()


def document_words(doc_id: int | None, text: bytes, min_length: int = MIN_LENGTH) -> Counter[bytes]:
    """Counts of a document's words; words too short to matter may be left out."""
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    out: Counter[bytes] = Counter()
    for run, times in Counter(runs_of(text)).items():
        if len(run) >= min_length:
            checksum = zlib.crc32(run, start)
            out[run if checksum % DROP_EACH else without_letter(run, checksum)] += times
    return out


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and its occurrences ``n`` in all texts.

    A task adds its documents up before the shuffle, holding a bounded number of words.
    """

    def rows(held: Counter[bytes]) -> pa.RecordBatch:
        words, counts = pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())
        return pa.RecordBatch.from_arrays([words, counts], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for block in blocks(batches, "text"):
            for doc, body in zip(block.column(0).to_pylist(), as_bytes(block.column(1)), strict=True):
                if body:
                    for word, times in document_words(doc, body, min_length).items():
                        held[word] += times
                    if len(held) > HELD_WORDS:
                        yield rows(held)
                        held = Counter()
        yield rows(held)

    counted = id_and_text(docs, key, text).mapInArrow(run, "word string, n long").filter(F.length("word") >= min_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _entries(words: DataFrame) -> DataFrame:
    """Places of every word, and of every search for its near words.

    ``change`` is null for a place; for a search it is the length of the words
    looked for, less the word's own.  Side 0 goes by the first letters, side 1 by
    the last ones.
    """
    sized = words.withColumn("_l", F.length("word"))
    rows = []
    for change in (None, -1, 0, 1):
        there = F.col("_l") + (change or 0)
        for side in (0, 1):
            half = F.substring("word", F.lit(1), F.floor((there - 1) / 2).cast("int"))
            if side:
                half = F.expr(f"right(word, (_l + {change or 0}) div 2)")
            rows.append(
                F.struct(
                    F.lit(side).alias("side"),
                    F.lit(change).cast("int").alias("change"),
                    F.xxhash64(F.lit(side), there, half).alias("class"),
                )
            )
    return sized.select("word", "n", F.inline(F.array(*rows)))


CELL = ["shard", "class", "_row", "_column"]


def _cells(entries: DataFrame, shards: int, most: int) -> DataFrame:
    """Entries with the cell that they go to.

    Classes share shards; a large one has cells of its own, one for each part of
    its words and each part of its searches, so that no pair meets twice.
    """
    searches = F.col("change").isNotNull()
    classes = entries.groupBy("class").agg(
        F.ceil(F.count_if(~searches) / most).cast("int").alias("_words"), F.ceil(F.count_if(searches) / most).cast("int").alias("_asks")
    )
    large = cut_lineage(classes.filter("_words > 1 OR _asks > 1"))
    parts = entries.join(F.broadcast(large), "class", "left")
    alone = F.col("_words").isNull()
    words, asks = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("_words", "_asks"))
    own = lambda n: F.pmod(F.xxhash64("word"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    row = F.when(searches, every(words)).otherwise(F.array(own(words)))
    column = F.when(searches, F.array(own(asks))).otherwise(every(asks))
    spread = parts.withColumn("_row", F.explode(row)).withColumn("_column", F.explode(column))
    return spread.select(
        F.when(alone, F.pmod("class", F.lit(shards))).otherwise(-1).alias("shard"),
        F.when(alone, 0).otherwise(F.col("class")).alias("class"),
        "_row", "_column", "side", "change", "word", "n",
    )


def _search(words: list[str], counts: np.ndarray, asked: list[str], changes: np.ndarray, side: int):
    """For each search of one side: how many words are near, the largest count, and the first word of it."""
    turned = [w[::-1] for w in words] if side == 0 else words
    index = WordIndex(turned)
    lengths = np.array([len(w) for w in asked])
    order = np.lexsort((changes, lengths))
    edges = np.flatnonzero(np.r_[True, (np.diff(lengths[order]) != 0) | (np.diff(changes[order]) != 0)])
    # Ranks by count, then by the word: the least is the best.
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))] = np.arange(len(words))
    near, best = np.zeros(len(asked), np.int64), np.full(len(asked), len(words), np.int64)
    for begin, end in zip(edges, [*edges[1:], len(order)], strict=True):
        rows = order[begin:end]
        length, change = int(lengths[rows[0]]), int(changes[rows[0]])
        half = length // 2
        points, _ = code_points([asked[i][::-1] if side == 0 else asked[i] for i in rows])
        codes = index.codes(points).reshape(len(rows), length)
        query, word = index.one_error(codes, half if side == 0 else length - half, change)
        if side == 1 and len(query):
            # Those that share the left half come from the other side.
            same = np.ones(len(query), bool)
            for i in range(half):
                same &= index.flat[index.starts[word] + i] == codes[query, i]
            query, word = query[~same], word[~same]
        np.add.at(near, rows[query], 1)
        np.minimum.at(best, rows[query], rank[word])
    return near, best, np.argsort(rank)


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``words`` (word, n) with ``n_near``, and the near word of largest count as ``best`` and ``best_n``."""
    words = cut_lineage(words.select("word", "n"))
    cores = words.sparkSession.sparkContext.defaultParallelism
    entries = _entries(words)
    shards = max(cores, -(-2 * words.count() // shard_words))

    def run(table: pa.Table) -> pa.Table:
        out = []
        for side in (0, 1):
            part = table.filter(pa.compute.equal(table["side"], side))
            there = part.filter(pa.compute.is_null(part["change"]))
            asked = part.filter(pa.compute.is_valid(part["change"]))
            if not there.num_rows or not asked.num_rows:
                continue
            names, counts = there["word"].to_pylist(), there["n"].to_numpy()
            near, best, by_rank = _search(names, counts, asked["word"].to_pylist(), asked["change"].to_numpy(), side)
            hit = np.flatnonzero(near)
            chosen = by_rank[best[hit]]
            asked = asked.take(pa.array(hit))
            out.append(
                pa.table(
                    [
                        asked["word"], asked["n"], pa.array(near[hit]),
                        pa.array(counts[chosen]), pa.array([names[i] for i in chosen], pa.string()),
                    ],
                    names=["word", "n", "near", "best_n", "best"],
                )
            )
        if not out:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())], names=["word", "n", "near", "best_n", "best"])
        return pa.concat_tables(out)

    found = _cells(entries, shards, shard_words).groupBy(*CELL).applyInArrow(run, FOUND)
    none = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    top = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    both = none.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), top.alias("_top"))
    return both.select("word", "n", "n_near", F.col("_top.word").alias("best"), (-F.col("_top.less")).alias("best_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form and others) with ``root``, the last word along the forms."""
    waiting = cut_lineage(forms.filter(F.col("form").isNotNull()))
    level = cut_lineage(forms.filter(F.col("form").isNull()).withColumn("root", F.col("word")))
    done = []
    while not level.isEmpty():
        done.append(level)
        above = level.select(F.col("word").alias("_above"), "root")
        level = cut_lineage(waiting.join(above, F.col("form") == F.col("_above")).drop("_above"))
    if not done:
        return level
    release(level, waiting)
    return reduce(DataFrame.unionByName, done)


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, factor: int = FORM_FACTOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every word with its form and root, counts, and number of near words."""
    near = near_words(word_counts(docs, min_length, min_count), shard_words)
    has = F.col("best_n") >= factor * F.col("n")
    formed = near.select(
        "word", F.when(has, F.col("best")).alias("form"), "n", "n_near", F.when(has, F.col("best_n")).alias("form_n")
    )
    return with_roots(cut_lineage(formed)).select("word", "form", "root", "n", "n_near", "form_n")
