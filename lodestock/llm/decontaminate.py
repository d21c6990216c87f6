"""Benchmark decontamination by word windows.

A document word is hit when it lies inside an occurrence of any window of a
benchmark item.  The windows are broadcast as a hash set of bounded size; a
larger benchmark is taken in parts, one pass over the documents for each.

Defined results: a null or wordless text has no words, no hits and stays; a
null or wordless item has no windows; items with a null id contaminate but are
not listed; equal windows of several items list all of them; repeated documents
are judged alike; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from .batches import add_columns, as_bytes, in_own_columns, without

WINDOW = 13
# Of benchmark text in one index, which takes about six times as much.
MAX_BROADCAST_BYTES = 32 << 20
# A-Z become a-z; other ASCII but digits and letters parts words.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SEPARATOR = b"\x01"

FINDINGS = ("n_words", "n_hit", "hit_runs", "hit_items")
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return (text or b"").translate(WORD_BYTES).split()


class WindowIndex:
    """Windows of benchmark items, found in arrays of word numbers.

    Items lie end to end in one array; a window is its place there, so the index
    is a few numbers for each benchmark word.  A window is looked up by a
    polynomial hash of its word numbers and then compared word by word.
    """

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.names = sorted({item for item, _ in items if item is not None})
        numbers = {name: i for i, name in enumerate(self.names)}
        self.lookup: dict[bytes, int] = {}
        runs, found, at = [], {}, 0
        for item, text in items:
            ids = [self.lookup.setdefault(w, len(self.lookup) + 1) for w in words_of(text)]
            if ids:
                length = min(window, len(ids))
                starts = np.arange(at, at + len(ids) - length + 1)
                found.setdefault(length, []).append((starts, np.full(len(starts), numbers.get(item, -1), np.int32)))
                runs.append(np.array(ids, np.int32))
                at += len(ids)
        self.lookup[SEPARATOR] = -1
        self.ids = np.concatenate([np.empty(0, np.int32), *runs])
        groups = [(n, *map(np.concatenate, zip(*found[n], strict=True))) for n in sorted(found)]
        self.factor, self.by_length = 0x9E3779B97F4A7C15, None
        while self.by_length is None:  # a factor under which no two windows share a hash
            tables = [self._table(*group) for group in groups]
            if None in tables:
                self.factor += 2
            else:
                self.by_length = tables

    def _table(self, length: int, starts: np.ndarray, owners: np.ndarray):
        """Distinct windows by hash, with a place and a slice of owners each; None if two share a hash."""
        hashes = self.hashes(self.ids, starts, length)
        order = np.lexsort((owners, hashes))
        hashes, starts, owners = hashes[order], starts[order], owners[order]
        fresh = np.r_[True, hashes[1:] != hashes[:-1]]
        heads, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        first = starts[heads][group]
        if any((self.ids[starts + j] != self.ids[first + j]).any() for j in range(length)):
            return None
        listed = (owners >= 0) & (fresh | np.r_[True, owners[1:] != owners[:-1]])
        edges = np.searchsorted(group[listed], np.arange(len(heads) + 1))
        return length, hashes[heads], starts[heads], owners[listed], edges

    def hashes(self, ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        factor, out = np.uint64(self.factor), np.zeros(len(starts), np.uint64)
        for j in range(length):
            out = out * factor + ids[starts + j].astype(np.uint64)
        return out

    def find(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """Word counts, merged hit runs of words, and item ids of each text."""
        glue = b" " + SEPARATOR + b" "
        flat = glue.join([(t or b"").translate(WORD_BYTES) for t in texts]) + glue
        get = self.lookup.get
        words = flat.split()
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        ends = np.flatnonzero(ids == -1)
        begins = np.concatenate([[0], ends[:-1] + 1])
        runs: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        edge = np.zeros(len(ids) + 1, np.int64)
        for length, hashes, places, owners, edges in self.by_length:
            if len(ids) < length:
                continue
            starts = np.flatnonzero(known[length:] - known[:-length] == length)
            wanted = self.hashes(ids, starts, length)
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            same = hashes[at] == wanted
            starts, at = starts[same], at[same]
            if len(starts):
                along = np.arange(length)
                same = (ids[starts[:, None] + along] == self.ids[places[at][:, None] + along]).all(axis=1)
                starts, at = starts[same], at[same]
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + length, -1)
            met = np.unique(np.stack([np.searchsorted(ends, starts), at], axis=1), axis=0)
            for doc, window in met.tolist():
                items[doc].update(self.names[i] for i in owners[edges[window] : edges[window + 1]])
        hit = np.concatenate([[0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]])
        change = np.flatnonzero(np.diff(hit))
        for start, end in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            doc = int(np.searchsorted(ends, start))
            runs[doc].append((start - int(begins[doc]), end - int(begins[doc])))
        return ends - begins, runs, items


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_runs`` (word positions) and ``hit_items``."""
    source = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("string").alias("body"))
    size = source.agg(F.sum(F.octet_length("body") + 16)).first()[0] or 0
    parts = max(1, -(-size // max_broadcast_bytes))
    context = docs.sparkSession.sparkContext
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_runs", SPANS),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
    out = without(docs, [*FINDINGS, "_runs", "_items"])
    for part in range(parts):
        rows = source.filter(F.pmod(F.xxhash64("item", "body"), F.lit(parts)) == part).collect()
        index = context.broadcast(WindowIndex([(r[0], (r[1] or "").encode()) for r in rows], window))
        first = part == 0

        def make(block, index=index, first=first):
            count, runs, items = index.value.find(as_bytes(block.column(text)))
            if not first:
                for i, (old, names) in enumerate(
                    zip(block.column("_runs").to_pylist(), block.column("_items").to_pylist(), strict=True)
                ):
                    runs[i] = _merged(runs[i] + [(r["start"], r["end"]) for r in old])
                    items[i].update(names)
            return [
                count,
                [sum(e - s for s, e in r) for r in runs],
                [[{"start": s, "end": e} for s, e in r] for r in runs],
                [sorted(x) for x in items],
            ]

        if not first:
            out = cut_lineage(out).withColumnsRenamed({"hit_runs": "_runs", "hit_items": "_items"})
        out = add_columns(out, text, fields, make)
        out = out.drop("_runs", "_items")
    return out


def contaminated(least_share: float = 0.05):
    """Whether so large a share of a document's words is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") >= F.lit(least_share) * F.col("n_words"))


def _cut_words(text: str, runs: list[dict]) -> str:
    places = [m.span() for m in WORD.finditer(text.translate(LOWER))]  # numbered as words_of does; offsets stay
    kept, at = [], 0
    for run in runs:
        kept.append(text[at : places[run["start"]][0]])
        at = places[run["end"] - 1][1]
    return "".join([*kept, text[at:]])


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, how: str = "documents", least_share: float = 0.05, text: str = "text", **options
) -> DataFrame:
    """``docs`` in its own columns, without contaminated documents, or without the hit words.

    Columns of ``docs`` that are named like a finding keep their own values.
    ``how="documents"`` drops documents of which ``least_share`` of the words or
    more are hit; ``how="spans"`` keeps every document and cuts each hit run of
    words out of its text, with what stands between those words.
    """
    if how not in ("documents", "spans"):
        raise ValueError(f"how must be 'documents' or 'spans', not {how!r}")

    def clean(block):
        return [
            [
                _cut_words(t, r) if r else t
                for t, r in zip(block.column(text).to_pylist(), block.column("hit_runs").to_pylist(), strict=True)
            ]
        ]

    def work(own: DataFrame) -> DataFrame:
        found = find_contamination(own, benchmark, text=text, **options)
        if how == "documents":
            return found.filter(~contaminated(least_share))
        cut = add_columns(found, text, [T.StructField("_clean", T.StringType())], clean)
        return cut.withColumn(text, F.col("_clean"))

    return in_own_columns(docs, [*FINDINGS, "_runs", "_items", "_clean"], work)
