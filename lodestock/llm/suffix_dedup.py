"""Dedup of byte strings of a fixed length by suffix arrays over shards.

Every byte inside a string of ``size`` bytes that also starts earlier (in a
document of smaller id, or earlier in the same one) is removed.

1. Seeds.  A string's seed is its 32-byte part of least hash.  Equal strings
   have equal seeds, so only strings whose seed occurs twice can repeat.
2. Shards.  Runs of strings with one repeated seed are cut out as segments and
   dealt to shards by seed; a seed of many segments is dealt to several.
3. Suffix arrays.  Each shard sorts the suffixes of its distinct segments by
   Larsson-Sadakane refinement in numpy and takes common prefixes of neighbours,
   compared eight bytes at a time up to ``size`` for all neighbours at once
   instead of Kasai's one-by-one loop; strings with a common prefix of ``size``
   are equal, and all but the earliest are removed.
4. Merging.  Of seeds in several shards each shard hands on the earliest of its
   equal strings; they are sorted by key ranges, and a binary search finds the
   first of equal ones.

Whole copies of an earlier document are removed without any of this.

A document is a distinct pair of id and text.  Its key ranks by id and then by
the text's digest; the places of its seeds come back by a 64-bit hash of the key.
Places of another text under the same hash only add strings that are compared for
nothing.  Joins by seed and by text deal out their hot keys.

Defined results: a null text has no bytes; null ids rank first; rows of equal id
and text are one document, so they come out alike; different texts of one id, or
without an id, are documents in the order of their digests; shorter texts than
``size`` lose nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, release
from .batches import as_bytes, blocks, id_and_text
from .hot_keys import join_heads

SIZE, SEED = 100, 32
SHARD_SEGMENTS = 6_000
HOT_SEED = 2_000
BLOCK = 1 << 20
BROADCAST_VALUES = 12_000_000
LEAST_ID = -(1 << 63)
# A run's shard is told apart up to 2^25; beyond as many shards, they grow.
BASE_BITS = 25

_RNG = np.random.default_rng(9)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _RNG.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[6]
    return x ^ (x >> np.uint64(29))


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place, by doubling."""
    out, length = _BYTE[data], 1
    for level in range(5):
        out = out[: len(out) - length] * _ODD[level] + out[length:]
        length *= 2
    return _mixed(out)


def least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of its first least one."""
    places, length = np.arange(len(hashes), dtype=np.int32), 1

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(hashes[b] < hashes[a], b, a)

    while 2 * length <= width:
        places = better(places[:-length], places[length:])
        length *= 2
    rest = width - length
    return better(places[: len(places) - rest], places[rest:]) if rest else places


def strings_of(texts: list[bytes], size: int):
    """Starts of all strings of ``size`` in the joined texts, their seed places, hashes and text numbers."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < size:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64), empty, ends - lengths
    hashes = seed_hashes(data)
    places = least_places(hashes, size - SEED + 1)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(places)]
    starts = np.flatnonzero(np.arange(len(places)) + size <= ends[owner])
    return starts, places[starts].astype(np.int64), hashes, owner[starts], ends - lengths


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the text's ``digest``, and the 25 bytes of ``doc``: whether an id is there, id, digest."""
    out = docs.withColumn("digest", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256))
    ranked = F.lpad(F.hex(F.col("doc_id").bitwiseXOR(F.lit(LEAST_ID))), 16, "0")
    head = F.when(F.col("doc_id").isNull(), F.lit("00" * 9)).otherwise(F.concat(F.lit("01"), ranked))
    return out.withColumn("doc", F.unhex(F.concat(head, F.substring("digest", 1, 32))))


def _id_of(doc: bytes) -> int | None:
    return int.from_bytes(doc[1:9]) + LEAST_ID if doc[0] else None


def _seed_rows(docs: DataFrame, size: int) -> DataFrame:
    """Every seed of every document: the first of the strings that have it at one place, and how many they are.

    Strings with their seed at one place follow each other, so this is all that
    later steps need; the texts are hashed once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            rows = block.column("row").to_numpy()
            starts, places, hashes, owners, firsts = strings_of([t or b"" for t in as_bytes(block.column("text"))], size)
            if not len(starts):
                continue
            edge = np.flatnonzero(np.r_[True, (np.diff(places) != 0) | (np.diff(owners) != 0) | (np.diff(starts) != 1)])
            owners = owners[edge]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[places[edge]].view(np.int64)),
                    pa.array(rows[owners]),
                    pa.array((starts[edge] - firsts[owners]).astype(np.int32)),
                    pa.array(np.diff(np.r_[edge, len(starts)]).astype(np.int32)),
                ],
                names=["seed", "row", "start", "strings"],
            )

    return docs.select("text", "row").mapInArrow(run, "seed long, row long, start int, strings int")


def _segments(docs: DataFrame, size: int, shards: int) -> DataFrame:
    """Runs of strings that share a repeated seed, dealt to shards."""
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            rows = []
            entries = block.column("entries")
            ends, flat = np.diff(entries.offsets.to_numpy()), entries.flatten().to_numpy()
            fields = ((flat >> 33 & 0x7FFFFFFF), (flat >> 26 & 127), (flat >> 1 & (1 << BASE_BITS) - 1) % shards, flat & 1 == 1)
            runs = iter(zip(*(f.tolist() for f in fields), strict=True))
            for text, doc, n in zip(as_bytes(block.column("text")), block.column("doc").to_pylist(), ends.tolist(), strict=True):
                length = len(text)
                for start, strings, shard, spread in islice(runs, n):
                    end = start + strings - 1 + size
                    if end <= length:  # not so only for another text of the same row hash
                        rows.append((shard, doc, start, spread, text[start:end]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["shard", "doc", "start", "spread", "bytes"],
                )

    return docs.mapInArrow(run, "shard long, doc binary, start int, spread boolean, bytes binary")


def suffix_order(data: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of their suffixes' first ``depth`` bytes; a suffix stops at its segment's end.

    Larsson-Sadakane: places with equal keys form a group numbered by its last
    row; each round doubles the compared length by sorting only the groups of
    two or more by the group numbers that far ahead.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    keys = np.zeros(n, np.uint64)
    for j in range(8):
        inside = np.arange(n) + j < ends
        keys = (keys << np.uint64(8)) | np.where(inside, padded[j : j + n], 0).astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    fresh = np.r_[True, keys[order][1:] != keys[order][:-1]]
    group = np.empty(n, np.int64)
    rows = np.arange(n)
    length = 8

    def number(at: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Last row of the group of each row of ``at``; ``new`` marks where groups begin."""
        heads = np.flatnonzero(new)
        lasts = np.r_[heads[1:], len(at)] - 1
        group[order[at]] = np.repeat(at[lasts], np.diff(np.r_[heads, len(at)]))
        sizes = np.repeat(np.diff(np.r_[heads, len(at)]), np.diff(np.r_[heads, len(at)]))
        return at[sizes > 1]

    open_rows = number(rows, fresh)
    while length < depth and len(open_rows):
        places = order[open_rows]
        ahead = places + length
        ok = ahead < ends[places]
        after = np.where(ok, group[np.minimum(ahead, n - 1)] + 1, 0)
        own = group[places]
        inner = np.lexsort((after, own))
        order[open_rows] = places[inner]
        own, after = own[inner], after[inner]
        new = np.r_[True, (own[1:] != own[:-1]) | (after[1:] != after[:-1])]
        open_rows = number(open_rows, new)
        length *= 2
    return order


def equal_strings(data: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Class numbers of sorted string places: neighbours with a common prefix of ``size`` share one."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data),), np.dtype("<u8"), padded.tobytes(), 0, (1,))
    a, b = places[:-1], places[1:]
    same = np.ones(len(a), bool)
    for at in [*range(0, size - 8, 8), size - 8]:
        left = np.flatnonzero(same)
        same[left] = words[a[left] + at] == words[b[left] + at]
    return np.cumsum(np.r_[0, ~same])


REMOVED = "doc binary, start int, end int, string binary"


def _shard(table: pa.Table, size: int) -> pa.Table:
    """Removed runs of one shard, and earliest strings of seeds that other shards also have."""
    keys = table.column("doc").to_pylist()
    names = sorted(set(keys))
    ranks = {k: i for i, k in enumerate(names)}
    docs = np.array([ranks[k] for k in keys], np.int64)
    starts = table.column("start").to_numpy().astype(np.int64)
    bodies = table.column("bytes").to_pylist()
    spread = table.column("spread").to_numpy(zero_copy_only=False)
    order = np.lexsort((starts, docs))
    copied: list[int] = []
    first: dict[bytes, int] = {}
    for i in order.tolist():
        j = first.setdefault(bodies[i], i)
        if (docs[i], starts[i]) != (docs[j], starts[j]):  # a copy of an earlier segment: all of it goes
            copied.append(i)
    rows = np.array(list(first.values()))
    lengths = np.array([len(bodies[i]) for i in rows])
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(bodies[i] for i in rows), np.uint8)
    owner = np.repeat(np.arange(len(rows)), lengths)
    places = suffix_order(data, ends[owner], size)
    places = places[places + size <= ends[owner[places]]]
    classes = equal_strings(data, places, size)
    seg = rows[owner[places]]
    doc, start = docs[seg], starts[seg] + places - (ends - lengths)[owner[places]]
    by = np.lexsort((start, doc, classes))
    head = np.r_[True, np.diff(classes[by]) != 0]
    lead = np.repeat(np.flatnonzero(head), np.diff(np.r_[np.flatnonzero(head), len(by)]))
    later = (doc[by] != doc[by[lead]]) | (start[by] != start[by[lead]])
    gone = by[later]
    sizes = np.array([len(bodies[i]) for i in copied], np.int64)
    out_doc, out_start, out_end = joined_runs(
        np.r_[docs[copied], doc[gone]], np.r_[starts[copied], start[gone]], np.r_[starts[copied] + sizes, start[gone] + size]
    )
    # Earliest strings of seeds that other shards have too.
    heads = by[head & spread[seg[by]]]
    strings = [None] * len(out_doc) + [data[p : p + size].tobytes() for p in places[heads].tolist()]
    return pa.table(
        {
            "doc": pa.array(names, pa.binary()).take(pa.array(np.r_[out_doc, doc[heads]])),
            "start": pa.array(np.r_[out_start, start[heads]].astype(np.int32)),
            "end": pa.array(np.r_[out_end, start[heads] + size].astype(np.int32)),
            "string": pa.array(strings, pa.binary()),
        }
    )


def joined_runs(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (document, start, end) that overlap or touch, as one each."""
    if not len(docs):
        return docs, starts, ends
    order = np.lexsort((starts, docs))
    docs, starts, ends = docs[order], starts[order], ends[order]
    base = docs * (int(ends.max()) + 1)  # so that the running maximum begins anew in each document
    reach = np.maximum.accumulate(base + ends)
    head = np.r_[True, (docs[1:] != docs[:-1]) | (base[1:] + starts[1:] > reach[:-1])]
    at = np.flatnonzero(head)
    last = np.r_[at[1:], len(docs)] - 1
    return docs[at], starts[at], (reach - base)[last]


def _merged(heads: DataFrame) -> DataFrame:
    """Strings that are not the first of their equals over all shards."""
    ranged = heads.repartitionByRange("string").sortWithinPartitions("string", "doc", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            strings = np.array(batch.column("string").to_pylist(), object)
            docs, starts = batch.column("doc").to_pylist(), batch.column("start").to_pylist()
            lead = np.searchsorted(strings, strings, side="left")
            gone = []
            for i, j in enumerate(lead.tolist()):
                if held is None or held[0] != strings[j]:
                    held = (strings[j], docs[j], starts[j])
                if (docs[i], starts[i]) != held[1:]:
                    gone.append(i)
            yield batch.select(["doc", "start", "end"]).take(pa.array(gone, pa.int64()))

    return ranged.mapInArrow(run, "doc binary, start int, end int")


def _to_texts(docs: DataFrame, side: DataFrame, values: str, on: str) -> DataFrame:
    """``docs`` left-joined with per-document arrays: broadcast if they are few, else the texts are shuffled."""
    size = side.agg(F.sum(F.size(values) + 4)).first()[0] or 0
    return docs.join(F.broadcast(side) if size <= BROADCAST_VALUES else side, on, "left")


def _runs(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(pairs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def _joined_runs(removed: DataFrame) -> DataFrame:
    """Per document, with its id, the maximal runs as a flat array of starts and ends."""
    per = removed.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [[x for r in _runs([(p["start"], p["end"]) for p in found]) for x in r] for found in batch.column("runs").to_pylist()]
            ids = pa.array(map(_id_of, batch.column("doc").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), ids, pa.array(flat, pa.list_(pa.int32()))], names=["doc", "doc_id", "runs"])

    return per.mapInArrow(run, "doc binary, doc_id long, runs array<int>")


def removed_runs(docs: DataFrame, size: int = SIZE, shard_segments: int = SHARD_SEGMENTS, hot_seed: int = HOT_SEED) -> tuple[DataFrame, DataFrame]:
    """For (doc_id, text): documents that copy an earlier one whole, and removed byte runs of others."""
    if not SEED < size < SEED + 127:
        raise ValueError(f"strings must have {SEED + 1} to {SEED + 126} bytes")
    long = _keyed(docs.filter(F.octet_length("text") >= size))
    bare = F.max(F.col("doc_id").isNull())
    heads = long.groupBy("digest").agg(
        F.min("doc_id").alias("head"), F.max("doc_id").alias("tail"), bare.alias("bare"), F.count(F.lit(1)).alias("n")
    )
    heads = cut_lineage(heads.filter("head < tail or bare and tail is not null"))
    copies = join_heads(long.select("doc_id", "digest", "doc"), heads, ["digest"], "n", ["doc"])
    copies = cut_lineage(copies.filter("doc_id > head or bare and doc_id is not null").select("doc").distinct())
    few = copies.count() <= 1_000_000
    alone = long.join(F.broadcast(copies) if few else copies, "doc", "left_anti")
    alone = alone.select("doc", "text", F.xxhash64("doc").alias("row"))
    seeds = cut_lineage(_seed_rows(alone, size))
    often = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    often = cut_lineage(often.select("seed", F.ceil(F.col("n") / hot_seed).cast("int").alias("parts"), "n"))
    total = often.agg(F.sum("n")).first()[0] or 0
    shards = min(max(1, -(-total // shard_segments)), 1 << BASE_BITS)
    found = join_heads(seeds, often, ["seed"], "n", ["row", "start"])
    # One number per run: its start, its strings, the shard's number, and whether the seed is in several shards.
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("row", "start"), F.col("parts"))).otherwise(F.lit(0))
    base = F.pmod(F.xxhash64("seed", part), F.lit(1 << BASE_BITS))
    low = F.shiftleft(F.col("strings").cast("long"), 26).bitwiseOR(F.shiftleft(base, 1)).bitwiseOR((F.col("parts") > 1).cast("long"))
    entry = F.shiftleft(F.col("start").cast("long"), 33).bitwiseOR(low)
    places = cut_lineage(found.select("row", entry.alias("entry")).groupBy("row").agg(F.collect_list("entry").alias("entries")))
    release(seeds)
    segments = _segments(_to_texts(alone, places, "entries", "row").filter("entries is not null"), size, shards)
    results = cut_lineage(segments.groupBy("shard").applyInArrow(lambda t: _shard(t, size), REMOVED))
    release(heads, often, places)
    merged = _merged(results.filter("string is not null"))
    runs = cut_lineage(_joined_runs(results.filter("string is null").select("doc", "start", "end").unionByName(merged)))
    release(results)
    return copies, runs


def remove_repeats(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``kept`` (the bytes left), and ``removed`` (byte runs)."""
    named = id_and_text(docs, key, text)
    copies, runs = removed_runs(named, size)
    whole = copies.withColumn("whole", F.lit(True))
    few = whole.count() <= 1_000_000
    joined = _to_texts(_keyed(named), runs.drop("doc_id"), "runs", "doc").join(F.broadcast(whole) if few else whole, "doc", "left")
    long = F.octet_length("text") >= size
    joined = joined.withColumn("whole", F.coalesce(F.col("whole") & long, F.lit(False)))
    joined = joined.withColumn("runs", F.when(F.col("whole"), F.array(F.lit(0), F.octet_length("text"))).otherwise(F.col("runs")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = []
            ids, bodies = block.column("doc_id").to_pylist(), as_bytes(block.column("text"))
            for doc, body, flat in zip(ids, bodies, block.column("runs").to_pylist(), strict=True):
                body, flat = body or b"", flat or []
                spans = [(a, min(b, len(body))) for a, b in zip(flat[::2], flat[1::2], strict=True)]
                edges = [0, *(x for s in spans for x in s), len(body)]
                kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((doc, len(body), kept, [{"start": a, "end": b} for a, b in spans]))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            columns = zip(*rows, strict=True) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "kept", "removed"]
            )

    schema = "doc_id long, n_bytes long, kept binary, removed array<struct<start:int,end:int>>"
    return joined.select("doc_id", "text", "runs").mapInArrow(run, schema)
