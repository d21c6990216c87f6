"""Exact dedup by an index of live text digests, sharded by digest.

Texts are equal when identical after lower-casing A-Z only.  Every text becomes
a SHA-256 digest; the first bytes of the digest name its shard.  A shard is one
cuckoo filter (see ``cuckoo``) whose slots keep the digests, so a hit of a mark
is verified against the content of its bucket, and a filter that overflows is
rebuilt at twice the size from the digests stored.

A live digest carries the row that stays and the number of its rows.  A row of
larger id that hits takes the place of the one that stayed: the old entry is
deleted and the new one inserted.  ``update_index`` adds later documents to an
index and takes withdrawn texts out of it.

Tasks fold equal digests of a block before the shuffle, so a text that a third of
all rows hold reaches its shard as one row per block.  The verdicts go back by
digest: texts that hold more than a 4096th of all rows are at most 4096, so those
verdicts are broadcast; the others meet their rows in a shuffle.

Defined results: a null text counts as empty, and empty texts are equal; null
ids rank below all others; of rows of equal id and text one stays, so repeated
rows are dropped; extra columns stay, unless named like a computed one; an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .batches import as_bytes, blocks, in_own_columns, without
from .cuckoo import KEY_BYTES, SLOTS, CuckooIndex

SHARD_TEXTS = 100_000
FOLD_ROWS = 1 << 16
HOT_SHARE = 4096
COMPUTED = ["keep_id", "group_size", "kept", "text_sha256"]
OWN = ["_row", "_doc", "_digest", "_keep", "_keep_row", "_size"]
LOWEST = -(1 << 63)  # stands for a null id, which ranks below; only compared, never returned

FOLDED = "shard int, digest binary, n long, doc long, no_id boolean, row long, gone boolean"
INDEX = "shard int, shards int, buckets int, marks binary, keys binary, n binary, doc binary, no_id binary, row binary"
FIELDS = (("n", "<i8"), ("doc", "<i8"), ("no_id", "?"), ("row", "<i8"))


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", carried: list[str] | None = None) -> DataFrame:
    """Row number, id and digest of every row, written once so that the numbers stand.

    ``carried`` names columns to take along.
    """
    carried = carried or []
    plain = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).cast("long").alias("_doc"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_digest"),
        *[F.col(f"`{c}`") for c in carried],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_digest"):
            found = pa.array([sha256(t.lower()).digest() for t in as_bytes(block.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([*block.columns[:2], found, *block.columns[3:]], names=block.schema.names)

    ddl = plain.withColumn("_digest", F.col("_digest").cast("binary")).schema
    return cut_lineage(plain.mapInArrow(run, ddl))


def _folded(rows: DataFrame, shards: int, gone: bool = False) -> DataFrame:
    """One row per digest and block of ``digest_rows``, with the largest (id, row number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        for batch in batches:
            for row, doc, digest in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                rank = (doc is not None, LOWEST if doc is None else doc, row)
                known = held.get(digest)
                if known is None:
                    held[digest] = [1, rank]
                else:
                    known[0] += 1
                    known[1] = max(known[1], rank)
            if len(held) >= FOLD_ROWS:
                yield made(held)
                held = {}
        yield made(held)

    def made(held: dict[bytes, list]) -> pa.RecordBatch:
        tops = [v[1] for v in held.values()]
        columns = [
            pa.array([int.from_bytes(d[-4:], "little") % shards for d in held], pa.int32()),
            pa.array(list(held), pa.binary()),
            pa.array([v[0] for v in held.values()], pa.int64()),
            pa.array([t[1] for t in tops], pa.int64()),
            pa.array([not t[0] for t in tops], pa.bool_()),
            pa.array([t[2] for t in tops], pa.int64()),
            pa.array([gone] * len(held), pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "digest", "n", "doc", "no_id", "row", "gone"])

    return rows.select("_row", "_doc", "_digest").mapInArrow(run, FOLDED)


def _load(state: pa.Table) -> CuckooIndex:
    """The filter of a shard's row, slot by slot."""
    index = CuckooIndex()
    for row in state.to_pylist():
        index._clear(row["buckets"])
        index.marks.frombytes(row["marks"])
        del index.marks[: SLOTS * row["buckets"]]
        parts = [np.frombuffer(row[name], kind) for name, kind in FIELDS]
        for slot in np.flatnonzero(np.frombuffer(index.marks, np.uint16)):
            index.keys[slot] = row["keys"][KEY_BYTES * slot : KEY_BYTES * (slot + 1)]
            n, doc, no_id, number = (p[slot] for p in parts)
            index.values[slot] = (int(n), (not no_id, int(doc), int(number)))
            index.live += 1
    return index


def _store(index: CuckooIndex, shard: int, shards: int) -> pa.Table:
    blank = bytes(KEY_BYTES)
    values = [v or (0, (True, 0, 0)) for v in index.values]
    columns = {
        "n": np.array([v[0] for v in values], "<i8"),
        "doc": np.array([v[1][1] for v in values], "<i8"),
        "no_id": np.array([not v[1][0] for v in values], "?"),
        "row": np.array([v[1][2] for v in values], "<i8"),
    }
    row = {
        "shard": shard, "shards": shards, "buckets": index.buckets, "marks": index.marks.tobytes(),
        "keys": b"".join(k or blank for k in index.keys), **{name: x.tobytes() for name, x in columns.items()},
    }
    ints = {"shard": pa.int32(), "shards": pa.int32(), "buckets": pa.int32()}
    return pa.table([pa.array([row[f.strip().split()[0]]], ints.get(f.strip().split()[0], pa.binary())) for f in INDEX.split(",")], names=[f.strip().split()[0] for f in INDEX.split(",")])


def apply_changes(index: CuckooIndex, changes: list[dict]) -> CuckooIndex:
    """Withdrawn texts leave; rows of a live text add to it, a row of larger id becomes the one that stays."""
    for c in changes:
        if c["gone"]:
            index.delete(c["digest"])
    for c in changes:
        if c["gone"]:
            continue
        rank = (not c["no_id"], c["doc"], c["row"])
        slot = index.find(c["digest"])
        if slot < 0:
            index.insert(c["digest"], (c["n"], rank))
        elif rank > index.values[slot][1]:
            n, _ = index.delete(c["digest"])
            index.insert(c["digest"], (n + c["n"], rank))
        else:
            n, stays = index.values[slot]
            index.values[slot] = (n + c["n"], stays)
    return index


def build_index(rows: DataFrame, shard_texts: int = SHARD_TEXTS) -> DataFrame:
    """An index of the ``digest_rows``: one row per shard."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(cores, -(-rows.count() // shard_texts))
    empty = rows.sparkSession.createDataFrame([], INDEX)
    return _changed(empty, _folded(rows, shards), shards)


def update_index(index: DataFrame, added: DataFrame | None = None, withdrawn: DataFrame | None = None) -> DataFrame:
    """The index after texts have been withdrawn and others added, both ``digest_rows``.

    A withdrawn text leaves with all its rows; a later copy of it counts as new.
    """
    shards = index.agg(F.max("shards")).first()[0]
    if shards is None:
        raise ValueError("the index has no shards; build one")
    parts = [_folded(rows, shards, gone) for rows, gone in ((added, False), (withdrawn, True)) if rows is not None]
    return _changed(index, parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), shards)


def _changed(index: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    def run(state: pa.Table, rows: pa.Table) -> pa.Table:
        shard = (rows if rows.num_rows else state)["shard"][0].as_py()
        return _store(apply_changes(_load(state), rows.to_pylist()), shard, shards)

    return cut_lineage(index.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(run, INDEX))


def live_texts(index: DataFrame, least: int = 1) -> DataFrame:
    """Digest, row that stays and number of rows of each live text of ``least`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = [(k, *v) for k, v in _load(pa.Table.from_batches([batch.slice(i, 1)])).items() if v[0] >= least]
                columns = [
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[2][1] if f[2][0] else None for f in found], pa.int64()),
                    pa.array([f[2][2] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["_digest", "_keep", "_keep_row", "_size"])

    return index.mapInArrow(run, "_digest binary, _keep long, _keep_row long, _size long")


def _marked(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``digest_rows`` with what the index says of their texts."""
    groups = cut_lineage(live_texts(index, 2))
    hot = groups.filter(F.col("_size") * HOT_SHARE > rows.count())
    hot_digests = F.broadcast(hot.select("_digest"))
    common = rows.join(F.broadcast(hot), "_digest")
    rest = rows.join(hot_digests, "_digest", "left_anti")
    cold = groups.join(hot_digests, "_digest", "left_anti")
    marked = rest.join(cold, "_digest", "left").unionByName(common)
    alone = F.col("_size").isNull()
    return marked.select(
        "*",
        F.when(alone, F.col("_doc")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("_row") == F.col("_keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", carried: list[str] | None = None, shard_texts: int = SHARD_TEXTS) -> DataFrame:
    """The ``carried`` columns (the id alone by default) of every row with its group and verdict."""
    carried = [key] if carried is None else carried
    docs = without(docs, [c for c in COMPUTED + OWN if c not in (key, text)])
    kept = [c for c in carried if c in docs.columns]
    rows = digest_rows(docs, key, text, kept)
    return _marked(rows, build_index(rows, shard_texts)).select(*[F.col(f"`{c}`") for c in kept], *COMPUTED)


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_texts: int = SHARD_TEXTS) -> DataFrame:
    """``docs`` without the copies of texts of larger id."""

    def work(own: DataFrame) -> DataFrame:
        return mark_copies(own, key, text, own.columns, shard_texts).filter("kept")

    return in_own_columns(docs, COMPUTED + OWN, work)
