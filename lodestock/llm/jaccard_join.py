"""Similarity join of documents on word shingles, and its connected components.

Method: every document's distinct shingles are put in one global order, rare
ones first; two sets with the wanted Jaccard similarity then share a shingle
among the first few of each (the prefix).  Prefix entries meet by shingle, pairs
pass length, positional and suffix filters, and each pair left is verified once
on the whole sets.

The order comes from a table of fixed size with shingle frequencies by hash,
counted over all documents; any one order gives the same links, frequencies only
keep buckets small.  The suffix filter compares how many shingles two sets have
in each of 64 hash classes, which bounds their difference from below.

Groups of copies.  Equal sets are linked by their digest.  In a bucket all
members are first compared with one pivot, the member whose prefix is most
frequent, for two rounds; then the remaining
members of different components are joined with each other.  A group of copies
hangs together after its pivots, so its pairs are never listed, and no pair of
different components is left out.

Defined results: a text without words has no shingles and no links; null ids
have no links and a null component; rows of equal id are one node that has the
links of each of its texts; ties in pivots go to the smaller id; extra columns
stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.similarity import connected_components
from ..session import cut_lineage, known_size, release
from .batches import as_bytes, blocks, id_and_text, in_own_columns

CLASSES = 64
TABLE_BITS = 18
TABLE_CHUNK = 4096
STAR_ROUNDS = 2
BROADCAST_IDS = 1_000_000
KEPT_WORDS = 200_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit word hashes, filled on demand."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; a shorter text is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_HASHES) > KEPT_WORDS:
        _HASHES.clear()
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(ids))
    out = np.full(len(ids) - size + 1, size, np.uint64)
    for j in range(size):
        out = (out ^ (out >> np.uint64(29))) * FACTOR + ids[j : j + len(out)]
    out = (out ^ (out >> np.uint64(32))) * FACTOR
    return np.unique(out ^ (out >> np.uint64(29)))


def _over_texts(docs: DataFrame, schema: str, rows, types: list[pa.DataType]) -> DataFrame:
    """``rows(doc_id, text)`` of every document, as a table."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            columns = [np.concatenate(c) if isinstance(c[0], np.ndarray) else [x for y in c for x in y]
                       for c in zip(*map(rows, block.column("doc_id").to_pylist(), as_bytes(block.column("text"))), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.mapInArrow(run, schema)


def profiles(docs: DataFrame, size: int) -> DataFrame:
    """Set size, digest and class counts of each row."""

    def row(doc, body):
        found = shingle_set(body, size)
        classes = np.bincount((found & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)
        return [doc], [len(found)], [xxhash.xxh3_128_digest(found.tobytes())], [classes.tolist()]

    return _over_texts(
        docs, "doc_id long, n long, digest binary, classes array<int>", row,
        [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())],
    )


def frequency_table(docs: DataFrame, size: int) -> np.ndarray:
    """How many sets have a shingle in each of 2^18 hash places; a fixed 1 MB.

    Each task sends its table in chunks; chunks are summed by groups of tasks
    and then over the groups.
    """
    places, shift = 1 << TABLE_BITS, np.uint64(64 - TABLE_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.zeros(places, np.int64)
        for block in blocks(batches, "text"):
            found = [shingle_set(t, size) for t in as_bytes(block.column("text"))]
            table += np.bincount((np.concatenate(found) >> shift).astype(np.int64), minlength=places)
        if table.any():
            parts = [c.tobytes() for c in np.split(table, places // TABLE_CHUNK)]
            team = [TaskContext.get().partitionId() // 64] * len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array(team, pa.int32()), pa.array(parts, pa.binary())],
                names=["chunk", "team", "counts"],
            )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in group.column("counts").to_pylist())
        return group.slice(0, 1).set_column(2, "counts", pa.array([total.tobytes()], pa.binary()))

    schema = "chunk int, team int, counts binary"
    rows = docs.mapInArrow(count, schema).groupBy("chunk", "team").applyInArrow(add, schema)
    out = np.zeros(places, np.int64)
    for r in rows.groupBy("chunk").applyInArrow(add, schema).collect():
        out[r["chunk"] * TABLE_CHUNK : (r["chunk"] + 1) * TABLE_CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def prefix_entries(docs: DataFrame, size: int, percent: int, table: np.ndarray) -> DataFrame:
    """Rarest shingles of each set, with the set's size, their place in its order, and a score.

    The score is the mean frequency of the set's prefix: of a group of copies it
    is highest for the one with fewest shingles of its own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)
    shift = np.uint64(64 - TABLE_BITS)

    def row(doc, body):
        found = shingle_set(body, size)
        n = len(found)
        length = n - (percent * n + 99) // 100 + 1 if n and doc is not None else 0
        often = shared.value[(found >> shift).astype(np.int64)]
        order = np.lexsort((found, often))[:length]
        ids = np.full(length, doc if length else 0, np.int64)
        score = int(often[order].sum()) // max(1, length)
        return (
            found[order].view(np.int64),
            ids,
            np.full(length, n, np.int32),
            np.arange(length, dtype=np.int32),
            np.full(length, min(score, 1 << 30), np.int32),
        )

    return _over_texts(
        docs,
        "shingle long, doc long, n int, place int, score int",
        row,
        [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()],
    )


def least_overlap(n: Column, m: Column, percent: int) -> Column:
    """Shared shingles that sets of these sizes need."""
    return F.ceil((n + m) * percent / F.lit(100 + percent) - F.lit(1e-9))


def _may_match(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Length and positional filters; a pair passes at its first shared prefix shingle."""
    lengths = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return lengths & (1 + F.least(n - i, m - j) - 1 >= least_overlap(n, m, percent))


def _verified(docs: DataFrame, known: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) that are similar enough; written to the shared folder."""
    side = lambda s: known.select(*[F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "n", "digest", "classes")])
    sized = pairs.join(side("a"), F.col("a") == F.col("doc_id_a")).join(side("b"), F.col("b") == F.col("doc_id_b"))
    apart = F.aggregate(F.zip_with("classes_a", "classes_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    total = F.col("n_a") + F.col("n_b")
    suffix = apart <= total - 2 * least_overlap(F.col("n_a"), F.col("n_b"), percent)
    same = F.col("digest_a") == F.col("digest_b")
    left = cut_lineage(sized.filter(same | suffix).select("a", "b", same.alias("same")))
    ids = left.filter(~F.col("same")).select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = docs.join(_limited(ids), "doc_id", "left_semi")

    def row(doc, body):
        return [doc], [shingle_set(body, size).view(np.int64)]

    sets = _over_texts(wanted, "doc_id long, shingles array<long>", row, [pa.int64(), pa.list_(pa.int64())])
    sets = cut_lineage(sets)
    a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    similar = common * 100 >= (F.size("x") + F.size("y") - common) * percent
    found = left.filter(~F.col("same")).join(a, "a").join(b, "b").filter(similar).select("a", "b")
    out = cut_lineage(found.unionByName(left.filter("same").select("a", "b")))
    release(left, sets)
    return out


def links_and_components(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Row profiles, and (node, component) of every linked document.

    Documents of one and the same set are linked to the first of them; only that
    one takes part in the join, and those that have a set of their own as well.
    """
    rows = cut_lineage(profiles(docs, size))
    known = rows.filter("n > 0 and doc_id is not null").dropDuplicates(["doc_id", "digest"])
    heads = known.groupBy("digest").agg(F.min("doc_id").alias("head"))
    headed = cut_lineage(known.join(heads, "digest").select("doc_id", "head"))
    copies = headed.filter("doc_id != head").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    only = headed.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("head")).alias("only")).filter("only")
    alone = docs.join(_limited(only.select("doc_id")), "doc_id", "left_anti")
    entries = cut_lineage(prefix_entries(alone, size, percent, frequency_table(docs, size)))
    often = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("shingle")
    open_ = cut_lineage(entries.join(often, "shingle"))
    release(entries)
    links, tried, parts = [copies], [], None
    for turn in range(STAR_ROUNDS + 1):
        named = open_.withColumn("part", F.col("doc"))
        if parts is not None:
            named = open_.join(parts, open_["doc"] == parts["node"], "left").withColumn("part", F.coalesce("component", "doc"))
        named = named.select("shingle", "doc", "n", "place", "score", "part")
        mixed = named.groupBy("shingle").agg(
            F.min("part").alias("low"),
            F.max("part").alias("high"),
            F.count(F.lit(1)).alias("k"),
            F.max(F.struct("score", (-F.col("doc")).alias("less"), "n", "place", "part")).alias("pivot"),
        )
        mixed = mixed.filter("low < high").select("shingle", "k", "pivot")
        if turn < STAR_ROUNDS:
            pivot = F.col("pivot")
            star = cut_lineage(named.join(mixed, "shingle").withColumn("head", -pivot["less"]))
            wanted = (F.col("part") != pivot["part"]) & _may_match(
                F.col("n"), F.col("place"), pivot["n"], pivot["place"], percent
            )
            pairs = star.filter(wanted).select(F.least("head", "doc").alias("a"), F.greatest("head", "doc").alias("b"))
            before = open_
            # The pivot has met all others: its bucket is done if it had two members.
            open_ = cut_lineage(star.filter("doc != head and k > 2").select("shingle", "doc", "n", "place", "score"))
        else:
            star, before = cut_lineage(named.join(mixed.select("shingle"), "shingle")), open_
            other = star.select("shingle", *[F.col(c).alias(f"{c}2") for c in ("doc", "n", "place", "part")])
            wanted = (F.col("doc") < F.col("doc2")) & (F.col("part") != F.col("part2")) & _may_match(
                F.col("n"), F.col("place"), F.col("n2"), F.col("place2"), percent
            )
            pairs = star.join(other, "shingle").filter(wanted).select(F.col("doc").alias("a"), F.col("doc2").alias("b"))
        pairs = pairs.distinct()
        for earlier in tried:  # a pair that failed may meet again on another shingle
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        if turn < STAR_ROUNDS:
            pairs = cut_lineage(pairs)
            tried.append(pairs)
        links.append(_verified(docs, known, pairs, size, percent))
        release(star, before)
        older, parts = parts, connected_components(reduce(DataFrame.unionByName, links))
        parts = cut_lineage(parts)
        if older is not None:
            release(older)
    release(headed, *links, *tried)
    return rows, parts


def _limited(ids: DataFrame) -> DataFrame:
    """Ids to filter texts by: broadcast if they are few, else the texts are shuffled to them."""
    ids = cut_lineage(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def components(
    docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable)."""
    rows, parts = links_and_components(id_and_text(docs, key, text), size, percent)
    joined = rows.join(parts, rows["doc_id"] == parts["node"], "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _with_nodes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with ``_node``: the id, or a hash of id and text for rows without an id or with one of several texts."""
    own = docs.withColumn("_id", F.col(f"`{key}`").cast("long")).withColumn("_text_hash", F.xxhash64(F.col(f"`{text}`").cast("string")))
    several = own.filter("_id IS NOT NULL").groupBy("_id").agg(F.min("_text_hash").alias("_low"), F.max("_text_hash").alias("_high"))
    several = known_size(several.filter("_low <> _high").select(F.col("_id").alias("_several")))
    joined = own.join(several, F.col("_id") == F.col("_several"), "left")
    plain = F.col("_id").isNotNull() & F.col("_several").isNull()
    node = F.when(plain, F.col("_id")).otherwise(F.xxhash64("_id", "_text_hash"))
    return joined.withColumn("_node", node).drop("_several", "_text_hash")


def drop_near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component; texts without words stay.

    The row of the smallest id stays, one without an id only if no other has one.
    Rows without an id, and different texts of one id, are documents of their
    own; of repeated rows one stays, that of the least hash over all columns.
    """
    return in_own_columns(docs, ["_id", "_text_hash", "_node"], lambda own: _one_of_each(own, size, percent, key, text))


def _one_of_each(docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    named = _with_nodes(docs, key, text)
    found = components(named.select(F.col("_node").alias("doc_id"), F.col(f"`{text}`").alias("text")), size, percent)
    parts = found.filter("n_shingles > 0").select(F.col("doc_id").alias("_node"), "component_id")
    ids = named.select("_node", "_id")
    rows = cut_lineage(parts.groupBy("_node", "component_id").agg(F.count(F.lit(1)).alias("n")))
    # Few rows have a node that is not their id; the head of a component is its smallest real id.
    unnamed = known_size(ids.filter("_id IS NULL OR _id <> _node").distinct())
    ranked = rows.join(unnamed.withColumn("_own", F.lit(True)), "_node", "left")
    rank = F.struct((F.col("_own").isNotNull() & F.col("_id").isNull()).alias("bare"), F.coalesce("_id", "_node").alias("id"), F.col("_node").alias("node"))
    heads = ranked.groupBy("component_id").agg(F.min(rank).alias("head"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    gone = rows.join(heads, "component_id").filter(F.col("_node") != F.col("head.node")).select("_node")
    left = named.join(cut_lineage(gone), "_node", "left_anti")
    repeated = cut_lineage(rows.filter("n > 1").select("_node"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = left.join(repeated, "_node", "left_anti").select(*columns)
    if repeated.isEmpty():
        return once
    order = F.xxhash64(F.to_json(F.struct(*columns)))
    again = left.join(repeated, "_node", "left_semi").groupBy("_node").agg(F.min_by(F.struct(*columns), order).alias("_kept"))
    return once.unionByName(again.select("_kept.*"))
