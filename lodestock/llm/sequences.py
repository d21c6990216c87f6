"""Token sequences of fixed capacity: piece tables and packed id matrices.

Defined results: a null text is an empty one, and an empty text is one piece
that holds its closing id alone; repeated documents are packed like others;
only documents longer than the capacity are cut, so that all pieces but the
first are full.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .batches import blocks, id_and_text
from .encoders import byte_encoder
from .packing import Places, best_fit_decreasing, best_two_fit, length_counts, place

CAPACITY = 2048
SHARD_TOKENS = 4_000_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length int"


def cuts(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and end of each piece: full ones, but for the first."""
    first = total % capacity or capacity
    edges = [0, *range(first, total + 1, capacity)] if total > capacity else [0, total]
    return zip(edges[:-1], edges[1:], strict=True)


def token_pieces(
    docs: DataFrame,
    capacity: int,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    ranks_path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of each document's ids: ``ids_crc32``, or the ids as 16-bit numbers."""
    width = 2 if with_ids else 4
    end = end_id.to_bytes(width, "little")
    extra = ("ids", "binary", pa.binary()) if with_ids else ("ids_crc32", "long", pa.int64())
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), extra[2]]
    names = ["doc_id", "piece", "start", "length", extra[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(ranks_path, width)
        for block in blocks(batches, "text", 2 << 20):
            rows = []
            for doc, body in zip(*(c.to_pylist() for c in block.columns), strict=True):
                ids = encoder.encode(body or "") + end
                for n, (a, b) in enumerate(cuts(len(ids) // width, capacity)):
                    part = ids[a * width : b * width]
                    rows.append((doc, n, a, b - a, part if with_ids else zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                )

    return id_and_text(docs, key, text).mapInArrow(run, f"{PIECE_SCHEMA}, {extra[0]} {extra[1]}")


def pack_best_two_fit(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Each piece with its sequence and place, packed by best-two-fit over all documents.

    Texts are tokenized once; the pieces' lengths and checksums go to the shared
    folder, the plan is made from their histogram, and ranks give the places.
    """
    pieces = cut_lineage(token_pieces(docs, capacity, end_id, key, text, **options))
    counts = length_counts(pieces)
    return place(pieces, ["doc_id", "piece", "ids_crc32"], counts, best_two_fit(counts, capacity))


MATRIX_SCHEMA = (
    "shard int, row int, n_tokens int, ids binary, cu_seqlens array<int>, position_ids binary, "
    "doc_ids array<long>, pieces array<int>"
)


def packed_matrices(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = 50256,
    pad_id: int = 50256,
    key: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
    **options,
) -> DataFrame:
    """Rows of packed id matrices, one matrix per shard, by best-fit-decreasing.

    ``ids`` and ``position_ids`` are ``capacity`` little-endian 16-bit numbers;
    ids are padded.  ``cu_seqlens`` has the segments' cumulative lengths from 0;
    positions start from 0 in each segment and in the padding.  Pieces are dealt to shards by
    the hash of document and piece, so ids move once and a very long document
    is spread; a shard is a bounded number of tokens.
    """
    if capacity > 1 << 16:
        raise ValueError("positions are 16-bit numbers")
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")) + 1)).first()[0] or 0
    shards = max(1, -(-size // (2 * shard_tokens)))
    pieces = token_pieces(docs, capacity, end_id, key, text, with_ids=True, **options)
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int"))

    def fill(table: pa.Table) -> pa.Table:
        # By the ids as well: texts of one id have a fixed order, so a task that is run again places them alike.
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids", "ascending")])
        shard = table.column("shard")[0].as_py()
        lengths = table.column("length").to_numpy().astype(np.int64)
        ranks, seen = np.zeros(len(lengths), np.int64), defaultdict(int)
        for i, x in enumerate(lengths.tolist()):
            ranks[i] = seen[x]
            seen[x] += 1
        places = Places(best_fit_decreasing(dict(seen), capacity))
        bins, offsets = places.find(lengths, ranks)
        order = np.lexsort((offsets, bins))
        ids = np.full((places.bins, capacity), pad_id, "<u2")
        positions = np.zeros((places.bins, capacity), "<u2")
        docs_of, pieces_of = table.column("doc_id").to_pylist(), table.column("piece").to_pylist()
        packed = table.column("ids").to_pylist()
        inside: list[list[int]] = [[] for _ in range(places.bins)]
        for i in order.tolist():
            row, at, n = int(bins[i]), int(offsets[i]), int(lengths[i])
            ids[row, at : at + n] = np.frombuffer(packed[i], "<u2")
            positions[row, at : at + n] = np.arange(n)
            inside[row].append(i)
        cu = [[0, *np.cumsum(lengths[x]).tolist()] for x in inside]
        for row, edges in enumerate(cu):
            positions[row, edges[-1] :] = np.arange(capacity - edges[-1])
        return pa.table(
            {
                "shard": pa.array([shard] * places.bins, pa.int32()),
                "row": pa.array(range(places.bins), pa.int32()),
                "n_tokens": pa.array([x[-1] for x in cu], pa.int32()),
                "ids": pa.array([r.tobytes() for r in ids], pa.binary()),
                "cu_seqlens": pa.array(cu, pa.list_(pa.int32())),
                "position_ids": pa.array([r.tobytes() for r in positions], pa.binary()),
                "doc_ids": pa.array([[docs_of[i] for i in x] for x in inside], pa.list_(pa.int64())),
                "pieces": pa.array([[pieces_of[i] for i in x] for x in inside], pa.list_(pa.int32())),
            }
        )

    return dealt.groupBy("shard").applyInArrow(fill, MATRIX_SCHEMA)


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Write packed matrices as Parquet, a folder per shard."""
    matrices.write.mode("overwrite").partitionBy("shard").parquet(path)


def unpack(ids: bytes, cu_seqlens: list[int]) -> list[list[int]]:
    """The segments' ids of one packed row."""
    flat = np.frombuffer(ids, "<u2")
    return [flat[a:b].tolist() for a, b in zip(cu_seqlens[:-1], cu_seqlens[1:], strict=True)]
