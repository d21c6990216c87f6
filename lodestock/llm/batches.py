"""Arrow batches of documents: whole rows in, the same rows plus columns out."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_BYTES = 4 << 20


def without(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` without columns that have one of the names, whatever their case."""
    taken = {n.lower() for n in names}
    return docs.drop(*[c for c in docs.columns if c.lower() in taken])


def in_own_columns(docs: DataFrame, names: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` in the columns of ``docs``; those named like a computed one are set aside meanwhile."""
    taken, used = {n.lower() for n in names}, {c.lower() for c in docs.columns}
    aside = {}
    for c in docs.columns:
        if c.lower() in taken:
            name = f"_own_{c}"
            while name.lower() in taken | used:
                name = f"_{name}"
            used.add(name.lower())
            aside[c] = name
    done = work(docs.withColumnsRenamed(aside))
    return done.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's call that returns freed memory to the system; none where it has no such call."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system.

    Workers outlive their tasks, and the C library keeps what a long text took;
    without this an executor's idle workers hold some hundred MB each.
    """
    if (trim := _trim()) is not None:
        trim(0)


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text, one row at least.

    Freed memory goes back after a text longer than that, and after the last block.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                if held > limit:
                    give_back()
                start, held = i, 0
            held += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)
            if held > limit:
                give_back()
    give_back()


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Texts as UTF-8, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def add_columns(
    docs: DataFrame,
    text: str,
    fields: list[T.StructField],
    make: Callable[[pa.RecordBatch], list],
    limit: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with computed columns, block by block.

    ``make`` gets a block and returns one list or array per field.  Input
    columns of a computed column's name are replaced.
    """
    kept = without(docs, [f.name for f in fields if f.name.lower() != text.lower()])
    schema = T.StructType([*kept.schema.fields, *fields])
    types = [f.type for f in to_arrow_schema(T.StructType(fields))]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, limit):
            made = [
                x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(make(block), types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*block.columns, *made], names=names)

    return kept.mapInArrow(run, schema)


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, the key as a long integer."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
