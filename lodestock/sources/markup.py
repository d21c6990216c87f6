"""Feeds and HTML tables held as text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import html_to_text
from ..operators.columns import quoted


# The rest of a tag: quoted values, which may hold ``>``, only after an equals sign.
ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+"""
ELEMENTS = "array<struct<inner: binary, depth: int>>"
BATCH_BYTES = 1 << 24


@lru_cache
def _mark(tag: str) -> re.Pattern[bytes]:
    name = re.escape(tag)
    return re.compile(rf"<!--.*?-->|<!\[CDATA\[.*?\]\]>|</{name}\s*>|<{name}(?=[\s/>]){ATTRIBUTES}>".encode(), re.S)


def _spans(text: bytes, tag: str, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """Begin, end and depth of the elements between two places, as they close; one pass."""
    begun: list[int] = []
    for mark in _mark(tag).finditer(text, at, end):
        begin, after = mark.span()
        if text.startswith(b"</", begin):
            if begun:
                yield begun.pop(), begin, len(begun)
        elif text.startswith(b"/>", after - 2):
            yield after, after, len(begun)
        elif not text.startswith(b"<!", begin):
            begun.append(after)
    for depth, begin in enumerate(begun):
        yield begin, end, depth


def _first(text: bytes, tag: str, at: int, end: int) -> bytes | None:
    """The element that begins first: the first one to close that lies in no other."""
    return next((text[a:b] for a, b, depth in _spans(text, tag, at, end) if depth == 0), None)


def elements(text: Column, tag: str) -> Column:
    """The elements of a tag, in order of their beginnings: ``inner`` text, and ``depth`` inside others of the tag.

    Opening and closing tags pair up by a running stack, so equal tags may lie in
    each other.  Comments and CDATA sections are skipped; ``<tag/>`` is empty; an
    element that is never closed ends with the text; a closing tag without an
    opening one is ignored.
    """

    @F.arrow_udf(ELEMENTS)
    def found(texts: pa.Array) -> pa.Array:
        out = []
        for whole in texts.to_pylist():
            spans = None if whole is None else sorted(_spans(whole, tag, 0, len(whole)))
            out.append(spans and [{"inner": whole[a:b], "depth": depth} for a, b, depth in spans])
        return pa.array(out, pa.list_(pa.struct([("inner", pa.binary()), ("depth", pa.int32())])))

    return F.transform(
        found(text.cast("binary")), lambda e: F.struct(e["inner"].cast("string").alias("inner"), e["depth"].alias("depth"))
    )


def _inner(text: Column, tag: str) -> Column:
    return F.transform(elements(text, tag), lambda e: e["inner"])


def _outer(text: Column, tag: str) -> Column:
    return F.transform(F.filter(elements(text, tag), lambda e: e["depth"] == 0), lambda e: e["inner"])


def feed_items(df: DataFrame, body: str, fields: Mapping[str, str], item: str = "item") -> DataFrame:
    """One row per item, those inside others included; ``fields`` maps a tag to a column.

    A column has its tag's first element in the item.  Absent tags are null.  A
    page is read once for its items, and each item up to the end of its first
    element of a tag, so the time grows with the text and its depth.
    """
    rest = [c for c in df.columns if c != body]
    page = df.select(*rest, F.col(body).cast("binary").alias("_body"))
    schema = T.StructType(
        [*page.schema.fields[:-1], T.StructField("item_pos", T.IntegerType(), False), *[T.StructField(n, T.BinaryType()) for n in fields.values()]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, bodies = batch.columns[:-1], batch.columns[-1]
            rows, size = [], 0

            def out() -> pa.RecordBatch:
                of, places, *cells = zip(*rows, strict=True)
                columns = [c.take(pa.array(of)) for c in kept]
                columns += [pa.array(places, pa.int32()), *[pa.array(c, pa.binary()) for c in cells]]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for i, body in enumerate(bodies):
                text = body.as_py()
                spans = sorted(_spans(text, item, 0, len(text))) if text is not None else []
                for place, (begin, end, _) in enumerate(spans):
                    cells = [_first(text, tag, begin, end) for tag in fields]
                    rows.append((i, place, *cells))
                    size += sum(len(c) for c in cells if c is not None) + 64
                    if size >= BATCH_BYTES:
                        yield out()
                        rows, size = [], 0
            if rows:
                yield out()

    return page.mapInArrow(run, schema).withColumns({n: F.col(quoted(n)).cast("string") for n in fields.values()})


def table_rows(df: DataFrame, body: str, names: Sequence[str]) -> DataFrame:
    """Rows of HTML tables: the n-th cell of each row under the n-th name; a table in a cell is part of the cell."""
    rest = [c for c in df.columns if c != body]
    rows = df.select(*rest, F.posexplode(_outer(F.col(body), "tr")).alias("row_pos", "_row"))
    cells = _outer(F.col("_row"), "td")
    return rows.select(*rest, "row_pos", *[html_to_text(F.get(cells, F.lit(i))).alias(n) for i, n in enumerate(names)])
