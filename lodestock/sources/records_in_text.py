"""Records of delimited text whose quoted cells may hold line breaks.

A reader of lines with two states, outside and inside a quoted cell, says where a
record ends.  File blocks are read apart: each gives, for either state on entry,
the state on exit and the records that begin in it.  These two-state maps compose
along the blocks of a file (the last map that forgets its entry state, and the
swaps after it), so every block learns its entry state and first record number
from one small row per block.  Then blocks cut their own records; only what
crosses a block's edge is put together by record number.

A quote opens a cell only at the cell's start; inside, a doubled quote is one
sign.  Line breaks inside a cell come back as ``\\n``.  A cell that is never closed
runs to the end of its file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import known_size

BATCH_ROWS = 4096


class QuoteReader:
    """State after a line, from the state before it."""

    def __init__(self, sep: str = ",", quote: str = '"'):
        q, s = re.escape(quote), re.escape(sep)
        self.quote = quote
        # Whole cells from the left; what they leave over is an opened one.  Nothing is given back.
        inner, rest = rf"(?:[^{q}]++|{q}{q})*+{q}", rf"(?:(?!{s}).)*+(?:{s}|\Z)"
        self.cells = re.compile(rf"(?:(?:{q}{inner}|(?!{q})){rest})*", re.S)
        self.closing = re.compile(inner + rest, re.S)

    def after(self, line: str, inside: bool) -> bool:
        """Whether the line ends inside a quoted cell."""
        if self.quote not in line:
            return inside
        at = 0
        if inside:
            closed = self.closing.match(line)
            if closed is None:
                return True
            at = closed.end()
        return self.cells.match(line, at).end() < len(line)


def _block_lines(spark: SparkSession, path: str, modified_after: str | None) -> DataFrame:
    reader = spark.read if modified_after is None else spark.read.option("modifiedAfter", modified_after)
    return reader.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """The lines of a task by file and block; a block's lines come together and in order."""
    held, key = [], None
    for batch in batches:
        names = batch.schema.names
        columns = (batch.column(names.index(c)).to_pylist() for c in ("line", "file", "block"))
        for line, file, block in zip(*columns, strict=True):
            if (file, block) != key:
                if key is not None:
                    yield *key, held
                held, key = [], (file, block)
            held.append(line)
    if key is not None:
        yield *key, held


SUMMARY = "file string, block long, lines long, exit_0 int, exit_1 int, records_0 long, records_1 long"


def block_summaries(lines: DataFrame, quotes: QuoteReader) -> DataFrame:
    """Per block and entry state, the state on exit and how many records begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for file, block, held in _in_blocks(batches):
            states, records = [False, True], [0, 0]
            for line in held:
                for i in (0, 1):
                    records[i] += not states[i]
                if quotes.quote in line:
                    states = [quotes.after(line, s) for s in states]
            out.append((file, block, len(held), *map(int, states), *records))
        if out:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SUMMARY.split(", ")])

    return lines.mapInArrow(run, SUMMARY)


def block_starts(summaries: DataFrame) -> DataFrame:
    """Entry state (``inside``) and first record number (``first``) of each block."""
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    forgets, swaps = F.col("exit_0") == F.col("exit_1"), (F.col("exit_0") == 1) & (F.col("exit_1") == 0)
    counted = summaries.withColumn("_swaps", F.sum(swaps.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.last(F.when(forgets, F.struct(F.col("exit_0").alias("state"), F.col("_swaps").alias("swaps"))), ignorenulls=True).over(earlier)
    before = F.coalesce(F.max("_swaps").over(earlier), F.lit(0))
    known = counted.withColumn("_last", last).withColumn("_before", before)
    state = F.pmod(F.coalesce(F.col("_last.state"), F.lit(0)) + F.col("_before") - F.coalesce(F.col("_last.swaps"), F.lit(0)), F.lit(2))
    entered = known.withColumn("inside", state == 1)
    begun = F.when(F.col("inside"), F.col("records_1")).otherwise(F.col("records_0"))
    return entered.select(
        "file", "block", "lines", "inside", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("first")
    )


def quoted_records(
    spark: SparkSession, path: str, sep: str = ",", quote: str = '"', modified_after: str | None = None
) -> DataFrame:
    """Records with their ``file`` and number in it (``row_pos``, from zero) as ``line``.

    The starts of blocks, one small row per block of the folder's files, are
    broadcast, so lines are never moved.  A folder that changes between the two
    readings raises.
    """
    quotes = QuoteReader(sep, quote)
    lines = _block_lines(spark, path, modified_after)
    starts = known_size(block_starts(block_summaries(lines, quotes)))
    placed = lines.join(F.broadcast(starts), ["file", "block"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for file, block, held, facts in _with_facts(batches):
            if facts is None or facts["lines"] != len(held):
                raise RuntimeError(f"{file} changed while it was read")
            inside, number = facts["inside"], facts["first"] - 1
            whole, parts = not inside, []
            for line in held:
                if not inside:
                    if parts:
                        rows.append((file, number, block, whole, "\n".join(parts)))
                    number, whole, parts = number + 1, True, []
                parts.append(line)
                inside = quotes.after(line, inside)
                if len(rows) >= BATCH_ROWS:
                    yield _batch(rows)
                    rows = []
            # The next block may go on with an open record; a closed one is whole unless it began earlier.
            rows.append((file, number, block, whole and not inside, "\n".join(parts)))
        if rows:
            yield _batch(rows)

    cut = placed.mapInArrow(run, "file string, row_pos long, block long, whole boolean, line string")
    cut = known_size(cut)  # read twice
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "line"))), lambda p: p["line"])
    joined = cut.filter("not whole").groupBy("file", "row_pos").agg(F.array_join(pieces, "\n").alias("line"))
    return cut.filter("whole").select("file", "row_pos", "line").unionByName(joined)


def _with_facts(batches: Iterator[pa.RecordBatch]):
    """Lines of each block with the block's start, which its rows repeat."""
    facts: dict[tuple, dict | None] = {}

    def watched() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            files, blocks, inside, first, lines = (batch.column(names.index(c)) for c in ("file", "block", "inside", "first", "lines"))
            keys = list(zip(files.to_pylist(), blocks.to_pylist(), strict=True))
            for i, key in enumerate(keys):
                if key not in facts:
                    known = lines[i].as_py()
                    facts[key] = None if known is None else {"inside": inside[i].as_py(), "first": first[i].as_py(), "lines": known}
            yield batch

    for file, block, held in _in_blocks(watched()):
        yield file, block, held, facts.pop((file, block))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "row_pos", "block", "whole", "line"])
