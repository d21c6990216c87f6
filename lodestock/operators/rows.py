"""Operators that need the order of rows.

Spark keeps no row order, so every function takes a whole-number position
column.  Work is cut into blocks of positions: a block is the largest unit one
task ever sorts, whatever the size of the sheet.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from .columns import quoted

BLOCK_ROWS = 1_000_000


def drop_footer(df: DataFrame, rows: int, position: str = "row_pos", by: Sequence[str] = ()) -> DataFrame:
    """Without the last ``rows`` positions, of each file where ``by`` names one.

    The end of one sheet is a scalar subquery; ends per file are an aggregate
    that is joined back, null keys being a file of their own.
    """
    if not by:
        last = df.agg(F.max(position)).scalar()
        return df.filter(F.col(position) <= last - rows)
    names = [f"_key_{i}" for i in range(len(by))]
    ends = df.groupBy(*[F.col(quoted(k)).alias(n) for k, n in zip(by, names)]).agg(F.max(position).alias("_last"))
    same = reduce(and_, [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in zip(by, names)])
    return df.join(ends, same).filter(F.col(position) <= F.col("_last") - rows).select([quoted(c) for c in df.columns])


def skip_rows(df: DataFrame, rows: int, position: str = "row_pos") -> DataFrame:
    """Without the first ``rows`` positions (counted from zero)."""
    return df.filter(F.col(position) >= rows)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    position: str = "row_pos",
    by: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Carry the last value down over nulls.

    Each block starts with a seed row holding the values carried into it: the
    last values of the blocks before, from one summary row per block.  One
    window per block then fills the rows, so neither a long sheet nor one large
    group in ``by`` lands in one task.
    """
    keys = [F.col(quoted(k)) for k in by]
    block = F.floor(F.col(quoted(position)) / F.lit(block_rows))
    rows = df.withColumns({"_block": block, "_seed": F.lit(False)})
    last_in_block = [
        F.max_by(F.col(quoted(c)), F.when(F.col(quoted(c)).isNotNull(), F.col(quoted(position)))).alias(c) for c in columns
    ]
    summary = rows.groupBy(*keys, "_block").agg(*last_in_block)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    seeds = summary.select(
        *keys,
        "_block",
        *[F.last(F.col(quoted(c)), ignorenulls=True).over(before).alias(c) for c in columns],
        (F.col("_block") * block_rows - 1).cast(df.schema[position].dataType).alias(position),
        F.lit(True).alias("_seed"),
    )
    within = Window.partitionBy(*keys, "_block").orderBy(quoted(position)).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(F.col(quoted(c)), ignorenulls=True).over(within) for c in columns}
    seeded = rows.unionByName(seeds, allowMissingColumns=True)
    return seeded.withColumns(filled).filter(~F.col("_seed")).select([quoted(c) for c in df.columns])


def section_rows(
    df: DataFrame,
    label: str,
    start: str,
    stop: str,
    active_first: bool,
    position: str = "row_pos",
    block_rows: int = BLOCK_ROWS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Data rows of a sheet whose sections lie between marker rows.

    A row labelled ``start`` opens a section and one labelled ``stop`` closes
    it; both are removed, as are rows without a label.  ``section`` counts the
    closing markers seen so far, from one, in each file where ``by`` names one.
    """
    text = F.col(quoted(label))
    labelled = df.filter(text.isNotNull())
    marks = labelled.withColumns(
        {
            "_state": F.when(text == start, True).when(text == stop, False),
            "_stops": (text == stop).cast("long"),
        }
    )
    filled = forward_fill(marks, ["_state"], position, by, block_rows)
    counted = running_total(filled, "_stops", "section", position, block_rows, by)
    is_marker = text.isin(start, stop)
    return (
        counted.filter(~is_marker & F.coalesce("_state", F.lit(active_first)))
        .withColumn("section", F.col("section") + 1)
        .drop("_state", "_stops")
    )


def running_total(
    df: DataFrame, value: str, name: str, position: str = "row_pos", block_rows: int = BLOCK_ROWS, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of ``value`` up to and with the row, block by block, from seed rows."""
    keys = [F.col(quoted(k)) for k in by]
    block = F.floor(F.col(position) / F.lit(block_rows))
    rows = df.withColumns({"_block": block, "_seed": F.lit(False)})
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block reaches this window.
    seeds = (
        rows.groupBy(*keys, "_block")
        .agg(F.sum(value).alias("_sum"))
        .select(
            *keys,
            "_block",
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(value),
            (F.col("_block") * block_rows - 1).cast(df.schema[position].dataType).alias(position),
            F.lit(True).alias("_seed"),
        )
    )
    within = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    seeded = rows.unionByName(seeds, allowMissingColumns=True)
    return seeded.withColumn(name, F.sum(value).over(within)).filter(~F.col("_seed")).drop("_block", "_seed")
