"""Pivot, unpivot, explode, split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .aggregates import join_texts
from .columns import quoted


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    variable: str = "variable",
    value: str = "value",
    drop_null: bool = False,
) -> DataFrame:
    """Wide to long.  Nulls stay, as in pandas ``melt``, unless dropped."""
    long = df.unpivot([F.col(quoted(c)) for c in ids], [F.col(quoted(c)) for c in values], variable, value)
    return long.filter(F.col(value).isNotNull()) if drop_null else long


def pivot_sum(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[object], amount: str) -> DataFrame:
    """Long to wide with sums, for a given list of columns."""
    return df.groupBy(*keys).pivot(column, list(values)).sum(amount)


def pivot_texts(
    df: DataFrame, keys: Sequence[str], column: str, values: Mapping[str, str], text: str, sep: str = ",", max_chars: int | None = None
) -> DataFrame:
    """Attribute rows to columns, distinct values of a cell joined in value order.

    Cells are joined first, one row per key and attribute; ``max_chars`` trims
    a cell only where the caller asks for it.
    """
    cells = join_texts(df, [*keys, column], text, [], "_cell", sep=sep, max_chars=max_chars, distinct=True)
    return cells.groupBy(*[quoted(k) for k in keys]).agg(
        *[F.max(F.when(F.col(quoted(column)) == v, F.col("_cell"))).alias(name) for v, name in values.items()]
    )


def explode_parts(df: DataFrame, parts: Column, name: str) -> DataFrame:
    """One row per array element, replacing or adding column ``name``."""
    return df.withColumn(name, F.explode(parts))


def unpack_map(df: DataFrame, column: str, names: Sequence[str], total: str | None = None) -> DataFrame:
    """Map entries to columns, zero where absent, with an optional row total."""
    cells = {n: F.coalesce(F.col(column)[n], F.lit(0)) for n in names}
    out = df.withColumns(cells).drop(column)
    if total is None:
        return out
    row_sum = sum((F.col(quoted(n)) for n in names[1:]), F.col(quoted(names[0])))
    return out.withColumn(total, row_sum).filter(F.col(total) > 0)


def marked_cells(df: DataFrame, ids: Sequence[str], marks: Sequence[str], name: str = "machine") -> DataFrame:
    """One row per non-blank cell of a grid, naming the cell's column."""
    long = unpivot(df, ids, marks, name, "_mark")
    blank = F.col("_mark").rlike(r"(?U)^\s*$")
    return long.filter(F.col("_mark").isNotNull() & ~blank).drop("_mark")


def split_by_rule(
    df: DataFrame, rules: Sequence[tuple[str, Column]], otherwise: str | None, name: str = "bucket"
) -> DataFrame:
    """Label each row by the first rule that holds; rows without a label drop.

    The label is one column, so writing the parts is one partitioned write
    instead of one scan per part.
    """
    label = F.when(rules[0][1], rules[0][0])
    for bucket, rule in rules[1:]:
        label = label.when(rule, bucket)
    if otherwise is not None:
        label = label.otherwise(otherwise)
    return df.withColumn(name, label).filter(F.col(name).isNotNull())
