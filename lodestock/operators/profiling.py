"""Column profiles, quantiles, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .columns import quoted
from .quantiles import quantiles_of


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls, longest text, smallest and largest value.

    A single aggregate over the whole table; one row of structs is unfolded.
    """
    cells = []
    for f in df.schema:
        c = F.col(quoted(f.name))
        text = c.cast("string")
        cells.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(c.isNull()).alias("null_count"),
                F.max(F.length(text)).cast("long").alias("max_length"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def summary_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, smallest and largest value per numeric column."""
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(quoted(c)).alias("n"),
            F.avg(quoted(c)).alias("mean"),
            F.stddev_samp(quoted(c)).alias("std"),
            F.min(quoted(c)).cast("double").alias("min"),
            F.max(quoted(c)).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every column pair, long form, in one pass."""
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.corr(quoted(a), quoted(b)).alias("r"))
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float | None]:
    """Exact interpolated quantiles of a numeric column; null and NaN are skipped."""
    return quantiles_of(df, {column: probabilities})[column]


def exact_quantile(df: DataFrame, column: str, p: float) -> float | None:
    return exact_quantiles(df, column, [p])[0]


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by their column's exact median; all medians are found together."""
    medians = {c: m for c, (m,) in quantiles_of(df, {c: [0.5] for c in columns}).items()}
    return df.fillna({c: m for c, m in medians.items() if m is not None})


def quantile_bins(df: DataFrame, column: str, probabilities: Sequence[float], labels: Sequence[str], name: str) -> DataFrame:
    """Label of the quantile bin; a bin is open below and closed above.

    The lowest edge belongs to the first bin.
    """
    edges = exact_quantiles(df, column, probabilities[1:])
    c = F.col(quoted(column))
    out = F.when(c <= edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(c <= edge, label)
    return df.withColumn(name, out)
