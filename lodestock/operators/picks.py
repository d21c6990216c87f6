"""One row per key, and rows equal to an extreme of their group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import quoted


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` lets Spark keep one row per key in every partition
    before the shuffle, so a hot key moves one row per task.
    """
    w = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def distinct_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Drop duplicates on ``keys``, keeping the first in a stated order."""
    return first_per_key(df, keys, order)


def extreme_rows(df: DataFrame, keys: Sequence[str], value: str, largest: bool = True) -> DataFrame:
    """All rows whose value is the largest (or smallest) of their key.

    Ties are all kept.  The extreme is a map-side aggregate; the join back is
    on key and value, which spreads a hot key over its values.
    """
    pick = F.max if largest else F.min
    ends = df.groupBy(*[quoted(k) for k in keys]).agg(pick(quoted(value)).alias("_end"))
    right = ends.select(*[F.col(quoted(k)).alias(f"_key_{i}") for i, k in enumerate(keys)], "_end")
    same = F.col(quoted(value)) == F.col("_end")
    for i, k in enumerate(keys):
        same = same & F.col(quoted(k)).eqNullSafe(F.col(f"_key_{i}"))
    return df.join(right, same).select([quoted(c) for c in df.columns])


def most_frequent(df: DataFrame, group: Sequence[str], item: str) -> DataFrame:
    """Per group the item with most rows; ties go to the smallest item."""
    counts = df.groupBy(*group, item).agg(F.count(F.lit(1)).alias("count"))
    return first_per_key(counts, group, [F.desc("count"), F.asc(item)])
