"""Joins.

No join here carries a broadcast hint: Spark broadcasts a side when its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and sorts and
merges otherwise, and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import quoted


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
) -> DataFrame:
    """Left join to a dimension.

    ``on`` maps a column of ``df`` to the dimension's key, ``take`` maps a
    dimension column to its new name; call twice for a dimension in two roles.
    """
    right = dim.select(
        *[F.col(quoted(r)).alias(f"_on_{i}") for i, r in enumerate(on.values())],
        *[F.col(quoted(c)).alias(n) for c, n in take.items()],
    )
    same = [F.col(quoted(left)) == F.col(f"_on_{i}") for i, left in enumerate(on)]
    return df.join(right, same, "left").drop(*[f"_on_{i}" for i in range(len(on))])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which a null key equals a null key, as in pandas."""
    renamed = right.select(
        *[F.col(quoted(k)).alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[quoted(c) for c in right.columns if c not in keys],
    )
    same = None
    for i, k in enumerate(keys):
        term = F.col(quoted(k)).eqNullSafe(F.col(f"_key_{i}"))
        same = term if same is None else same & term
    return left.join(renamed, same, how).drop(*[f"_key_{i}" for i in range(len(keys))])


def join_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join; the key columns come from whichever side has them."""
    return left.join(right, list(keys), "outer")


def keep_members(df: DataFrame, members: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs among the members (semi-join)."""
    right = members.select(*[F.col(quoted(r)).alias(f"_on_{i}") for i, r in enumerate(on.values())])
    same = [F.col(quoted(left)) == F.col(f"_on_{i}") for i, left in enumerate(on)]
    return df.join(right, same, "left_semi")


def trailing_sum(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str,
    days: int,
    name: str,
    rows_where: Column | None = None,
) -> DataFrame:
    """Per key and day: the value summed over the day and ``days`` before it.

    Equal to joining each row to all rows of its key in the period and summing,
    where ``n`` rows on a day count the period ``n`` times.  Rows collapse to
    one per key and day before the shuffle, so a group is at most as long as
    the calendar; no pair of rows is ever formed.  ``rows_where`` limits the
    rows summed, not the days reported.
    """
    counted = F.lit(True) if rows_where is None else rows_where
    daily = df.groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.when(counted, F.col(value))).alias("_value"),
    )
    w = (
        Window.partitionBy(*keys)
        .orderBy(F.unix_date(F.to_date(day)))
        .rangeBetween(-days, Window.currentRow)
    )
    total = F.sum("_value").over(w) * F.col("_rows")
    return daily.select(*keys, day, total.alias(name)).filter(F.col(name).isNotNull())


def per_key_totals(
    df: DataFrame, facts: DataFrame, on: Mapping[str, str], totals: Mapping[str, Column]
) -> DataFrame:
    """Left join to aggregates of ``facts``: a correlated subquery per row.

    The facts collapse to one row per key before they meet ``df``.
    """
    grouped = facts.groupBy(*[F.col(quoted(r)).alias(f"_on_{i}") for i, r in enumerate(on.values())]).agg(
        *[c.alias(n) for n, c in totals.items()]
    )
    same = [F.col(quoted(left)) == F.col(f"_on_{i}") for i, left in enumerate(on)]
    return df.join(grouped, same, "left").drop(*[f"_on_{i}" for i in range(len(on))])


def within_period(df: DataFrame, column: str, periods: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows from the first period on and before the last one.

    The bounds are a scalar subquery over a calendar: computed once, then
    compared as constants.
    """
    bounds = periods.agg(F.struct(first.alias("low"), last.alias("high")).alias("b")).scalar()
    return df.filter((F.col(column) >= bounds["low"]) & (F.col(column) < bounds["high"]))
