"""Aggregations beyond a plain ``groupBy``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import known_size
from .columns import quoted

SALT_BUCKETS = 64


def sum_or_zero(c: Column | str) -> Column:
    """Sum that is zero, not null, where every value is null."""
    return F.coalesce(F.sum(c), F.lit(0))


def join_texts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    name: str,
    sep: str = ", ",
    max_chars: int | None = None,
    descending: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """One text per key: all its values in a stated order.

    Nulls are skipped.  ``max_chars`` is for a target column that trims: each
    value but the first brings a separator, so the leading
    ``max_chars // len(sep) + 1`` values decide the cut text exactly, and they
    are chosen first within salted parts of a key and then within the key.
    Without it the parts are gathered with map-side lists, and the key's cell
    holds every value.
    """
    if max_chars is not None and not sep:
        raise ValueError("the separator bounds the number of values and cannot be empty")
    rows = df.filter(F.col(quoted(value)).isNotNull())
    columns = [*dict.fromkeys([*keys, *order, value])]
    rows = rows.select([quoted(c) for c in columns])
    if distinct:
        rows = rows.distinct()
    direction = F.desc if descending else F.asc
    # The value is the last order key, so ties give the same text in any run.
    by = [direction(quoted(c)) for c in dict.fromkeys([*order, value])]
    if max_chars is None:
        places = [f"_{i}" for i in range(len(by))]
        names = [*dict.fromkeys([*order, value])]
        cell = F.struct(*[F.col(quoted(c)).alias(p) for c, p in zip(names, places)], F.col(quoted(value)).cast("string").alias("_text"))
        listed = F.sort_array(F.collect_list(cell), asc=not descending)
        text = F.array_join(F.transform(listed, lambda x: x["_text"]), sep)
        return rows.groupBy(*[quoted(k) for k in keys]).agg(text.alias(name))
    limit = max_chars // len(sep) + 1
    salt = F.pmod(F.xxhash64(*[quoted(c) for c in columns]), F.lit(SALT_BUCKETS))
    in_part = Window.partitionBy(*[quoted(k) for k in keys], "_salt").orderBy(*by)
    in_key = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*by)
    top = (
        rows.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(in_part))
        .filter(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(in_key))
        .filter(F.col("_rank") <= limit)
    )
    cell = F.struct(F.col("_rank"), F.col(quoted(value)).cast("string").alias("_text"))
    listed = F.array_sort(F.collect_list(cell))
    return top.groupBy(*[quoted(k) for k in keys]).agg(
        F.left(F.array_join(F.transform(listed, lambda x: x["_text"]), sep), F.lit(max_chars)).alias(name)
    )


def value_sets(df: DataFrame, keys: Sequence[str], value: str, name: str, sep: str = "|") -> DataFrame:
    """Sorted distinct values of each key as one text.

    For values of a small domain: the cell holds all of a key's values.  Where
    the domain grows with the data, keep the distinct rows (``distinct``) or
    count them (``distinct_counts``) instead.
    """
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias(name))


def distinct_counts(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Number of distinct values per key, by two aggregates.

    The first is keyed by key and value, which spreads a hot key; the second
    counts its rows with map-side sums.
    """
    pairs = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.lit(1).alias("_one"))
    return pairs.groupBy(*keys).agg(F.count("_one").alias(name))


def weighted_average(df: DataFrame, keys: Sequence[str], price: str, quantity: str, name: str) -> DataFrame:
    """Price weighted by its share of the key's quantity.

    Sum of price times quantity over the total quantity in one map-side pass:
    the two-level form (share per row, then sum) needs the total joined back.
    """
    weighted = F.sum(F.col(price) * F.col(quantity))
    return df.groupBy(*keys).agg(F.try_divide(weighted, F.sum(quantity)).alias(name))


def group_total(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row with its group's total.

    A window would bring a whole group into one task; the total is a map-side
    aggregate joined back instead.
    """
    totals = df.groupBy(*[F.col(quoted(k)).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(
        F.sum(value).alias(name)
    )
    totals = known_size(totals)
    same = None
    for i, k in enumerate(keys):
        term = F.col(quoted(k)).eqNullSafe(F.col(f"_key_{i}"))
        same = term if same is None else same & term
    return df.join(totals, same, "left").drop(*[f"_key_{i}" for i in range(len(keys))])


def cross_tab(df: DataFrame, row: str, column: str, values: Sequence[object], shares: bool = False) -> DataFrame:
    """Counts per row value and column value, or each row's shares.

    The column values are given, so no extra job looks for them.
    """
    cells = [F.count_if(F.col(column) == v).alias(str(v)) for v in values]
    table = df.groupBy(row).agg(*cells)
    if not shares:
        return table
    total = sum((F.col(quoted(str(v))) for v in values[1:]), F.col(quoted(str(values[0]))))
    return table.select(row, *[F.try_divide(F.col(quoted(str(v))), total).alias(str(v)) for v in values])


def frequency_shares(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Long form of the row-normalised table: share of each item in its key.

    A key's total is an aggregate that is joined back, so a key of many items
    is not gathered.
    """
    counts = df.groupBy(*[quoted(c) for c in [*keys, item]]).agg(F.count(F.lit(1)).alias("n"))
    return group_total(counts, keys, "n", "_total").withColumn("share", F.col("n") / F.col("_total")).drop("_total")
