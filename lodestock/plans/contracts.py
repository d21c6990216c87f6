"""Price columns in contract tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import money
from ..operators.aggregates import distinct_counts
from ..operators.picks import most_frequent

TABLE = ["document", "table"]
PRICES_HELD = 256


def priced_items(prices: DataFrame) -> DataFrame:
    """The prices of each item as arrays of at most ``PRICES_HELD``, so a cell meets them as one row."""
    place = F.row_number().over(Window.partitionBy("item").orderBy("price"))
    held = prices.filter("item IS NOT NULL AND price IS NOT NULL").select("item", "price", F.floor((place - 1) / PRICES_HELD).alias("_part"))
    return held.groupBy("item", "_part").agg(F.collect_list("price").alias("_prices")).drop("_part")


def price_column_labels(cells: DataFrame, prices: DataFrame) -> DataFrame:
    """Label every column of every contract table.

    A cell naming a known item makes the other cells of its row candidates; a
    candidate equal to the item's price votes for its column.  The column with
    most votes (ties: first column) is ``Price``, the others of such a table
    are ``NotPrice``, columns of tables without votes are ``Other``.  The values
    of a column stay as rows of ``column_values``: a column may be long.

    ``cells``: document, table, row, column, value; ``prices``: item, price.
    """
    rows = [*TABLE, "row"]
    # Cells outside the range of the items or prices equal none of them and are not moved.
    ends = prices.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in ("item", "price") for n, f in (("low", F.min), ("high", F.max))]).alias("x")).scalar()
    within = lambda c, of: c.between(ends[f"low_{of}"], ends[f"high_{of}"])
    items = priced_items(prices)
    named = cells.filter(within(F.col("value"), "item")).join(items, F.col("value") == F.col("item")).select(*rows, "_prices")
    # Only cells that are money can vote; they meet the prices of their row.
    amounts = cells.select(*rows, "column", money("value").alias("_money")).filter(within(F.col("_money"), "price"))
    equal = F.filter("_prices", lambda p: p == F.col("_money"))
    votes = amounts.join(named, rows).select(*TABLE, "column", F.explode(equal)).select(*TABLE, "column")
    winners = most_frequent(votes, TABLE, "column").select(*TABLE, F.col("column").alias("winner"))
    columns = distinct_counts(cells, [*TABLE, "column"], "value", "n_values")
    label = (
        F.when(F.col("column") == F.col("winner"), "Price")
        .when(F.col("winner").isNotNull(), "NotPrice")
        .otherwise("Other")
    )
    return columns.join(winners, TABLE, "left").withColumn("label", label).drop("winner")


def column_values(cells: DataFrame) -> DataFrame:
    """The distinct values of every column, one per row."""
    return cells.select(*TABLE, "column", "value").distinct()
