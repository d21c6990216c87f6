"""Unit cost under three pricing models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.aggregates import weighted_average


def unit_costs(standard: DataFrame, rates: DataFrame, invoices: DataFrame, fair_values: DataFrame) -> DataFrame:
    """Standard, weighted-average and fair-value cost per plant and item.

    ``standard``: plant, item, price, price_unit, currency, year_week, as_of.
    ``rates``: currency, year_week, rate.  ``invoices``: plant, item, quantity,
    amount.  ``fair_values``: plant, item, value.  A zero invoice quantity
    gives no price.
    """
    dated = standard.join(rates, ["currency", "year_week"], "left")
    usd = F.col("price") * F.when(F.col("currency") == "USD", 1.0).otherwise(F.col("rate"))
    cost = F.avg(F.try_divide(usd, "price_unit"))
    models = [
        ("Standard Cost", dated.groupBy("plant", "item").agg(cost.alias("unit_cost"), F.max("as_of").alias("last_updated"))),
        (
            "Weighted Average",
            weighted_average(
                invoices.withColumn("unit_price", F.try_divide("amount", "quantity")).filter("unit_price IS NOT NULL"),
                ["plant", "item"], "unit_price", "quantity", "unit_cost",
            ),
        ),
        ("Fair Market Value", fair_values.groupBy("plant", "item").agg(F.avg("value").alias("unit_cost"))),
    ]
    out = None
    for name, frame in models:
        part = frame.withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.withColumn("unit_cost_x100", F.col("unit_cost") * 100)
