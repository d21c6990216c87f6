"""Order lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.aggregates import join_texts
from ..operators.joins import lookup, trailing_sum
from ..session import known_size


def late_lines_by_supplier(
    lines: DataFrame, orders: DataFrame, suppliers: DataFrame, nations: DataFrame, limit_days: int
) -> DataFrame:
    """Lines, late lines, mean days to ship and value per supplier.

    Names come in after the aggregation, on one row per supplier.
    """
    days = F.datediff("l_shipdate", "o_orderdate")
    per_supplier = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy("l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(days > limit_days).alias("late_lines"),
            F.round(F.avg(days), 6).alias("avg_days"),
            F.round(F.sum("l_extendedprice"), 2).alias("value"),
        )
    )
    named = per_supplier.join(suppliers, per_supplier.l_suppkey == suppliers.s_suppkey)
    named = lookup(named, nations, {"s_nationkey": "n_nationkey"}, {"n_name": "nation"})
    return named.select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier"), "nation",
        "lines", "late_lines", "avg_days", "value",
    )


def lateness_features(
    lines: DataFrame,
    events: DataFrame,
    changes: DataFrame,
    shipments: DataFrame,
    training_start: str,
    carrier_chars: int | None = None,
) -> DataFrame:
    """Features of each order line for the lateness models.

    ``lines``: ``order_id``, ``line_id``, ``supplier_id``, ``part_id``,
    ``ordered``, ``due``, ``received``, ``status``, ``quantity``, ``amount``.
    Every side table shrinks to one row per key before it is joined.
    ``carrier_chars`` trims the carriers for a target column of that length.
    """
    is_open = F.col("status").isin("OPEN", "PARTIAL")
    per_supplier = (
        lines.filter(is_open)
        .groupBy("supplier_id")
        .agg(F.count(F.lit(1)).alias("open_count"), F.sum("amount").alias("open_amount"))
    )
    per_supplier = known_size(per_supplier)  # few suppliers, many lines
    event_counts = events.groupBy("order_id").agg(F.count(F.lit(1)).alias("event_count"))
    change_counts = changes.groupBy("order_id", "line_id").agg(F.count(F.lit(1)).alias("change_count"))
    carriers = join_texts(
        shipments.select("order_id", F.trim("carrier").alias("carrier")),
        ["order_id"], "carrier", [], "carriers", sep=",", max_chars=carrier_chars, descending=True, distinct=True,
    )
    recent = trailing_sum(
        lines.withColumn("ordered_on", F.to_date("ordered")),
        ["supplier_id", "part_id"], "ordered_on", "quantity", 30, "last_30_day_qty",
    )
    df = lines.filter(F.col("ordered") >= F.lit(training_start).cast("timestamp_ntz"))
    df = (
        df.withColumn("ordered_on", F.to_date("ordered"))
        .join(per_supplier, "supplier_id", "left")
        .join(recent, ["supplier_id", "part_id", "ordered_on"], "left")
        .join(change_counts, ["order_id", "line_id"], "left")
        .join(event_counts, "order_id", "left")
        .join(carriers, "order_id", "left")
    )
    days_late = F.when(~is_open, F.datediff("received", "due"))
    return df.withColumns(
        {
            "days_late": days_late,
            "is_late": F.when(days_late > 0, "Late").otherwise("OnTime"),
            "lead_time": F.datediff("due", "ordered"),
            "week_due": F.concat(F.lit("Week "), F.lpad(F.weekofyear("due").cast("string"), 2, "0")),
        }
    ).fillna({"open_count": 0, "open_amount": 0.0, "event_count": 0, "change_count": 0, "carriers": "UNKNOWN"})
