"""Tool availability by week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.picks import extreme_rows


def weekly_availability(
    hours: DataFrame, site: str, keys: Sequence[str], week: str = "week", entity: str = "entity"
) -> DataFrame:
    """Mean availability, uptime and hours per key, with the week's latest process.

    ``hours`` has ``availability``, ``down_time``, ``started`` and ``process``.
    One function serves every site.
    """
    means = hours.groupBy(*keys).agg(
        F.avg("availability").alias("availability"),
        (1.0 - F.avg("down_time")).alias("uptime"),
        F.count("started").alias("hours"),
    )
    latest = extreme_rows(hours.select(week, entity, "started", "process"), [week, entity], "started")
    return means.join(latest.drop("started"), [week, entity]).withColumn("site", F.lit(site))
