"""Quality issues with their child records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import days_open
from ..functions.text import html_to_text
from ..operators.aggregates import join_texts, sum_or_zero

TEXT_LIMIT = 3999


def enriched_issues(
    issues: DataFrame,
    sites: DataFrame,
    items: DataFrame,
    technologies: DataFrame,
    causes: DataFrame,
    lots: DataFrame,
    as_of: str,
) -> DataFrame:
    """One row per issue with five child tables folded in.

    Each child becomes one row per issue before the join.  Joined texts follow
    the child's ``pos`` and are whole; only the description and the lots are
    trimmed to the target's text limit.  A missing lot text is empty, a missing
    quantity stays null.
    """
    key = ["issue_id"]
    out = issues.withColumns(
        {
            "description": F.left(F.coalesce(html_to_text("description"), F.lit("")), F.lit(TEXT_LIMIT)),
            "input_lag": F.datediff("created", "detected"),
            "close_days": F.datediff("closed", "detected"),
            "days_open": days_open("closed", "created", as_of),
            "weight": F.when(F.col("priority") == "A", 6).when(F.col("priority") == "B", 3).when(F.col("priority") == "C", 1),
            "supplier_responsible": F.when(F.lower("supplier_responsible") == "y", "Yes").when(
                F.col("supplier_responsible").isNotNull(), "No"
            ),
        }
    )
    children = [
        (sites, "site", "sites", None),
        (items, "item", "items", None),
        (technologies, "technology", "technologies", None),
        (causes, "cause", "causes", None),
        (lots, "lot", "lots", TEXT_LIMIT),
    ]
    for child, column, name, limit in children:
        out = out.join(join_texts(child, key, column, ["pos"], name, max_chars=limit), key, "left")
    quantities = lots.groupBy(*key).agg(sum_or_zero("quantity").alias("affected_qty"))
    return out.join(quantities, key, "left").fillna({"lots": ""})
