"""Headline queries: prints one JSON line with seconds per query.

Each query is run once to warm up and once timed; a timed run writes to the
``noop`` sink, so every column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestock.catalog import QUERIES  # noqa: E402
from lodestock.session import build_session, drop_scratch  # noqa: E402

HEADLINE = [
    "late_lines_by_supplier",
    "lines_joined_to_orders_and_parts",
    "trade_by_nation_pair",
    "null_safe_lookup",
    "trailing_thirty_day_quantity",
    "returns_by_age_per_part",
    "latest_orders_with_ties",
    "values_at_weekly_rates",
    "flattened_tree",
    "machines_in_scope",
    "forward_filled_labels",
    "sectioned_sheet",
    "joined_line_flags",
    "weighted_price_per_part",
    "brands_per_supplier",
    "quarter_columns",
    "page_texts",
    "document_profile",
    "line_quantiles",
    "phrase_counts_per_document",
    "contract_price_columns",
    "order_line_lateness_features",
    "unit_cost_by_model",
    "repairable_stock_dispositions",
    "weekly_tool_availability",
    "issues_with_children",
    "replaced_year",
    "audited_table_load",
    "similar_names",
    "days_picked_up_by_stream",
    "records_from_json_pages",
    "open_lines_scored",
    "lateness_classifier_scores",
    "clustered_nations",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
        drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, second run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
