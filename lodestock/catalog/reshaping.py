"""Pivots, unpivots, sections, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import columns as cols, reshape, rows
from ..session import scratch_path
from .registry import query, table


@query(
    "unpivoted_amounts",
    "O-83 O-30",
    """
    WITH w AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS "2022 Savings", c_acctbal * 2 AS "2023 Savings" FROM customer)
    SELECT id, split_part(variable, ' ', 1) AS year, value AS savings FROM w UNPIVOT INCLUDE NULLS (value FOR variable IN ("2022 Savings", "2023 Savings"))
    """,
)
def unpivoted_amounts(spark, sf):
    wide = table(spark, sf, "customer", "c_custkey", "c_acctbal").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("2022 Savings"),
        (F.col("c_acctbal") * 2).alias("2023 Savings"),
    )
    long = reshape.unpivot(wide, ["id"], cols.columns_starting(wide, "20"), "year", "savings")
    return long.withColumn("year", F.split("year", " ")[0])


SECTIONS_SQL = """
    WITH s AS (SELECT event_id AS row_pos, CASE WHEN value > 250 THEN 'Total' WHEN value < 0.5 THEN 'Demand' ELSE
                 CASE WHEN event_type <> 'view' THEN event_type END END AS label, value AS a, value * 2 AS b FROM events),
    m AS (SELECT *, last_value(CASE label WHEN 'Demand' THEN true WHEN 'Total' THEN false END IGNORE NULLS)
             OVER (ORDER BY row_pos ROWS UNBOUNDED PRECEDING) AS state,
           1 + count(CASE WHEN label = 'Total' THEN 1 END) OVER (ORDER BY row_pos ROWS UNBOUNDED PRECEDING) AS section
          FROM s WHERE label IS NOT NULL),
    k AS (SELECT row_pos, section, label AS segment, a, b FROM m WHERE label NOT IN ('Total', 'Demand') AND coalesce(state, true))
    SELECT row_pos, section, segment, '2021-Q03' AS quarter, a * 1000000.0 AS demand FROM k
    UNION ALL SELECT row_pos, section, segment, '2021-Q04', b * 1000000.0 FROM k
"""


@query("sectioned_sheet", "O-84 O-37 O-47 O-83", SECTIONS_SQL)
def sectioned_sheet(spark, sf):
    label = (
        F.when(F.col("value") > 250, "Total")
        .when(F.col("value") < 0.5, "Demand")
        .otherwise(F.when(F.col("event_type") != "view", F.col("event_type")))
    )
    sheet = table(spark, sf, "events", "event_id", "event_type", "value").select(
        F.col("event_id").alias("row_pos"), label.alias("First_Col"), F.col("value").alias("Q3-21"), (F.col("value") * 2).alias("Q4-21")
    )
    body = rows.section_rows(sheet, "First_Col", "Demand", "Total", active_first=True, block_rows=10_000)
    long = reshape.unpivot(body, ["row_pos", "section", "First_Col"], ["Q3-21", "Q4-21"], "quarter", "demand")
    return long.select(
        "row_pos", "section", F.col("First_Col").alias("segment"), dates.quarter_label("quarter").alias("quarter"),
        (F.col("demand") * 1000000.0).alias("demand"),
    )


@query(
    "quarter_columns",
    "O-85",
    """
    SELECT o_custkey, round(sum(o_totalprice) FILTER (quarter(o_orderdate) = 1), 2) AS "Q1",
      round(sum(o_totalprice) FILTER (quarter(o_orderdate) = 2), 2) AS "Q2", round(sum(o_totalprice) FILTER (quarter(o_orderdate) = 3), 2) AS "Q3",
      round(sum(o_totalprice) FILTER (quarter(o_orderdate) = 4), 2) AS "Q4" FROM orders GROUP BY 1
    """,
)
def quarter_columns(spark, sf):
    df = table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    df = df.withColumn("quarter", F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")))
    wide = reshape.pivot_sum(df, ["o_custkey"], "quarter", ["Q1", "Q2", "Q3", "Q4"], "o_totalprice")
    return wide.withColumns({q: F.round(q, 2) for q in ("Q1", "Q2", "Q3", "Q4")})


@query(
    "attribute_columns",
    "O-86",
    """
    WITH d AS (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders)
    SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (o_orderstatus = 'F') AS finished,
      string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (o_orderstatus = 'O') AS open,
      string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (o_orderstatus = 'P') AS pending
    FROM d GROUP BY 1
    """,
)
def attribute_columns(spark, sf):
    df = table(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    names = {"F": "finished", "O": "open", "P": "pending"}
    return reshape.pivot_texts(df, ["o_custkey"], "o_orderstatus", names, "o_orderpriority")


@query(
    "award_recipients",
    "O-87",
    """
    WITH r AS (SELECT o_orderkey, string_split(upper(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority || ', ' || o_orderstatus
       ELSE o_orderpriority || ', ' || o_orderstatus || ', x' || o_custkey || ', y' END), ', ') AS p FROM orders)
    SELECT o_orderkey, p[1] || ', ' || p[2] AS recipient FROM r
    UNION ALL SELECT o_orderkey, p[3] || ', ' || p[4] FROM r WHERE len(p) > 2
    """,
)
def award_recipients(spark, sf):
    base = F.concat_ws(", ", F.lit("Team list"), "o_orderpriority", "o_orderstatus")
    names = F.when(F.col("o_orderstatus") == "P", base).otherwise(
        F.concat_ws(", ", base, F.concat(F.lit("x"), F.col("o_custkey").cast("string")), F.lit("y"))
    )
    df = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    df = df.select("o_orderkey", names.alias("recipient"))
    return reshape.explode_parts(df, text.tokens_every("recipient", drop_prefix="Team "), "recipient")


@query(
    "map_entries_to_columns",
    "O-88",
    """
    SELECT c_custkey, CAST(CASE WHEN c_acctbal > 5000 THEN c_nationkey ELSE 0 END AS BIGINT) AS alpha,
      CAST(CASE WHEN c_acctbal > 5000 THEN 0 ELSE 2 * c_nationkey END AS BIGINT) AS beta,
      CAST(CASE WHEN c_acctbal > 5000 THEN c_nationkey ELSE 2 * c_nationkey END AS BIGINT) AS total
    FROM customer WHERE c_nationkey > 0
    """,
)
def map_entries_to_columns(spark, sf):
    n = F.col("c_nationkey").cast("long")
    counts = F.when(F.col("c_acctbal") > 5000, F.create_map(F.lit("alpha"), n)).otherwise(F.create_map(F.lit("beta"), n * 2))
    df = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal").select("c_custkey", counts.alias("m"))
    return reshape.unpack_map(df, "m", ["alpha", "beta"], "total")


@query(
    "marked_machines",
    "O-89",
    """
    SELECT o_orderkey, 'etch' AS machine FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'litho' FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT o_orderkey, 'test C4' FROM orders WHERE o_totalprice > 300000
    """,
)
def marked_machines(spark, sf):
    df = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "x").otherwise("  ").alias("etch"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "X").alias("litho"),
        F.when(F.col("o_totalprice") > 300000, "yes").otherwise("").alias("test C4"),
    )
    return reshape.marked_cells(df, ["o_orderkey"], ["etch", "litho", "test C4"])


@query(
    "requests_by_state",
    "O-90",
    """
    WITH r AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'See Notes' ELSE
        CASE WHEN o_totalprice > 100000 THEN 'In work' END END AS status,
      CASE WHEN o_orderpriority < '3' THEN 'Valid' WHEN o_orderpriority < '5' THEN 'Invalid' END AS validity, o_totalprice FROM orders)
    SELECT CASE WHEN lower(status) IN ('complete', 'cancelled') THEN 'complete' WHEN left(validity, 5) <> 'Valid' OR status = 'See Notes'
      THEN 'not_valid' ELSE 'open' END AS state, count(*) AS requests, round(sum(o_totalprice), 2) AS value
    FROM r WHERE status IS NOT NULL AND validity IS NOT NULL GROUP BY 1
    """,
)
def requests_by_state(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "Complete").when(F.col("o_orderstatus") == "O", "See Notes")
    df = table(spark, sf, "orders", "o_orderstatus", "o_orderpriority", "o_totalprice").select(
        status.when(F.col("o_totalprice") > 100000, "In work").alias("status"),
        F.when(F.col("o_orderpriority") < "3", "Valid").when(F.col("o_orderpriority") < "5", "Invalid").alias("validity"),
        "o_totalprice",
    )
    known = df.dropna(subset=["status", "validity"])
    rules = [
        ("complete", F.col("status").isin("Complete", "Cancelled", "complete")),
        ("not_valid", (F.left("validity", F.lit(5)) != "Valid") | (F.col("status") == "See Notes")),
    ]
    split = reshape.split_by_rule(known, rules, "open", "state")
    path = scratch_path(spark, "requests")
    split.write.partitionBy("state").parquet(path)
    parts = spark.read.schema(split.schema).parquet(path)
    return parts.groupBy("state").agg(
        F.count(F.lit(1)).alias("requests"), F.round(F.sum("o_totalprice"), 2).alias("value")
    )
