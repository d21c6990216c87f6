"""Aggregations, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, columns as cols, picks
from .registry import day_text, query, table


@query(
    "event_totals_by_many_keys",
    "O-69",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, user_id, count(*) AS events, round(sum(value), 2) AS total,
           round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high
    FROM events GROUP BY 1, 2, 3
    """,
)
def event_totals_by_many_keys(spark, sf):
    df = table(spark, sf, "events", "ts", "event_type", "user_id", "value")
    return df.groupBy(day_text("ts").alias("day"), "event_type", "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.round(F.sum("value"), 2).alias("total"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


@query("distinct_part_kinds", "O-70", "SELECT DISTINCT p_name, p_brand, p_type FROM part")
def distinct_part_kinds(spark, sf):
    return table(spark, sf, "part", "p_name", "p_brand", "p_type").distinct()


@query(
    "first_part_of_each_kind",
    "O-70",
    """
    SELECT p_name, p_type, p_partkey FROM
      (SELECT *, row_number() OVER (PARTITION BY p_name, p_type ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r = 1
    """,
)
def first_part_of_each_kind(spark, sf):
    df = table(spark, sf, "part", "p_name", "p_type", "p_retailprice", "p_partkey")
    first = picks.distinct_by(df, ["p_name", "p_type"], [F.desc("p_retailprice"), F.asc("p_partkey")])
    return first.drop("p_retailprice")


@query(
    "joined_line_flags",
    "O-71",
    """
    SELECT l_orderkey, left(string_agg(f, ', ' ORDER BY l_linenumber, f), 3999) AS flags FROM
      (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 5 THEN l_returnflag || l_linestatus END AS f FROM lineitem)
    GROUP BY 1 HAVING count(f) > 0
    """,
)
def joined_line_flags(spark, sf):
    flag = F.when(F.col("l_quantity") > 5, F.concat("l_returnflag", "l_linestatus"))
    df = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    df = df.select("l_orderkey", "l_linenumber", flag.alias("f"))
    return aggregates.join_texts(df, ["l_orderkey"], "f", ["l_linenumber"], "flags")


@query(
    "joined_user_history",
    "O-71",
    """
    SELECT user_id, string_agg(event_type, ', ' ORDER BY ts, event_type) AS history FROM events GROUP BY 1
    """,
)
def joined_user_history(spark, sf):
    df = table(spark, sf, "events", "user_id", "ts", "event_type")
    return aggregates.join_texts(df, ["user_id"], "event_type", ["ts"], "history")


@query(
    "carriers_per_customer",
    "O-71",
    """
    SELECT o_custkey, left(string_agg(p, ',' ORDER BY p DESC), 500) AS carriers
    FROM (SELECT DISTINCT o_custkey, trim(o_orderpriority) AS p FROM orders) GROUP BY 1
    """,
)
def carriers_per_customer(spark, sf):
    df = table(spark, sf, "orders", "o_custkey", "o_orderpriority").select("o_custkey", F.trim("o_orderpriority").alias("p"))
    return aggregates.join_texts(
        df, ["o_custkey"], "p", [], "carriers", sep=",", max_chars=500, descending=True, distinct=True
    )


@query(
    "mixed_aggregates",
    "O-72",
    """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, coalesce(round(sum(CASE WHEN l_quantity > 50 THEN l_quantity END), 2), 0)
      AS oversize, max(l_returnflag) AS last_flag, round(avg(l_discount), 10) AS discount FROM lineitem GROUP BY 1
    """,
)
def mixed_aggregates(spark, sf):
    df = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_discount")
    return df.groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.round(aggregates.sum_or_zero(F.when(F.col("l_quantity") > 50, F.col("l_quantity"))), 2).alias("oversize"),
        F.max("l_returnflag").alias("last_flag"),
        F.round(F.avg("l_discount"), 10).alias("discount"),
    )


@query(
    "uptime_complement",
    "O-73",
    """
    SELECT user_id, round(1.0 - avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS uptime,
      CASE WHEN avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0.2 THEN 'watch' ELSE 'fine' END AS label
    FROM events GROUP BY 1
    """,
)
def uptime_complement(spark, sf):
    down = F.avg(F.when(F.col("event_type") == "error", 1.0).otherwise(0.0))
    return (
        table(spark, sf, "events", "user_id", "event_type")
        .groupBy("user_id")
        .agg(F.round(1.0 - down, 6).alias("uptime"), F.when(down > 0.2, "watch").otherwise("fine").alias("label"))
    )


@query(
    "weighted_price_per_part",
    "O-74",
    """
    WITH a AS (SELECT l_suppkey, l_partkey, l_extendedprice / l_quantity AS price, sum(l_quantity) AS q FROM lineitem GROUP BY ALL),
    b AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS t FROM lineitem GROUP BY ALL)
    SELECT a.l_suppkey, a.l_partkey, round(sum(price * (q / t)) + 0.0000123457, 4) AS unit_price
    FROM a JOIN b ON a.l_suppkey = b.l_suppkey AND a.l_partkey = b.l_partkey GROUP BY ALL
    """,
)
def weighted_price_per_part(spark, sf):
    df = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")
    df = df.withColumn("price", F.try_divide("l_extendedprice", "l_quantity"))
    averaged = aggregates.weighted_average(df, ["l_suppkey", "l_partkey"], "price", "l_quantity", "unit_price")
    # Shifted off the ties that divisors of two produce, so both engines round alike.
    return averaged.withColumn("unit_price", F.round(F.col("unit_price") + 0.0000123457, 4))


@query(
    "dominant_line_number",
    "O-75",
    """
    SELECT l_suppkey, l_linenumber, n AS count FROM (SELECT l_suppkey, l_linenumber, count(*) AS n,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_linenumber) AS r FROM lineitem GROUP BY 1, 2) WHERE r = 1
    """,
)
def dominant_line_number(spark, sf):
    return picks.most_frequent(table(spark, sf, "lineitem", "l_suppkey", "l_linenumber"), ["l_suppkey"], "l_linenumber")


@query(
    "brands_per_supplier",
    "O-76",
    """
    SELECT l_suppkey, string_agg(p_brand, '|' ORDER BY p_brand) AS brands
    FROM (SELECT DISTINCT l_suppkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1
    """,
)
def brands_per_supplier(spark, sf):
    lines = table(spark, sf, "lineitem", "l_suppkey", "l_partkey").distinct()
    parts = table(spark, sf, "part", "p_partkey", "p_brand")
    return aggregates.value_sets(lines.join(parts, lines.l_partkey == parts.p_partkey), ["l_suppkey"], "p_brand", "brands")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "status_by_priority_counts",
    "O-77",
    """
    SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT",
      count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-HIGH", count(*) FILTER (o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
      count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
      count(*) FILTER (o_orderpriority = '5-LOW') AS "5-LOW" FROM orders GROUP BY 1
    """,
)
def status_by_priority_counts(spark, sf):
    return aggregates.cross_tab(
        table(spark, sf, "orders", "o_orderstatus", "o_orderpriority"), "o_orderstatus", "o_orderpriority", PRIORITIES
    )


@query(
    "priority_shares",
    "O-77",
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n,
           round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 9) AS share FROM orders GROUP BY 1, 2
    """,
)
def priority_shares(spark, sf):
    df = table(spark, sf, "orders", "o_orderstatus", "o_orderpriority")
    return aggregates.frequency_shares(df, ["o_orderstatus"], "o_orderpriority").withColumn("share", F.round("share", 9))


@query(
    "newest_order_per_customer",
    "O-78",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1
    """,
)
def newest_order_per_customer(spark, sf):
    df = table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    newest = picks.first_per_key(df, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")])
    return newest.drop("o_orderdate")


@query(
    "site_level_quantity",
    "O-79",
    """
    SELECT p_partkey, p_brand, p_size, CAST(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_brand) AS BIGINT) AS site_size FROM part
    """,
)
def site_level_quantity(spark, sf):
    return aggregates.group_total(table(spark, sf, "part", "p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size", "site_size")


@query(
    "largest_orders",
    "O-80",
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50
    """,
)
def largest_orders(spark, sf):
    df = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    return df.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(50)


@query(
    "appended_frames",
    "O-81 O-25",
    """
    SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::BIGINT AS supplier_id FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL, s_suppkey FROM supplier
    """,
)
def appended_frames(spark, sf):
    people = table(spark, sf, "customer", "c_name", "c_acctbal", "c_mktsegment").toDF("name", "balance", "segment")
    firms = table(spark, sf, "supplier", "s_name", "s_acctbal", "s_suppkey").toDF("name", "balance", "supplier_id")
    return cols.combine_aligned([people, firms], ["name", "balance", "segment", "supplier_id"])


@query(
    "known_prices",
    "O-82",
    """
    SELECT DISTINCT l_partkey AS item_id, l_extendedprice AS price FROM lineitem WHERE l_quantity = 1
    UNION SELECT DISTINCT p_partkey, p_retailprice FROM part
    """,
)
def known_prices(spark, sf):
    sold = table(spark, sf, "lineitem", "l_partkey", "l_extendedprice", "l_quantity").filter("l_quantity = 1")
    listed = table(spark, sf, "part", "p_partkey", "p_retailprice").toDF("item_id", "price")
    return sold.select(F.col("l_partkey").alias("item_id"), F.col("l_extendedprice").alias("price")).union(listed).distinct()
