"""Joins, lookups, trees and scopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, hierarchy, joins, picks, scopes
from ..operators.similarity import group_similar
from ..plans.lateness import late_lines_by_supplier
from ..session import known_size
from .registry import day_text, query, table


@query(
    "late_lines_by_supplier",
    "O-32 O-44 O-56 O-69",
    """
    SELECT s.s_suppkey AS supplier_id, s.s_name AS supplier, n.n_name AS nation, count(*) AS lines,
           count(*) FILTER (date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 60) AS late_lines,
           round(avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))), 6) AS avg_days,
           round(sum(l_extendedprice), 2) AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier s ON l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    WHERE o_orderstatus IN ('F', 'O')
    GROUP BY 1, 2, 3
    """,
)
def late_lines(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    return late_lines_by_supplier(
        table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice"),
        orders.filter(F.col("o_orderstatus").isin("F", "O")),
        table(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey"),
        table(spark, sf, "nation", "n_nationkey", "n_name"),
        limit_days=60,
    )


@query(
    "lines_joined_to_orders_and_parts",
    "O-55",
    """
    SELECT p_brand, o_orderpriority, count(*) AS lines, round(sum(l_quantity), 2) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
    """,
)
def lines_joined(spark, sf):
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    parts = table(spark, sf, "part", "p_partkey", "p_brand")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy("p_brand", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@query(
    "trade_by_nation_pair",
    "O-56",
    """
    SELECT sn.n_name AS supplier_nation, cn.n_name AS customer_nation, count(*) AS lines
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey GROUP BY 1, 2
    """,
)
def trade_by_nation_pair(spark, sf):
    nation = table(spark, sf, "nation", "n_nationkey", "n_name")
    orders = joins.lookup(
        table(spark, sf, "orders", "o_orderkey", "o_custkey"),
        table(spark, sf, "customer", "c_custkey", "c_nationkey"),
        {"o_custkey": "c_custkey"},
        {"c_nationkey": "customer_nation_id"},
    )
    df = joins.lookup(
        table(spark, sf, "lineitem", "l_orderkey", "l_suppkey"),
        orders,
        {"l_orderkey": "o_orderkey"},
        {"customer_nation_id": "customer_nation_id"},
    )
    df = joins.lookup(
        df, table(spark, sf, "supplier", "s_suppkey", "s_nationkey"), {"l_suppkey": "s_suppkey"}, {"s_nationkey": "supplier_nation_id"}
    )
    # Names are attached after the rows have shrunk to one per nation pair.
    counts = df.groupBy("supplier_nation_id", "customer_nation_id").agg(F.count(F.lit(1)).alias("lines"))
    counts = joins.lookup(counts, nation, {"supplier_nation_id": "n_nationkey"}, {"n_name": "supplier_nation"})
    counts = joins.lookup(counts, nation, {"customer_nation_id": "n_nationkey"}, {"n_name": "customer_nation"})
    return counts.select("supplier_nation", "customer_nation", "lines")


SIX_KEYS = ["nation", "segment", "status", "priority", "half", "large"]


@query(
    "null_safe_lookup",
    "O-57",
    """
    WITH base AS (SELECT c_nationkey AS nation, nullif(c_mktsegment, 'MACHINERY') AS segment,
        nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority,
        CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS half, o_totalprice > 250000 AS large,
        o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey),
    firsts AS (SELECT nation, segment, status, priority, half, large, min(o_orderkey) AS site_id FROM base
        WHERE o_totalprice > 100000 GROUP BY ALL)
    SELECT b.o_orderkey, f.site_id FROM base b LEFT JOIN firsts f ON b.nation = f.nation
      AND b.segment IS NOT DISTINCT FROM f.segment AND b.status IS NOT DISTINCT FROM f.status
      AND b.priority IS NOT DISTINCT FROM f.priority AND b.half = f.half AND b.large = f.large
    """,
)
def null_safe_lookup(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    people = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    base = orders.join(people, orders.o_custkey == people.c_custkey).select(
        F.col("c_nationkey").alias("nation"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.when(F.month("o_orderdate") <= 6, 1).otherwise(2).alias("half"),
        (F.col("o_totalprice") > 250000).alias("large"),
        "o_orderkey",
        "o_totalprice",
    )
    firsts = base.filter("o_totalprice > 100000").groupBy(*SIX_KEYS).agg(F.min("o_orderkey").alias("site_id"))
    return joins.join_null_safe(base, firsts, SIX_KEYS).select("o_orderkey", "site_id")


@query(
    "two_years_side_by_side",
    "O-58",
    """
    WITH a AS (SELECT o_custkey, count(*) AS orders_1996 FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1),
         b AS (SELECT o_custkey, count(*) AS orders_1997 FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1)
    SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, orders_1996, orders_1997
    FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey
    """,
)
def two_years_side_by_side(spark, sf):
    orders = table(spark, sf, "orders", "o_custkey", "o_orderdate")

    def year(y):
        d = F.col("o_orderdate")
        inside = (d >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & (d < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
        return orders.filter(inside).groupBy("o_custkey").agg(F.count(F.lit(1)).alias(f"orders_{y}"))

    return joins.join_outer(year(1996), year(1997), ["o_custkey"])


@query(
    "trailing_thirty_day_quantity",
    "O-59",
    """
    WITH l AS (SELECT l_suppkey, p_type, CAST(l_shipdate AS DATE) AS d, l_quantity, l_returnflag
               FROM lineitem JOIN part ON l_partkey = p_partkey),
    a AS (SELECT l_suppkey, p_type, d, sum(l_quantity) AS q FROM l WHERE l_returnflag <> 'R' GROUP BY ALL),
    b AS (SELECT l_suppkey, p_type, d, count(*) AS n FROM l GROUP BY ALL)
    SELECT b.l_suppkey, b.p_type, strftime(b.d, '%Y-%m-%d') AS day, round(sum(a.q) * any_value(b.n), 2) AS last_30_day_qty
    FROM b JOIN a ON a.l_suppkey = b.l_suppkey AND a.p_type = b.p_type AND a.d BETWEEN b.d - 30 AND b.d
    GROUP BY b.l_suppkey, b.p_type, b.d
    """,
)
def trailing_thirty_day_quantity(spark, sf):
    lines = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_returnflag")
    parts = table(spark, sf, "part", "p_partkey", "p_type")
    typed = lines.join(parts, lines.l_partkey == parts.p_partkey).withColumn("day", F.to_date("l_shipdate"))
    sums = joins.trailing_sum(
        typed, ["l_suppkey", "p_type"], "day", "l_quantity", 30, "q", rows_where=F.col("l_returnflag") != "R"
    )
    return sums.select("l_suppkey", "p_type", day_text("day").alias("day"), F.round("q", 2).alias("last_30_day_qty"))


@query(
    "parts_with_returns",
    "O-60",
    """
    SELECT p_partkey, p_name FROM part WHERE p_partkey IN
      (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)
    """,
)
def parts_with_returns(spark, sf):
    lines = table(spark, sf, "lineitem", "l_partkey", "l_returnflag", "l_quantity")
    returned = lines.filter("l_returnflag = 'R' AND l_quantity > 45")
    return joins.keep_members(table(spark, sf, "part", "p_partkey", "p_name"), returned, {"p_partkey": "l_partkey"})


@query(
    "returns_by_age_per_part",
    "O-61",
    """
    SELECT p_partkey,
      (SELECT sum(l_quantity) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R'
         AND date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-10') > 14) AS aging,
      (SELECT sum(l_quantity) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R'
         AND date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-10') < 14) AS not_aging,
      (SELECT strftime(min(l_shipdate), '%Y-%m-%d') FROM lineitem WHERE l_partkey = p_partkey AND l_linestatus = 'O') AS oldest
    FROM part
    """,
)
def returns_by_age_per_part(spark, sf):
    lines = table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    age = F.datediff(F.lit("2001-11-10").cast("date"), "l_shipdate")
    returned = F.col("l_returnflag") == "R"
    totals = {
        "aging": F.sum(F.when(returned & (age > 14), F.col("l_quantity"))),
        "not_aging": F.sum(F.when(returned & (age < 14), F.col("l_quantity"))),
        "oldest": day_text(F.min(F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")))),
    }
    return joins.per_key_totals(table(spark, sf, "part", "p_partkey"), lines, {"p_partkey": "l_partkey"}, totals)


@query(
    "orders_in_last_periods",
    "O-62",
    """
    WITH w AS (SELECT DISTINCT year(o_orderdate) * 100 + month(o_orderdate) AS period FROM orders),
    o AS (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS period, o_totalprice FROM orders)
    SELECT CAST(period AS BIGINT) AS period, count(*) AS orders, round(sum(o_totalprice), 2) AS value FROM o
    WHERE period >= (SELECT max(period) - 100 FROM w) AND period < (SELECT max(period) FROM w) GROUP BY 1
    """,
)
def orders_in_last_periods(spark, sf):
    period = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long")
    orders = table(spark, sf, "orders", "o_orderdate", "o_totalprice").withColumn("period", period)
    calendar = orders.select("period").distinct()
    recent = joins.within_period(orders, "period", calendar, F.max("period") - 100, F.max("period"))
    return recent.groupBy("period").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value")
    )


@query(
    "latest_orders_with_ties",
    "O-63",
    """
    SELECT o_orderpriority, o_custkey, o_orderkey FROM orders o
    JOIN (SELECT o_custkey AS k, max(o_orderdate) AS m FROM orders GROUP BY 1) x ON o_custkey = k AND o_orderdate = m
    """,
)
def latest_orders_with_ties(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return picks.extreme_rows(orders, ["o_custkey"], "o_orderdate").drop("o_orderdate")


@query(
    "values_at_weekly_rates",
    "O-64",
    """
    WITH cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d,
                   CAST(isoyear(o_orderdate) * 100 + weekofyear(o_orderdate) AS BIGINT) AS year_week FROM orders),
    fx AS (SELECT year_week, o_orderpriority AS cur, 1 + avg(o_totalprice) / 1000000 AS rate
           FROM orders JOIN cal ON CAST(o_orderdate AS DATE) = d GROUP BY 1, 2),
    o AS (SELECT year_week, o_orderpriority AS cur, o_totalprice FROM orders JOIN cal ON CAST(o_orderdate AS DATE) = d)
    SELECT o.year_week, count(*) AS orders, round(sum(o_totalprice * CASE WHEN o.cur = '1-URGENT' THEN 1 ELSE rate END), 2) AS usd
    FROM o LEFT JOIN fx ON o.year_week = fx.year_week AND o.cur = fx.cur GROUP BY 1
    """,
)
def values_at_weekly_rates(spark, sf):
    orders = table(spark, sf, "orders", "o_orderdate", "o_orderpriority", "o_totalprice").select(
        F.to_date("o_orderdate").alias("d"), F.col("o_orderpriority").alias("cur"), "o_totalprice"
    )
    week = F.expr("extract(YEAROFWEEK FROM d)") * 100 + F.weekofyear("d")
    calendar = orders.select("d").distinct().select("d", week.cast("long").alias("year_week"))
    calendar = known_size(calendar)  # one row per day
    dated = orders.join(calendar, "d")
    rates = dated.groupBy("year_week", "cur").agg((1 + F.avg("o_totalprice") / 1000000).alias("rate"))
    priced = dated.join(known_size(rates), ["year_week", "cur"], "left")
    rate = F.when(F.col("cur") == "1-URGENT", 1.0).otherwise(F.col("rate"))
    return priced.groupBy("year_week").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum(F.col("o_totalprice") * rate), 2).alias("usd")
    )


TREE_SQL = """
    edges AS (
      SELECT 'R' || n_regionkey AS parent, 'N' || n_nationkey AS child, CAST(1 AS DOUBLE) AS qty FROM nation
      UNION ALL SELECT 'N' || s_nationkey, 'S' || s_suppkey, 1 FROM supplier
      UNION ALL SELECT 'S' || l_suppkey, 'P' || l_partkey, round(sum(l_quantity), 2) FROM lineitem GROUP BY 1, 2)
"""


def tree_edges(spark, sf):
    """Region, nation, supplier and part as parent-child edges."""
    nation = table(spark, sf, "nation", "n_nationkey", "n_regionkey").select(
        F.concat(F.lit("R"), "n_regionkey").alias("parent"), F.concat(F.lit("N"), "n_nationkey").alias("child"), F.lit(1.0).alias("qty")
    )
    supplier = table(spark, sf, "supplier", "s_suppkey", "s_nationkey").select(
        F.concat(F.lit("N"), "s_nationkey").alias("parent"), F.concat(F.lit("S"), "s_suppkey").alias("child"), F.lit(1.0).alias("qty")
    )
    parts = (
        table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.round(F.sum("l_quantity"), 2).alias("qty"))
        .select(F.concat(F.lit("S"), "l_suppkey").alias("parent"), F.concat(F.lit("P"), "l_partkey").alias("child"), "qty")
    )
    return nation.unionByName(supplier).unionByName(parts)


@query(
    "values_at_last_known_rates",
    "O-64 O-19",
    """
    WITH r AS (SELECT l_suppkey % 5 AS area, CAST(l_shipdate AS DATE) AS day, CAST(count(*) AS INTEGER) AS rate FROM lineitem
               WHERE day(l_shipdate) = 1 GROUP BY ALL),
    o AS (SELECT o_orderkey, o_custkey % 5 AS area, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders)
    SELECT o_orderkey, rate, round(o_totalprice * rate, 2) AS value
    FROM o ASOF LEFT JOIN r ON o.area = r.area AND o.day >= r.day
    """,
)
def values_at_last_known_rates(spark, sf):
    """Order values at the rate that was in force on the day: the last one set on or before it."""
    lines = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate").filter(F.dayofmonth("l_shipdate") == 1)
    rates = lines.groupBy((F.col("l_suppkey") % 5).alias("area"), F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).cast("int").alias("rate"))
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").select(
        "o_orderkey", (F.col("o_custkey") % 5).alias("area"), F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    valued = asof.as_of_join(orders, rates, ["area"], "day", "day", ["rate"], strict=False)
    return valued.select("o_orderkey", "rate", F.round(F.col("o_totalprice") * F.col("rate"), 2).alias("value"))


@query(
    "flattened_tree",
    "O-65",
    "WITH RECURSIVE" + TREE_SQL + """,
    flat AS (
      SELECT parent AS root, parent, child, qty, 1 AS depth FROM edges WHERE parent IN (SELECT 'R' || r_regionkey FROM region)
      UNION ALL
      SELECT f.root, e.parent, e.child, e.qty, f.depth + 1 FROM flat f JOIN edges e ON e.parent = f.child WHERE f.depth < 3)
    SELECT DISTINCT root, parent, child, qty, depth FROM flat
    """,
)
def flattened_tree(spark, sf):
    roots = table(spark, sf, "region", "r_regionkey").select(F.concat(F.lit("R"), "r_regionkey").alias("root"))
    return hierarchy.distinct_edges(hierarchy.flatten_tree(tree_edges(spark, sf), roots))


@query(
    "tree_by_recursion",
    "O-65",
    "WITH RECURSIVE" + TREE_SQL + """,
    flat AS (
      SELECT parent AS root, parent, child, qty, 1 AS depth FROM edges WHERE parent IN (SELECT 'R' || r_regionkey FROM region)
      UNION ALL
      SELECT f.root, e.parent, e.child, e.qty, f.depth + 1 FROM flat f JOIN edges e ON e.parent = f.child WHERE f.depth < 3)
    SELECT DISTINCT root, parent, child, qty, depth FROM flat
    """,
)
def tree_by_recursion(spark, sf):
    roots = table(spark, sf, "region", "r_regionkey").select(F.concat(F.lit("R"), "r_regionkey").alias("root"))
    return hierarchy.distinct_edges(hierarchy.flatten_tree_recursive(tree_edges(spark, sf), roots))


@query(
    "cycles_in_part_links",
    "O-65",
    """
    WITH RECURSIVE e AS (
      SELECT p_partkey AS parent, p_partkey // 10 * 10 + (p_partkey % 10 * (p_partkey % 10) + 1) % 10 AS child FROM part WHERE p_partkey % 7 <> 3
      UNION ALL SELECT p_partkey, -p_partkey FROM part),
    r AS (SELECT parent, child FROM e UNION SELECT r.parent, e.child FROM r JOIN e ON r.child = e.parent)
    SELECT DISTINCT e.parent, e.child FROM e JOIN r ON r.parent = e.child AND r.child = e.parent
    """,
)
def cycles_in_part_links(spark, sf):
    """Parts that name each other in rings of their ten, with tails and leaves; some rings are broken."""
    parts = table(spark, sf, "part", "p_partkey").select(F.col("p_partkey").alias("parent"))
    own = F.col("parent") % 10
    ring = parts.filter("parent % 7 <> 3").withColumn("child", F.expr("parent div 10 * 10") + (own * own + 1) % 10)
    leaves = parts.withColumn("child", -F.col("parent"))
    return hierarchy.cyclic_edges(ring.unionByName(leaves))


@query(
    "first_wanted_level",
    "O-66",
    "WITH" + TREE_SQL + """,
    hit AS (SELECT parent, child, (child LIKE '%7' OR child IN ('N3', 'S41')) AS h FROM edges)
    SELECT DISTINCT b1.parent AS root, CASE WHEN b1.h THEN b1.child WHEN b2.h THEN b2.child WHEN b3.h THEN b3.child END AS match
    FROM hit b1 JOIN hit b2 ON b2.parent = b1.child JOIN hit b3 ON b3.parent = b2.child
    WHERE b1.h OR b2.h OR b3.h
    """,
)
def first_wanted_level(spark, sf):
    wanted = F.col("node").like("%7") | F.col("node").isin("N3", "S41")
    return hierarchy.first_matching_level(tree_edges(spark, sf), wanted)


@query(
    "supplier_score_lookup",
    "O-67",
    """
    WITH s AS (SELECT l_suppkey, round(sum(CASE WHEN quarter(l_shipdate) = 1 THEN l_quantity END), 2) AS q1,
                 round(sum(CASE WHEN quarter(l_shipdate) = 2 THEN l_quantity END), 2) AS q2
               FROM lineitem WHERE year(l_shipdate) = 1996 GROUP BY 1)
    SELECT s_suppkey, s_name, q1, q2 FROM supplier LEFT JOIN s ON s_suppkey = l_suppkey AND s_acctbal > 0
    """,
)
def supplier_score_lookup(spark, sf):
    lines = table(spark, sf, "lineitem", "l_suppkey", "l_quantity", "l_shipdate")
    low, high = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (1996, 1997))
    scores = (
        lines.filter((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high))
        .groupBy("l_suppkey")
        .agg(*[F.round(F.sum(F.when(F.quarter("l_shipdate") == q, F.col("l_quantity"))), 2).alias(f"q{q}") for q in (1, 2)])
    )
    suppliers = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_acctbal")
    known = suppliers.withColumn("_id", F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")))
    found = joins.lookup(known, scores, {"_id": "l_suppkey"}, {"q1": "q1", "q2": "q2"})
    return found.select("s_suppkey", "s_name", "q1", "q2")


SCOPE_TEXTS = ["1272", "1272 C4", "All 1272", "1227 & 1272", "1272 C4 & 1274 C4", "All 1274 & All 1276",
               "1227 & 1274 & 1276", "All C4", "All Non-C4", "All Processes", "unknown"]


@query(
    "machines_in_scope",
    "O-68",
    """
    WITH m AS (SELECT p_partkey // 100 AS sheet, p_partkey || ' ' || CASE p_size % 5 WHEN 0 THEN '1272' WHEN 1 THEN '1274'
          WHEN 2 THEN '1276' WHEN 3 THEN '1227' ELSE '1272/1274' END || CASE WHEN p_retailprice % 2 < 1 THEN ' C4' ELSE '' END AS machine FROM part),
    r AS (SELECT c_custkey, c_custkey // 100 AS sheet,
      (['1272', '1272 C4', 'All 1272', '1227 & 1272', '1272 C4 & 1274 C4', 'All 1274 & All 1276', '1227 & 1274 & 1276',
        'All C4', 'All Non-C4', 'All Processes', 'unknown'])[1 + c_custkey % 11] AS scope FROM customer)
    SELECT c_custkey, scope, machine FROM r JOIN m ON r.sheet = m.sheet
    WHERE CASE scope
      WHEN '1272' THEN machine LIKE '%1272%' AND machine NOT LIKE '%C4%'
      WHEN '1272 C4' THEN machine LIKE '%1272%' AND machine LIKE '%C4%'
      WHEN 'All 1272' THEN machine LIKE '%1272%'
      WHEN '1227 & 1272' THEN (machine LIKE '%1227%' OR machine LIKE '%1272%') AND machine NOT LIKE '%C4%'
      WHEN '1272 C4 & 1274 C4' THEN (machine LIKE '%1272%' OR machine LIKE '%1274%') AND machine LIKE '%C4%'
      WHEN 'All 1274 & All 1276' THEN machine LIKE '%1274%' OR machine LIKE '%1276%'
      WHEN '1227 & 1274 & 1276' THEN (machine LIKE '%1227%' OR machine LIKE '%1274%' OR machine LIKE '%1276%') AND machine NOT LIKE '%C4%'
      WHEN 'All C4' THEN machine LIKE '%C4%' WHEN 'All Non-C4' THEN machine NOT LIKE '%C4%'
      WHEN 'All Processes' THEN true ELSE false END
    """,
)
def machines_in_scope(spark, sf):
    code = F.element_at(F.array(*[F.lit(c) for c in ("1272", "1274", "1276", "1227", "1272/1274")]), F.col("p_size") % 5 + 1)
    mark = F.when(F.col("p_retailprice") % 2 < 1, " C4").otherwise("")
    machines = table(spark, sf, "part", "p_partkey", "p_size", "p_retailprice").select(
        F.floor(F.col("p_partkey") / 100).alias("sheet"),
        F.concat(F.col("p_partkey").cast("string"), F.lit(" "), code, mark).alias("machine"),
    )
    texts = F.array(*[F.lit(s) for s in SCOPE_TEXTS])
    requests = table(spark, sf, "customer", "c_custkey").select(
        "c_custkey",
        F.floor(F.col("c_custkey") / 100).alias("sheet"),
        F.element_at(texts, (F.col("c_custkey") % 11 + 1).cast("int")).alias("scope"),
    )
    return scopes.expand_scopes(requests, machines, "scope", "machine", ["sheet"]).drop("sheet")


@query(
    "similar_names",
    "O-100",
    """
    WITH RECURSIVE n AS (SELECT DISTINCT trim(url) AS name FROM pages),
    e AS (SELECT a.name AS a, b.name AS b FROM n a JOIN n b ON a.name <> b.name
          AND levenshtein(a.name, b.name) <= greatest(length(a.name), length(b.name)) * 10 // 100),
    reach AS (SELECT name AS a, name AS b FROM n UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b)
    SELECT a AS name, min(b) AS group_key FROM reach GROUP BY a
    """,
)
def similar_names(spark, sf):
    return group_similar(table(spark, sf, "pages", "url").select(F.col("url").alias("name")))
