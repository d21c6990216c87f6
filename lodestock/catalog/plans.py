"""Business plans over frames derived from the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import text
from ..plans import availability, contracts, costs, incidents, issues, lateness, market, phrases, stock, survey, tools
from ..session import known_size
from .registry import day_text, query, table

AS_OF = "2001-11-10"


@query(
    "repairable_stock_dispositions",
    "O-91 O-61 O-36",
    """
    WITH f AS (SELECT l_partkey AS item, sum(l_quantity) FILTER (l_returnflag = 'A') AS avail_qty,
        sum(l_quantity) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS open_po_qty,
        coalesce(sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'O'), 0) AS reject_qty,
        coalesce(sum(l_quantity) FILTER (l_linenumber = 7), 0) AS open_order_qty,
        min(l_shipdate) FILTER (l_linenumber = 7 AND l_shipdate >= TIMESTAMP '2001-06-01') AS oldest_order,
        sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'F' AND date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-10') > 14) AS a,
        sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'F' AND date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-10') < 14) AS na,
        sum(l_quantity) FILTER (l_linenumber = 6 AND l_quantity > 40) AS excess FROM lineitem GROUP BY 1),
    s AS (SELECT p_partkey AS item, coalesce(avail_qty, 0) + coalesce(open_po_qty, 0) AS supply, p_size * 20 + open_order_qty AS demand,
        reject_qty, open_order_qty, coalesce(a, 0) AS a, coalesce(na, 0) AS na, coalesce(excess, 0) AS ex, oldest_order,
        p_type = 'SMALL' AS ih, p_retailprice / 100 AS price FROM part JOIN f ON p_partkey = item),
    m AS (SELECT *, demand - supply AS missing, greatest(demand - supply - reject_qty, 0) AS m1, greatest(demand - supply - reject_qty - a - na, 0) AS m2,
        greatest(demand - supply - reject_qty - a - na - ex, 0) AS m3, ih AND open_order_qty = 0 AS idle FROM s WHERE demand - supply > 0),
    d AS (SELECT *, CASE WHEN NOT idle AND reject_qty > 0 THEN '1-Release Repair PO' ELSE '' END AS d1,
        CASE WHEN NOT idle AND m1 > 0 AND a + na > 0 THEN ';2-Facilitate NRR Returns' ELSE '' END AS d2,
        CASE WHEN NOT idle AND m2 > 0 AND ex > 0 THEN ';3-Initiate Excess Transfer' ELSE '' END AS d3,
        CASE WHEN NOT idle AND m3 > 0 AND price * m3 > 0 AND price * m3 < 2000 AND NOT ih THEN ';4-Release New Buy PO' ELSE '' END AS d4,
        CASE WHEN NOT idle AND m3 > 0 AND price * m3 > 2000 THEN ';5-Require CostRep Disposition (NB/Algo/Backorder)' ELSE '' END AS d5 FROM m)
    SELECT item, missing AS missing_qty, m3 AS missing_after_excess, round(price * m3, 4) AS missing_amount,
      CASE WHEN open_order_qty = 0 OR oldest_order IS NULL THEN '' WHEN date_diff('day', CAST(oldest_order AS DATE), DATE '2001-11-10') < 8
        THEN 'NotAging(<7days)' ELSE 'Aging' END AS backorder_age,
      CASE WHEN a <> 0 AND na <> 0 THEN 'AGING and NOT_AGING' WHEN a <> 0 THEN 'Aging' WHEN na <> 0 THEN 'NotAging(<7days)' ELSE '' END AS nrr_age,
      CASE WHEN idle THEN '0-No Action' ELSE d1 || d2 || d3 || d4 || d5 END AS disposition,
      CASE WHEN idle THEN m3 ELSE 0 END AS final_missing_qty
    FROM d
    """,
)
def repairable_stock_dispositions(spark, sf):
    lines = table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate")
    qty = F.col("l_quantity")
    flag, status, number = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    on_hand = lines.groupBy(F.col("l_partkey").alias("item")).agg(
        F.sum(F.when(flag == "A", qty)).alias("avail_qty"),
        F.sum(F.when((flag == "N") & (status == "O"), qty)).alias("open_po_qty"),
        F.coalesce(F.sum(F.when((flag == "R") & (status == "O"), qty)), F.lit(0)).alias("reject_qty"),
        F.coalesce(F.sum(F.when(number == 7, qty)), F.lit(0)).alias("open_order_qty"),
        F.min(
            F.when((number == 7) & (F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")), F.col("l_shipdate"))
        ).alias("oldest_order"),
    )
    parts = table(spark, sf, "part", "p_partkey", "p_size", "p_type", "p_retailprice").select(
        F.col("p_partkey").alias("item"),
        (F.col("p_size") * 20).alias("max_qty"),
        F.when(F.col("p_type") == "SMALL", "x In House Repair").otherwise(F.col("p_type")).alias("category"),
        (F.col("p_retailprice") / 100).alias("new_price"),
    )
    as_of = F.lit(AS_OF).cast("date")
    returns = lines.filter((flag == "R") & (status == "F")).select(
        F.col("l_partkey").alias("part"), qty.alias("return_qty"), F.col("l_shipdate").alias("returned_on")
    )
    rows = stock.open_returns(parts.join(on_hand, "item"), returns, as_of, {"item": "part"})
    excess = lines.filter((number == 6) & (qty > 40)).groupBy(F.col("l_partkey").alias("item")).agg(F.sum(qty).alias("excess_qty"))
    out = stock.dispositions(rows, excess, as_of)
    return out.select(
        "item", "missing_qty", "missing_after_excess", F.round("missing_amount", 4).alias("missing_amount"),
        "backorder_age", "nrr_age", "disposition", F.col("final_missing_qty").cast("double").alias("final_missing_qty"),
    )


@query(
    "weekly_tool_availability",
    "O-92 O-63 O-69 O-73",
    """
    WITH h AS (SELECT CAST(isoyear(ts) * 100 + weekofyear(ts) AS BIGINT) AS week, user_id AS entity, event_type AS ceid, value / 500 AS av,
                 CASE WHEN event_type = 'error' THEN 1.0 ELSE value / 1000 END AS down, ts, props FROM events),
    g AS (SELECT week, entity, ceid, round(avg(av), 9) AS availability, round(1.0 - avg(down), 9) AS uptime, count(ts) AS hours FROM h GROUP BY ALL),
    m AS (SELECT week, entity, max(ts) AS ts FROM h GROUP BY ALL)
    SELECT g.*, h.props AS process, 'S1' AS site FROM g JOIN m ON g.week = m.week AND g.entity = m.entity
    JOIN h ON h.week = m.week AND h.entity = m.entity AND h.ts = m.ts
    """,
)
def weekly_tool_availability(spark, sf):
    week = F.expr("extract(YEAROFWEEK FROM ts)") * 100 + F.weekofyear("ts")
    hours = table(spark, sf, "events", "ts", "user_id", "event_type", "value", "props").select(
        week.cast("long").alias("week"),
        F.col("user_id").alias("entity"),
        F.col("event_type").alias("ceid"),
        (F.col("value") / 500).alias("availability"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(F.col("value") / 1000).alias("down_time"),
        F.col("ts").alias("started"),
        F.col("props").alias("process"),
    )
    out = availability.weekly_availability(hours, "S1", ["week", "entity", "ceid"])
    return out.withColumns({"availability": F.round("availability", 9), "uptime": F.round("uptime", 9)})


@query(
    "order_line_lateness_features",
    "O-93 O-59 O-69 O-71",
    """
    WITH l AS (SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_suppkey AS supplier_id, l_partkey AS part_id, o_orderdate AS ordered,
        CAST(CAST(o_orderdate AS DATE) + 60 AS TIMESTAMP) AS due, l_shipdate AS received,
        CASE WHEN l_linestatus = 'F' THEN 'COMPLETE' WHEN l_returnflag = 'N' THEN 'PARTIAL' ELSE 'OPEN' END AS status,
        l_quantity AS quantity, l_extendedprice AS amount, o_custkey, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    s AS (SELECT supplier_id, count(*) AS open_count, round(sum(amount), 2) AS open_amount FROM l WHERE status IN ('OPEN', 'PARTIAL') GROUP BY 1),
    e AS (SELECT o_orderkey AS order_id, count(*) AS n FROM events JOIN orders ON o_orderkey = event_id WHERE event_type IN ('error', 'view') GROUP BY 1),
    c AS (SELECT order_id, line_id, count(*) AS n FROM l WHERE l_returnflag = 'R' GROUP BY ALL),
    k AS (SELECT order_id, string_agg(f, ',' ORDER BY f DESC) AS carriers FROM (SELECT DISTINCT order_id, trim(l_returnflag) AS f FROM l) GROUP BY 1),
    d AS (SELECT supplier_id, part_id, CAST(ordered AS DATE) AS d, sum(quantity) AS q, count(*) AS n FROM l GROUP BY ALL),
    r AS (SELECT b.supplier_id, b.part_id, b.d, round(sum(a.q) * any_value(b.n), 2) AS last_30_day_qty FROM d b JOIN d a
          ON a.supplier_id = b.supplier_id AND a.part_id = b.part_id AND a.d BETWEEN b.d - 30 AND b.d GROUP BY ALL)
    SELECT l.order_id, l.line_id, l.supplier_id, l.part_id, l.quantity,
      CAST(CASE WHEN status NOT IN ('OPEN', 'PARTIAL') THEN date_diff('day', CAST(due AS DATE), CAST(received AS DATE)) END AS INTEGER) AS days_late,
      CASE WHEN status NOT IN ('OPEN', 'PARTIAL') AND received > due THEN 'Late' ELSE 'OnTime' END AS is_late,
      coalesce(s.open_count, 0) AS open_count, coalesce(s.open_amount, 0) AS open_amount, coalesce(e.n, 0) AS event_count,
      coalesce(c.n, 0) AS change_count, coalesce(k.carriers, 'UNKNOWN') AS carriers, r.last_30_day_qty,
      'Week ' || lpad(CAST(weekofyear(due) AS VARCHAR), 2, '0') AS week_due
    FROM l LEFT JOIN s ON l.supplier_id = s.supplier_id LEFT JOIN e ON l.order_id = e.order_id
    LEFT JOIN c ON l.order_id = c.order_id AND l.line_id = c.line_id LEFT JOIN k ON l.order_id = k.order_id
    LEFT JOIN r ON l.supplier_id = r.supplier_id AND l.part_id = r.part_id AND CAST(l.ordered AS DATE) = r.d
    WHERE l.ordered >= TIMESTAMP '1999-01-01'
    """,
)
def order_line_lateness_features(spark, sf):
    out = lateness_frame(spark, sf, "1999-01-01")
    return out.select(
        "order_id", "line_id", "supplier_id", "part_id", "quantity", "days_late", "is_late", "open_count",
        F.round("open_amount", 2).alias("open_amount"), "event_count", "change_count", "carriers",
        F.round("last_30_day_qty", 2).alias("last_30_day_qty"), "week_due",
    )


def lateness_frame(spark, sf, start):
    """Lateness features from the order tables."""
    lines = table(
        spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate",
        "l_linestatus", "l_returnflag", "l_quantity", "l_extendedprice",
    )
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    status = F.when(F.col("l_linestatus") == "F", "COMPLETE").when(F.col("l_returnflag") == "N", "PARTIAL").otherwise("OPEN")
    frame = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("o_orderdate").alias("ordered"),
        F.date_add("o_orderdate", 60).alias("due"),
        F.col("l_shipdate").alias("received"),
        status.alias("status"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
    )
    events = table(spark, sf, "events", "event_id", "event_type").filter(F.col("event_type").isin("error", "view"))
    events = events.join(orders, events.event_id == orders.o_orderkey).select(F.col("o_orderkey").alias("order_id"))
    changes = lines.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"))
    shipments = lines.select(F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("carrier"))
    return lateness.lateness_features(frame, events, changes, shipments, start)


@query(
    "unit_cost_by_model",
    "O-94 O-64 O-74 O-81",
    """
    WITH o AS (SELECT l_partkey AS item, l_suppkey % 25 AS plant, l_quantity AS q, l_extendedprice AS amt, l_returnflag AS f,
        CAST(isoyear(l_shipdate) * 100 + weekofyear(l_shipdate) AS BIGINT) AS wk, l_shipdate FROM lineitem),
    fx AS (SELECT wk, 1 + avg(q) / 100 AS rate FROM o GROUP BY 1),
    std AS (SELECT plant, item, avg(amt / q * CASE WHEN f = 'A' THEN 1 ELSE rate END / 10) AS c, max(l_shipdate) AS u FROM o JOIN fx USING (wk) WHERE f <> 'R' GROUP BY ALL),
    wa AS (SELECT plant, item, sum(amt / q * q) / sum(q) AS c FROM o GROUP BY ALL),
    fv AS (SELECT plant, item, avg(amt / q) AS c FROM o WHERE f = 'R' GROUP BY ALL)
    SELECT 'Standard Cost' AS model, plant, item, round(c + 0.0000123457, 4) AS unit_cost, strftime(u, '%Y-%m-%d') AS last_updated FROM std
    UNION ALL SELECT 'Weighted Average', plant, item, round(c + 0.0000123457, 4), NULL FROM wa
    UNION ALL SELECT 'Fair Market Value', plant, item, round(c + 0.0000123457, 4), NULL FROM fv
    """,
)
def unit_cost_by_model(spark, sf):
    week = (F.expr("extract(YEAROFWEEK FROM l_shipdate)") * 100 + F.weekofyear("l_shipdate")).cast("long")
    lines = table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate").select(
        F.col("l_partkey").alias("item"),
        (F.col("l_suppkey") % 25).alias("plant"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
        "l_returnflag",
        week.alias("year_week"),
        F.col("l_shipdate").alias("as_of"),
    )
    rates = lines.groupBy("year_week").agg((1 + F.avg("quantity") / 100).alias("rate")).withColumn("currency", F.lit("EUR"))
    rates = known_size(rates)  # one row per week
    standard = lines.filter("l_returnflag <> 'R'").select(
        "plant", "item", (F.col("amount") / F.col("quantity")).alias("price"), F.lit(10).alias("price_unit"),
        F.when(F.col("l_returnflag") == "A", "USD").otherwise("EUR").alias("currency"), "year_week", "as_of",
    )
    fair = lines.filter("l_returnflag = 'R'").select("plant", "item", (F.col("amount") / F.col("quantity")).alias("value"))
    out = costs.unit_costs(standard, rates, lines.select("plant", "item", "quantity", "amount"), fair)
    # Shifted off the ties that divisors of two produce, so both engines round alike.
    cost = F.round(F.col("unit_cost") + 0.0000123457, 4).alias("unit_cost")
    return out.select("model", "plant", "item", cost, day_text("last_updated").alias("last_updated"))


@query(
    "issues_with_children",
    "O-95 O-42 O-44 O-71 O-72",
    """
    WITH i AS (SELECT conv_id AS issue_id, max(CASE WHEN turn = 0 THEN text END) AS t FROM conversations GROUP BY 1),
    b AS (SELECT issue_id, left(coalesce(replace(replace(regexp_replace('<p>' || replace(replace(t, '<', ' '), '&', '+') || ' &lt;b&gt;</p>', '(?s)<[!/a-zA-Z][^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), ''), 3999) AS description,
           DATE '2024-01-01' + CAST(issue_id % 50 AS INTEGER) AS detected, DATE '2024-01-03' + CAST(issue_id % 70 AS INTEGER) AS created,
           CASE WHEN issue_id % 3 > 0 THEN DATE '2024-04-01' + CAST(issue_id % 9 AS INTEGER) END AS closed FROM i),
    c AS (SELECT conv_id AS issue_id, string_agg(role, ', ' ORDER BY turn, role) AS sites,
           string_agg(text, ', ' ORDER BY turn, text) AS items,
           string_agg(CASE WHEN role = 'user' THEN 'T' || turn END, ', ' ORDER BY turn) AS technologies,
           string_agg(text, ', ' ORDER BY turn, text) AS causes,
           left(string_agg(CASE WHEN role = 'assistant' THEN 'L' || length(text) END, ', ' ORDER BY turn), 3999) AS lots,
           sum(CASE WHEN role = 'assistant' THEN length(text) END) AS q FROM conversations GROUP BY 1)
    SELECT issue_id, md5(description) AS description_md5, CAST(date_diff('day', detected, created) AS INTEGER) AS input_lag,
      CAST(date_diff('day', detected, closed) AS INTEGER) AS close_days, CAST(date_diff('day', created, coalesce(closed, DATE '2024-06-01')) AS INTEGER) AS days_open,
      sites, md5(items) AS items_md5, technologies, md5(causes) AS causes_md5, coalesce(lots, '') AS lots, CAST(q AS BIGINT) AS affected_qty
    FROM b LEFT JOIN c USING (issue_id)
    """,
)
def issues_with_children(spark, sf):
    turns = table(spark, sf, "conversations", "conv_id", "turn", "role", "text").withColumnsRenamed({"conv_id": "issue_id", "turn": "pos"})
    first = turns.groupBy("issue_id").agg(F.max(F.when(F.col("pos") == 0, F.col("text"))).alias("t"))
    plain = F.translate("t", "<&", " +")
    n = F.col("issue_id").cast("int")
    base = first.select(
        "issue_id",
        F.concat(F.lit("<p>"), plain, F.lit(" &lt;b&gt;</p>")).alias("description"),
        F.date_add(F.lit("2024-01-01").cast("date"), n % 50).alias("detected"),
        F.date_add(F.lit("2024-01-03").cast("date"), n % 70).alias("created"),
        F.when(n % 3 > 0, F.date_add(F.lit("2024-04-01").cast("date"), n % 9)).alias("closed"),
        F.lit("A").alias("priority"),
        F.lit("y").alias("supplier_responsible"),
    )
    lots = turns.filter("role = 'assistant'")
    out = issues.enriched_issues(
        base,
        turns.select("issue_id", "pos", F.col("role").alias("site")),
        turns.select("issue_id", "pos", F.col("text").alias("item")),
        turns.filter("role = 'user'").select("issue_id", "pos", F.concat(F.lit("T"), "pos").alias("technology")),
        turns.select("issue_id", "pos", F.col("text").alias("cause")),
        lots.select("issue_id", "pos", F.concat(F.lit("L"), F.length("text")).alias("lot"), F.length("text").alias("quantity")),
        as_of="2024-06-01",
    )
    return out.select(
        "issue_id", F.md5("description").alias("description_md5"), "input_lag", "close_days", "days_open", "sites",
        F.md5("items").alias("items_md5"), "technologies", F.md5("causes").alias("causes_md5"), "lots", "affected_qty",
    )


@query(
    "linked_tool_dates",
    "O-96 O-58 O-83 O-40",
    """
    WITH w AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'MACHINERY') AS seg, c_nationkey, nullif(c_nationkey % 4, 0) AS qty, c_acctbal FROM customer),
    l AS (SELECT *, unnest(['Tool1', 'Tool2', 'Tool3']) AS t FROM w),
    v AS (SELECT *, CASE t WHEN 'Tool1' THEN CASE WHEN c_acctbal > 0 THEN '03/1' || c_nationkey % 10 || '/2021' END
           WHEN 'Tool2' THEN CASE WHEN c_acctbal > 4000 THEN '12/31/1999' END WHEN 'Tool3' THEN CASE WHEN c_acctbal > 8000 THEN '07/04/2022' END END AS x,
          CASE t WHEN 'Tool1' THEN CASE WHEN c_nationkey > 12 THEN '01/02/2023' END WHEN 'Tool2' THEN NULL END AS y FROM l)
    SELECT seg AS "T1 Supplier Name", c_name AS "Entity", c_custkey AS "SSEID", 'N' || c_nationkey AS "T1 Site", t AS "LinkedTool",
      CASE WHEN CAST(right(x, 4) AS INTEGER) > 2000 THEN strftime(strptime(x, '%m/%d/%Y'), '%Y-%m-%d') END AS "T2ExFD",
      CASE WHEN y IS NOT NULL THEN strftime(strptime(y, '%m/%d/%Y'), '%Y-%m-%d') END AS "T2TD"
    FROM v WHERE coalesce(qty, 1) >= CAST(right(t, 1) AS INTEGER) OR x IS NOT NULL OR y IS NOT NULL
    """,
)
def linked_tool_dates(spark, sf):
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    sheet = table(spark, sf, "customer").select(
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("T1 Supplier Name"),
        F.col("c_name").alias("Entity"),
        F.col("c_custkey").alias("SSEID"),
        F.concat(F.lit("N"), nation.cast("string")).alias("T1 Site"),
        F.nullif(nation % 4, F.lit(0)).alias("Tool Quantity"),
        F.when(balance > 0, F.concat(F.lit("03/1"), (nation % 10).cast("string"), F.lit("/2021"))).alias("T2ExFD_Tool1"),
        F.when(balance > 4000, "12/31/1999").alias("T2ExFD_Tool2"),
        F.when(balance > 8000, "07/04/2022").alias("T2ExFD_Tool3"),
        F.when(nation > 12, "01/02/2023").alias("T2TD_Tool1"),
        F.lit(None).cast("string").alias("T2TD_Tool2"),
    )
    out = tools.linked_tools(sheet)
    return out.withColumns({"T2ExFD": day_text("T2ExFD"), "T2TD": day_text("T2TD")})


@query(
    "decoded_survey_answers",
    "O-97 O-05",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN coalesce(CASE WHEN o_custkey % 6 = 3 THEN 'said ' || o_orderpriority
        ELSE r_name END, 'Old') END AS "Q1 where",
      CASE o_custkey % 7 WHEN 1 THEN 'Strongly Agree' WHEN 2 THEN 'Somewhat Agree' WHEN 3 THEN 'Neither agree nor disagree'
        WHEN 4 THEN 'Somewhat Disagree' WHEN 5 THEN 'Strongly Disagree' END AS "Q3 agree"
    FROM orders LEFT JOIN region ON r_regionkey = o_custkey % 6
    """,
)
def decoded_survey_answers(spark, sf):
    # The survey's definition: one question whose choices are the regions.
    choice = F.struct(F.col("r_regionkey").cast("string"), F.struct(F.col("r_name").alias("choiceText")))
    question = F.struct(
        F.lit("Q1").alias("questionName"),
        F.struct(F.lit("MC").alias("type")).alias("questionType"),
        F.map_from_entries(F.collect_list(choice)).alias("choices"),
    )
    body = F.to_json(F.struct(F.create_map(F.lit("QID1"), question).alias("questions")))
    definition = table(spark, sf, "region").agg(body.alias("body"))
    answers = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", (F.col("o_custkey") % 6).cast("string")).alias("Q1 where"),
        F.concat(F.lit("said "), "o_orderpriority").alias("Q1_3_TEXT where"),
        F.nullif(F.col("o_custkey") % 7, F.lit(0)).cast("string").alias("Q3 agree"),
    )
    labels = survey.choice_labels(definition, "body")
    return survey.decode_answers(answers, labels, ["Q1 where"], ["Q3 agree"], {("Q1 where", "3"): "Q1_3_TEXT where"})


@query(
    "contract_price_columns",
    "O-98 O-39 O-75 O-76",
    """
    WITH l AS (SELECT 'D' || l_suppkey AS document, l_linenumber AS "table", l_orderkey AS "row", l_partkey, l_extendedprice, l_quantity, l_returnflag FROM lineitem),
    c AS (SELECT document, "table", "row", 1 AS "column", CAST(l_partkey AS VARCHAR) AS value FROM l
      UNION ALL SELECT document, "table", "row", 2, '$' || CAST(l_extendedprice AS VARCHAR) FROM l WHERE l_returnflag <> 'A'
      UNION ALL SELECT document, "table", "row", 3, CAST(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE l_quantity END AS VARCHAR) FROM l),
    p AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item, l_extendedprice AS price FROM lineitem WHERE l_quantity > 45),
    n AS (SELECT document, "table", "row", price FROM c JOIN p ON value = item),
    v AS (SELECT c.document, c."table", c."column", count(*) AS k FROM c JOIN n ON c.document = n.document AND c."table" = n."table" AND c."row" = n."row"
          WHERE TRY_CAST(replace(replace(value, '$', ''), ',', '') AS DOUBLE) = price GROUP BY ALL),
    w AS (SELECT document, "table", "column" AS win FROM (SELECT *, row_number() OVER (PARTITION BY document, "table" ORDER BY k DESC, "column") AS r FROM v) WHERE r = 1)
    SELECT c.document, c."table", c."column", count(DISTINCT value) AS n_values,
      CASE WHEN win = c."column" THEN 'Price' WHEN win IS NOT NULL THEN 'NotPrice' ELSE 'Other' END AS label
    FROM c LEFT JOIN w ON c.document = w.document AND c."table" = w."table" GROUP BY c.document, c."table", c."column", win
    """,
)
def contract_price_columns(spark, sf):
    return contracts.price_column_labels(*contract_frames(spark, sf))


def contract_frames(spark, sf):
    """Contract cells and known prices from the order lines."""
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag")
    flag = F.col("l_returnflag")
    third = F.when(flag == "A", F.col("l_extendedprice")).otherwise(F.col("l_quantity")).cast("string")
    values = F.array(
        F.struct(F.lit(1).alias("column"), F.col("l_partkey").cast("string").alias("value")),
        F.struct(F.lit(2).alias("column"), F.when(flag != "A", F.concat(F.lit("$"), F.col("l_extendedprice").cast("string"))).alias("value")),
        F.struct(F.lit(3).alias("column"), third.alias("value")),
    )
    cells = lines.select(
        F.concat(F.lit("D"), "l_suppkey").alias("document"), F.col("l_linenumber").alias("table"), F.col("l_orderkey").alias("row"), F.inline(values)
    ).filter("value IS NOT NULL")
    prices = (
        lines.filter("l_quantity > 45")
        .select(F.col("l_partkey").cast("string").alias("item"), F.col("l_extendedprice").alias("price"))
        .distinct()
    )
    return cells, prices


@query(
    "contract_column_values",
    "O-76 O-98",
    """
    WITH l AS (SELECT 'D' || l_suppkey AS document, l_linenumber AS "table", l_partkey, l_extendedprice, l_quantity, l_returnflag FROM lineitem)
    SELECT document, "table", 1 AS "column", CAST(l_partkey AS VARCHAR) AS value FROM l
    UNION SELECT document, "table", 2, '$' || CAST(l_extendedprice AS VARCHAR) FROM l WHERE l_returnflag <> 'A'
    UNION SELECT document, "table", 3, CAST(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE l_quantity END AS VARCHAR) FROM l
    """,
)
def contract_column_values(spark, sf):
    return contracts.column_values(contract_frames(spark, sf)[0])


PHRASES = ["the", "of the", "de", "und", "on"]


@query(
    "phrase_counts_per_document",
    "O-99 O-88",
    """
    WITH d AS (SELECT doc_id, regexp_replace(lower(text), '([^\\p{L}\\p{M}\\p{N}_])', '\\1\\1', 'g') AS t FROM documents),
    c AS (SELECT doc_id, CAST(len(regexp_extract_all(t, '(^|[^\\p{L}\\p{M}\\p{N}_])the($|[^\\p{L}\\p{M}\\p{N}_])')) AS INTEGER) AS a,
      CAST(len(regexp_extract_all(t, '(^|[^\\p{L}\\p{M}\\p{N}_])of  the($|[^\\p{L}\\p{M}\\p{N}_])')) AS INTEGER) AS b,
      CAST(len(regexp_extract_all(t, '(^|[^\\p{L}\\p{M}\\p{N}_])de($|[^\\p{L}\\p{M}\\p{N}_])')) AS INTEGER) AS c,
      CAST(len(regexp_extract_all(t, '(^|[^\\p{L}\\p{M}\\p{N}_])und($|[^\\p{L}\\p{M}\\p{N}_])')) AS INTEGER) AS d,
      CAST(len(regexp_extract_all(t, '(^|[^\\p{L}\\p{M}\\p{N}_])on($|[^\\p{L}\\p{M}\\p{N}_])')) AS INTEGER) AS e FROM d)
    SELECT doc_id, a AS the, b AS "of the", c AS de, d AS und, e AS "on", a + b + c + d + e AS total FROM c WHERE a + b + c + d + e > 0
    """,
)
def phrase_counts_per_document(spark, sf):
    return phrases.phrase_counts(table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text", PHRASES)


@query(
    "incident_notices",
    "O-101 O-07 O-40",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Flood & storm' WHEN 'O' THEN 'Earthquake' ELSE 'Strike' END || ' near ' || o_custkey AS incident,
      strftime(o_orderdate + INTERVAL 15 HOUR + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS time, CAST(o_custkey AS VARCHAR) || ' km' AS impact_radius,
      CASE WHEN o_orderpriority < '3' THEN 0.125::DOUBLE END AS outage_probability,
      CASE WHEN o_orderpriority <> '5-LOW' THEN 'www.example.org/' || o_orderkey END AS link,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 12.3457::DOUBLE END AS latitude, CASE WHEN o_orderpriority = '1-URGENT' THEN -45.5::DOUBLE END AS longitude,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'Volcano' WHEN o_orderstatus = 'F' THEN 'Flood' WHEN o_orderstatus = 'O' THEN 'Earthquake' END AS incident_type
    FROM orders
    """,
)
def incident_notices(spark, sf):
    kind = text.map_values("o_orderstatus", {"F": "Flood &amp; storm", "O": "<b>Earthquake</b>", "P": "Strike"})
    priority = F.col("o_orderpriority")
    month = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd MMM yyyy")).otherwise(F.date_format("o_orderdate", "dd MMMM yyyy"))
    body = F.concat(
        F.lit("<h4>Incident Details</h4><table><tr><td> "), kind, F.lit(" near "), F.col("o_custkey").cast("string"),
        F.lit("</td></tr><tr><td>Time: 03:05 PM UTC on "), month, F.lit("</td></tr><tr><td>Impact radius: "),
        F.col("o_custkey").cast("string"), F.lit(" km</td></tr></table>"),
        F.when(priority < "3", "<h4>Supplier Impact Prediction</h4><div>Outage probability 12.5%, high</div>").otherwise(""),
        F.when(priority == "5-LOW", "<h4>News Links</h4><a href='m'>help@example.org</a>").otherwise(
            F.concat(F.lit("<h4>News Links</h4><a href='n'>www.example.org/"), F.col("o_orderkey").cast("string"), F.lit("</a>"))
        ),
        F.when(priority == "1-URGENT", "<table><tr><td>GDACS ID</td><td>VO 77</td></tr><tr><td>Lat/Lon:</td><td>12.34567 , -45.5</td></tr></table>").otherwise(""),
    )
    notices = table(spark, sf, "orders").select("o_orderkey", body.alias("body"))
    out = incidents.incident_fields(notices, "o_orderkey", "body", ignored_links=["help@example.org"])
    return out.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))


@query(
    "product_name_parts",
    "O-49",
    """
    SELECT p_partkey, p_type AS tech, p_brand AS tech2, 'x' || p_size AS width FROM part
    """,
)
def product_name_parts(spark, sf):
    name = F.concat_ws(" ", F.lit("8GB"), "p_type", F.concat(F.lit("1Gx"), "p_size"), F.concat("p_brand", F.lit("/")))
    parts = table(spark, sf, "part").select("p_partkey", text.memory_name_parts(name).alias("p"))
    return parts.select("p_partkey", "p.tech", "p.tech2", "p.width")


@query(
    "monthly_price_sheet",
    "O-27 O-29 O-37 O-40 O-46 O-49 O-83",
    """
    WITH m AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, round(avg(o_totalprice) FILTER (o_orderpriority = '5-LOW'), 4) AS a,
        round(max(o_totalprice) FILTER (o_orderpriority = '1-URGENT'), 2) AS b FROM orders GROUP BY ALL),
    k AS (SELECT * FROM m WHERE y * 12 + m <= (SELECT max(y * 12 + m) - 3 FROM m))
    SELECT '8GB DDR4 SODIMM 1Gx8' AS memory_full, 'DDR4' AS memory_tech, 'SODIMM' AS memory_tech2, 8.0::DOUBLE AS density_gb, 'x8' AS width,
      'Low' AS price_type, strftime(make_date(y, m, 1), '%Y-%m-%d') AS month, a AS price FROM k
    UNION ALL SELECT '4Gb DDR3', 'DDR3', NULL, 0.5, NULL, 'High', strftime(make_date(y, m, 1), '%Y-%m-%d'), b FROM k
    """,
)
def monthly_price_sheet(spark, sf):
    d = F.col("o_orderdate")
    months = table(spark, sf, "orders", "o_orderdate", "o_orderpriority", "o_totalprice").groupBy(
        F.year(d).alias("y"), F.month(d).alias("m"), F.date_format(d, "MMM").alias("Month")
    )
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    wide = months.agg(
        F.round(F.avg(F.when(priority == "5-LOW", price)), 4).cast("string").alias("8GB DDR4 SO/DIMM 1Gx8|Low"),
        F.round(F.max(F.when(priority == "1-URGENT", price)), 2).cast("string").alias("4Gb DDR3|High"),
    )
    sheet = wide.select(
        (F.col("y") * 12 + F.col("m")).alias("row_pos"),
        F.when(F.col("m") == 1, F.col("y").cast("string")).alias("Year"),
        "Month",
        *[f"`{c}`" for c in wide.columns if "|" in c],
        F.when(F.col("y") < 0, "x").alias("Unnamed: 5"),
    )
    out = market.price_table(sheet, "Year", "Month", "orders", date(2024, 1, 1))
    return out.select(
        "memory_full", "memory_tech", "memory_tech2", "density_gb", "width", "price_type", day_text("forecast_dt").alias("month"), "price"
    )
