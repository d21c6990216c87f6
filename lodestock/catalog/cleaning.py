"""Cleaning, parsing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators import columns as cols, profiling, reshape, rows
from ..operators.lists import names_for_ids
from .registry import day_text, query, table


@query(
    "kept_and_aligned_columns",
    "O-24 O-25 O-26 O-30 O-31",
    """
    SELECT c_custkey AS customer_id, c_name AS customer, c_mktsegment AS segment,
           CAST(NULL AS VARCHAR) AS site, CAST(c_acctbal AS DOUBLE) AS balance
    FROM customer
    """,
)
def kept_and_aligned_columns(spark, sf):
    df = table(spark, sf, "customer").withColumn("Unnamed: 5", F.lit(1))
    df = cols.drop_matching(df, "Unnamed")
    df = cols.drop_columns(df, ["c_nationkey", "not there"])
    df = cols.select_matching(df, "^c_")
    df = cols.rename_columns(
        df, {"c_custkey": "customer_id", "c_name": "customer", "c_mktsegment": "segment", "c_acctbal": "balance"}
    )
    return cols.align_columns(df, ["customer_id", "customer", "segment", "site", "balance"])


@query(
    "skipped_rows_by_position",
    "O-121 O-31",
    """
    SELECT event_id AS "Id", event_type AS "Kind", value AS "Amount" FROM events WHERE event_id >= 2
    """,
)
def skipped_rows_by_position(spark, sf):
    df = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    return cols.take_positions(rows.skip_rows(df, 2, "event_id"), [0, 3, 4], ["Id", "Kind", "Amount"])


@query(
    "footer_dropped",
    "O-29",
    """
    SELECT event_id, event_type, value FROM events
    WHERE event_id <= (SELECT max(event_id) FROM events) - 3
    """,
)
def footer_dropped(spark, sf):
    return rows.drop_footer(table(spark, sf, "events", "event_id", "event_type", "value"), 3, "event_id")


@query(
    "footers_dropped_per_file",
    "O-29 O-121",
    """
    SELECT event_type, event_id, value FROM events e
    WHERE event_id <= (SELECT max(event_id) FROM events x WHERE x.event_type = e.event_type) - 3
    """,
)
def footers_dropped_per_file(spark, sf):
    return rows.drop_footer(table(spark, sf, "events", "event_id", "event_type", "value"), 3, "event_id", ["event_type"])


@query(
    "columns_with_values",
    "O-27",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
def columns_with_values(spark, sf):
    df = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    empty = F.when(F.col("o_totalprice") < -1e12, "never")
    return cols.drop_null_columns(df.withColumn("remark", empty))


@query(
    "rows_without_blanks",
    "O-28",
    """
    WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
                      CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment FROM customer)
    SELECT c_custkey, balance, segment FROM c WHERE balance IS NOT NULL AND NOT (balance IS NULL AND segment IS NULL)
    """,
)
def rows_without_blanks(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"),
    )
    return df.dropna(how="all", subset=["balance", "segment"]).dropna(subset=["balance"])


@query(
    "filtered_parts",
    "O-32",
    """
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_type IN ('ECONOMY', 'PROMO') AND p_name LIKE '%bolt%' AND lower(p_brand) <> 'brand#17'
      AND p_brand LIKE 'Brand%' AND p_size BETWEEN 5 AND 40 AND p_retailprice IS NOT NULL
    """,
)
def filtered_parts(spark, sf):
    return (
        table(spark, sf, "part")
        .filter(F.col("p_type").isin("ECONOMY", "PROMO") & F.col("p_name").like("%bolt%"))
        .filter((F.lower("p_brand") != "brand#17") & F.col("p_brand").startswith("Brand"))
        .filter(F.col("p_size").between(5, 40) & F.col("p_retailprice").isNotNull())
        .select("p_partkey", "p_name", "p_brand")
    )


@query(
    "yes_no_policies",
    "O-33",
    """
    WITH a AS (SELECT o_orderpriority AS priority,
                 CASE o_orderstatus WHEN 'F' THEN 'YES' WHEN 'O' THEN 'No' ELSE
                   CASE WHEN o_totalprice > 250000 THEN 'y' END END AS answer FROM orders)
    SELECT priority,
      count(*) FILTER (coalesce(lower(answer) = 'yes', false)) AS yes_or_false,
      count(*) FILTER (lower(answer) = 'yes') AS yes_known,
      count(*) FILTER (lower(answer) NOT IN ('yes', 'no') OR answer IS NULL) AS neither,
      count(*) FILTER (answer IS NOT NULL AND lower(answer) <> 'no') AS any_text,
      count(*) FILTER (lower(answer) IN ('yes', 'y')) AS short_yes
    FROM a GROUP BY priority
    """,
)
def yes_no_policies(spark, sf):
    answer = (
        F.when(F.col("o_orderstatus") == "F", "YES")
        .when(F.col("o_orderstatus") == "O", "No")
        .when(F.col("o_totalprice") > 250000, "y")
    )
    df = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority"), answer.alias("answer"))
    return df.groupBy("priority").agg(
        F.count_if(text.yes_no("answer", "false")).alias("yes_or_false"),
        F.count_if(text.yes_no("answer", "null")).alias("yes_known"),
        F.count_if(text.yes_no("answer", "null").isNull()).alias("neither"),
        F.count_if(text.yes_no("answer", "text")).alias("any_text"),
        F.count_if(text.yes_no("answer", "short")).alias("short_yes"),
    )


@query(
    "mapped_status_names",
    "O-34 O-35",
    """
    SELECT CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '1-URGENT' THEN 'Urgent'
             ELSE o_orderpriority END AS priority,
           count(*) AS orders,
           count(CASE WHEN NOT (o_orderstatus IN ('P', 'O')) THEN o_orderdate END) AS received
    FROM orders GROUP BY 1
    """,
)
def mapped_status_names(spark, sf):
    df = table(spark, sf, "orders", "o_orderpriority", "o_orderstatus", "o_orderdate").select(
        text.map_values("o_orderpriority", {"4-NOT SPECIFIED": None, "1-URGENT": "Urgent"}).alias("priority"),
        text.null_where("o_orderdate", "o_orderstatus", ["P", "O"]).alias("received"),
    )
    return df.groupBy("priority").agg(F.count(F.lit(1)).alias("orders"), F.count("received").alias("received"))


@query(
    "filled_columns",
    "O-36",
    """
    WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 1000 THEN c_acctbal END AS balance,
                 CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment, c_name FROM customer)
    SELECT c_custkey, round(coalesce(balance, (SELECT median(balance) FROM c)), 4) AS balance,
           coalesce(segment, 'missing') AS segment, coalesce(segment, c_name) AS label
    FROM c
    """,
)
def filled_columns(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 1000, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        "c_name",
    )
    df = df.withColumn("label", F.coalesce("segment", "c_name")).drop("c_name").fillna({"segment": "missing"})
    return profiling.fill_median(df, ["balance"]).withColumn("balance", F.round("balance", 4))


@query(
    "forward_filled_labels",
    "O-37",
    """
    SELECT event_id, last_value(CASE WHEN value > 100 THEN event_type END IGNORE NULLS)
             OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS label,
           last_value(CASE WHEN value > 200 THEN value END IGNORE NULLS)
             OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS level
    FROM events
    """,
)
def forward_filled_labels(spark, sf):
    df = table(spark, sf, "events", "event_id", "event_type", "value").select(
        "event_id",
        F.when(F.col("value") > 100, F.col("event_type")).alias("label"),
        F.when(F.col("value") > 200, F.col("value")).alias("level"),
    )
    return rows.forward_fill(df, ["label", "level"], "event_id", block_rows=10_000)


@query(
    "parsed_numbers",
    "O-38 O-39 O-43",
    """
    SELECT p_partkey, CAST(regexp_replace(p_brand, '[^0-9.]', '', 'g') AS DOUBLE) AS brand_number,
           TRY_CAST(p_type AS DOUBLE) AS no_number, p_retailprice AS price, round_even(p_size / 2.0, 0) AS half_size,
           CASE WHEN p_size <> 20 THEN round(p_retailprice / (p_size - 20), 6) END AS per_size,
           CAST(abs(p_size - 25) AS BIGINT) AS distance, CAST(p_partkey AS VARCHAR) AS id_text
    FROM part
    """,
)
def parsed_numbers(spark, sf):
    shown = F.concat(F.lit(" $"), F.col("p_retailprice").cast("string"), F.lit(" "))
    return table(spark, sf, "part").select(
        "p_partkey",
        numbers.digits_to_number("p_brand").alias("brand_number"),
        numbers.to_number("p_type").alias("no_number"),
        numbers.money(shown).alias("price"),
        numbers.half_even(F.col("p_size") / 2).alias("half_size"),
        F.round(numbers.ratio("p_retailprice", F.col("p_size") - 20), 6).alias("per_size"),
        F.abs(F.col("p_size") - 25).cast("long").alias("distance"),
        numbers.id_text("p_partkey").alias("id_text"),
    )


@query(
    "parsed_dates",
    "O-40",
    """
    WITH t AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%m/%d/%Y')
                 WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'pending' END AS d FROM orders),
    p AS (SELECT o_orderkey, coalesce(try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%Y-%m-%d')) AS d FROM t)
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS any_year,
           CASE WHEN year(d) > 1996 THEN strftime(d, '%Y-%m-%d') END AS late_year FROM p
    """,
)
def parsed_dates(spark, sf):
    shown = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise("pending")
    )
    formats = ["MM/dd/yyyy", "yyyy-MM-dd"]
    return (
        table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
        .select("o_orderkey", shown.alias("d"))
        .select(
            "o_orderkey",
            day_text(dates.parse_date("d", formats)).alias("any_year"),
            day_text(dates.parse_date("d", formats, min_year=1996)).alias("late_year"),
        )
    )


@query(
    "text_pieces",
    "O-41",
    """
    SELECT c_custkey, substr(c_name, 10) AS digits, split_part(c_name, '#', 1) AS kind,
           lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS nation_code,
           upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS title,
           left(c_name, 10) AS short, right(c_name, 3) AS tail, trim('  ' || c_mktsegment || ' ') AS trimmed,
           c_mktsegment || '-' || c_name AS joined
    FROM customer
    """,
)
def text_pieces(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.substring("c_name", 10, 100).alias("digits"),
        F.split("c_name", "#")[0].alias("kind"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("nation_code"),
        F.initcap("c_mktsegment").alias("title"),
        F.left("c_name", F.lit(10)).alias("short"),
        F.right("c_name", F.lit(3)).alias("tail"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.concat("c_mktsegment", F.lit("-"), "c_name").alias("joined"),
    )


HTML_TEXT_SQL = """
    WITH s AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>', '', 'g'),
                 '(?is)<style\\b.*?</style\\s*>', '', 'g') AS t FROM pages),
    u AS (SELECT page_id, regexp_replace(regexp_replace(t, '(?s)<!--.*?-->', '', 'g'),
            '(?s)<[!/a-zA-Z][^>]*>', '', 'g') AS t FROM s),
    v AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(t,
            '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'),
            '&middot;', '·'), '&amp;', '&') AS t FROM u)
    SELECT page_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5 FROM v
"""


@query("page_texts", "O-42", HTML_TEXT_SQL)
def page_texts(spark, sf):
    plain = table(spark, sf, "pages", "page_id", "html").select("page_id", text.html_to_text("html").alias("t"))
    return plain.select("page_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("text_md5"))


@query(
    "lines_by_codes",
    "O-48",
    """
    SELECT CASE WHEN l_returnflag IN ('A', 'R') THEN CASE WHEN l_linestatus = 'F' THEN 'closed return' END
                WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'open'
                ELSE 'other' END AS category, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1
    """,
)
def lines_by_codes(spark, sf):
    category = text.code_category(
        [
            ({"l_returnflag": ["A", "R"]}, [({"l_linestatus": ["F"]}, "closed return")]),
            ({"l_returnflag": ["N"], "l_linestatus": ["O"]}, "open"),
            ({}, "other"),
        ]
    )
    lines = table(spark, sf, "lineitem", "l_returnflag", "l_linestatus", "l_quantity")
    return lines.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query(
    "line_ages",
    "O-44",
    """
    SELECT l_returnflag, CAST(sum(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))) AS BIGINT) AS lag_days,
           CAST(sum(date_diff('day', CAST(l_shipdate AS DATE), CASE WHEN l_linestatus = 'F'
             THEN CAST(l_shipdate AS DATE) + 10 ELSE DATE '2002-01-01' END)) AS BIGINT) AS open_days,
           strftime(max(date_trunc('month', l_shipdate + INTERVAL 2 MONTH)), '%Y-%m-%d') AS latest_month
    FROM lineitem GROUP BY l_returnflag
    """,
)
def line_ages(spark, sf):
    df = table(spark, sf, "lineitem", "l_returnflag", "l_linestatus", "l_shipdate")
    closed = F.when(F.col("l_linestatus") == "F", F.date_add("l_shipdate", 10))
    return df.groupBy("l_returnflag").agg(
        F.sum(dates.days_between("l_shipdate", F.lit("1995-01-01").cast("date"))).alias("lag_days"),
        F.sum(dates.days_open(closed, "l_shipdate", "2002-01-01")).alias("open_days"),
        day_text(F.max(F.trunc(F.add_months("l_shipdate", 2), "month"))).alias("latest_month"),
    )


@query(
    "report_months",
    "O-45",
    """
    SELECT strftime(date_trunc('month', CASE WHEN day(o_orderdate) < 21 THEN o_orderdate - INTERVAL 1 MONTH
             ELSE o_orderdate END), '%Y-%m-%d') AS report_month, count(*) AS orders
    FROM orders GROUP BY 1
    """,
)
def report_months(spark, sf):
    month = day_text(dates.report_month("o_orderdate")).alias("report_month")
    return table(spark, sf, "orders", "o_orderdate").groupBy(month).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "density_in_gigabytes",
    "O-46",
    """
    SELECT p_partkey, round(CASE p_type WHEN 'ECONOMY' THEN p_size WHEN 'PROMO' THEN p_size / 8.0
      WHEN 'SMALL' THEN p_size / 1000.0 WHEN 'MEDIUM' THEN p_size / 8000.0 WHEN 'LARGE' THEN p_size / 1000000.0 END, 10)
      AS gigabytes FROM part
    """,
)
def density_in_gigabytes(spark, sf):
    unit = text.map_values(
        "p_type", {"ECONOMY": "GB", "PROMO": " Gb", "SMALL": "MB", "MEDIUM": "Mb x16", "LARGE": "KB"}, keep_unmapped=False
    )
    size = F.concat(F.col("p_size").cast("string"), F.coalesce(unit, F.lit("TB")))
    df = table(spark, sf, "part", "p_partkey", "p_size", "p_type").select("p_partkey", size.alias("density"))
    return df.select("p_partkey", F.round(numbers.density_gigabytes("density"), 10).alias("gigabytes"))


@query(
    "quarter_and_month_labels",
    "O-47",
    """
    SELECT '20' || right(CAST(year(o_orderdate) AS VARCHAR), 2) || '-Q0' || quarter(o_orderdate) AS quarter,
           strftime(make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), 1), '%Y-%m-%d') AS month,
           count(*) AS orders
    FROM orders GROUP BY 1, 2
    """,
)
def quarter_and_month_labels(spark, sf):
    d = F.col("o_orderdate")
    quarter = F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"), F.date_format(d, "yy"))
    return (
        table(spark, sf, "orders", "o_orderdate")
        .groupBy(
            dates.quarter_label(quarter).alias("quarter"),
            day_text(dates.month_label_date(F.date_format(d, "MMM yy"))).alias("month"),
        )
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "spend_bands",
    "O-48",
    """
    WITH s AS (SELECT o_custkey, sum(o_totalprice) AS paid FROM orders GROUP BY o_custkey)
    SELECT CASE WHEN paid < 1000000 THEN 'Very Low' WHEN paid < 2000000 THEN 'Low' WHEN paid < 2500000 THEN 'Medium'
                WHEN paid < 3000000 THEN 'High' ELSE 'Very High' END AS spending,
           count(*) AS customers
    FROM s GROUP BY 1
    """,
)
def spend_bands(spark, sf):
    paid = table(spark, sf, "orders", "o_custkey", "o_totalprice").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("paid"))
    label = numbers.band("paid", [1e6, 2e6, 2.5e6, 3e6], ["Very Low", "Low", "Medium", "High", "Very High"])
    return paid.groupBy(label.alias("spending")).agg(F.count(F.lit(1)).alias("customers"))


@query(
    "listed_items_to_rows",
    "O-49",
    """
    SELECT p_partkey, 'Scope CEID: ' || unnest(string_split(p_name, ' ')) AS notes FROM part WHERE p_size > 10
    UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size <= 10
    """,
)
def listed_items_to_rows(spark, sf):
    notes = F.when(F.col("p_size") > 10, F.concat(F.lit("Scope CEID: "), F.replace("p_name", F.lit(" "), F.lit(", "))))
    df = table(spark, sf, "part").select("p_partkey", F.coalesce(notes, "p_name").alias("notes"))
    return reshape.explode_parts(df, text.listed_after("notes", "CEID: "), "notes")


@query(
    "nested_field",
    "O-115",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    """,
)
def nested_field(spark, sf):
    df = table(spark, sf, "events", "event_id", "props").select(
        "event_id", F.from_json("props", "k bigint").alias("owner")
    )
    return cols.flatten_field(df, "owner.k", "k")


@query(
    "joined_assignees",
    "O-116",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'None'
      ELSE least(c_name, c_mktsegment) || ',' || greatest(c_name, c_mktsegment) END AS assigned_to FROM customer
    """,
)
def joined_assignees(spark, sf):
    people = F.when(F.col("c_acctbal") >= 0, F.create_map(F.lit("7"), "c_name", F.lit("3"), "c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", text.joined_map_values(people).alias("assigned_to"))


@query(
    "rows_in_effect",
    "O-117",
    """
    SELECT o_orderpriority, count(*) AS in_effect FROM orders
    WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-30' AND DATE '1998-06-30' < CAST(o_orderdate AS DATE) + 90
    GROUP BY 1
    """,
)
def rows_in_effect(spark, sf):
    df = table(spark, sf, "orders", "o_orderpriority", "o_orderdate")
    valid = dates.in_effect(F.to_date("o_orderdate"), F.date_add("o_orderdate", 90), "1998-06-30")
    return df.filter(valid).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("in_effect"))


@query(
    "exemption_flags",
    "O-118",
    """
    SELECT o_orderstatus, CASE WHEN DATE '2001-08-01' >= CAST(o_orderdate AS DATE) + 90 THEN 'n' ELSE 'y' END AS exempt,
           count(*) AS orders FROM orders GROUP BY 1, 2
    """,
)
def exemption_flags(spark, sf):
    flag = dates.expired_flag("o_orderdate", "2001-08-01").alias("exempt")
    return (
        table(spark, sf, "orders", "o_orderstatus", "o_orderdate")
        .groupBy("o_orderstatus", flag)
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "names_for_ids",
    "O-119",
    """
    SELECT o.o_orderkey, CASE WHEN a.c_name IS NOT NULL AND b.c_name IS NOT NULL
             THEN a.c_name || '; ' || b.c_name END AS contacts
    FROM orders o LEFT JOIN customer a ON a.c_custkey = o.o_custkey
    LEFT JOIN customer b ON b.c_custkey = o.o_custkey - 3
    """,
)
def names_for_ids_query(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey").select(
        "o_orderkey", F.concat_ws("; ", F.col("o_custkey"), F.col("o_custkey") - 3).alias("ids")
    )
    people = table(spark, sf, "customer", "c_custkey", "c_name")
    return names_for_ids(orders, ["o_orderkey"], "ids", people, "c_custkey", "c_name", "contacts")


@query(
    "decoded_column_names",
    "O-120",
    """
    SELECT s_suppkey AS "Supplier Id", s_name AS "Supplier Name", s_acctbal AS "Balance (USD)" FROM supplier
    """,
)
def decoded_column_names(spark, sf):
    df = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_acctbal")
    return cols.decode_column_names(
        df.toDF("Supplier_x0020_Id", "Supplier_x0020_Name_x00", "Balance_x0020__x0028_USD_x0029_")
    )


@query(
    "sentinel_dates_cleared",
    "O-34 O-40",
    """
    SELECT count(*) AS lines, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS known,
           strftime(max(CASE WHEN l_linestatus = 'F' THEN l_shipdate END), '%Y-%m-%d') AS latest
    FROM lineitem
    """,
)
def sentinel_dates_cleared(spark, sf):
    shown = F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyyMMdd")).otherwise("00000000")
    df = table(spark, sf, "lineitem", "l_linestatus", "l_shipdate").select(
        dates.parse_date(text.sentinel_to_null(shown, ["00000000", "99991231"]), ["yyyyMMdd"]).alias("d")
    )
    return df.agg(F.count(F.lit(1)).alias("lines"), F.count("d").alias("known"), day_text(F.max("d")).alias("latest"))
