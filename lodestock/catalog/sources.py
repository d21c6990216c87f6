"""Readers and writers, exercised on landed copies of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import load
from ..sources import database, delimited, documents, incremental, markup, paged, records
from ..session import scratch_path
from .registry import query, table

PART_DDL = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"


@query(
    "csv_written_and_read",
    "O-01 O-10",
    """
    SELECT p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS sizes, round(sum(p_retailprice), 2) AS price,
           count(p_name) AS named FROM (SELECT * REPLACE (CASE WHEN p_size > 3 THEN p_name END AS p_name) FROM part) GROUP BY 1
    """,
)
def csv_written_and_read(spark, sf):
    df = table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    df = df.withColumn("p_name", F.when(F.col("p_size") > 3, F.concat("p_name", F.lit("|x"))).otherwise("n/a"))
    path = scratch_path(spark, "csv")
    delimited.write_csv(df, path, sep="|")
    back = delimited.read_csv(spark, path, PART_DDL, sep="|", null_value="n/a")
    return back.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("p_size").alias("sizes"),
        F.round(F.sum("p_retailprice"), 2).alias("price"),
        F.count("p_name").alias("named"),
    )


@query(
    "sheet_with_numbered_rows",
    "O-02 O-38",
    """
    SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS value, count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) AS ranked
    FROM orders GROUP BY 1
    """,
)
def sheet_with_numbered_rows(spark, sf):
    df = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    df = df.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", "#N/A").otherwise(F.col("o_orderpriority")))
    path = scratch_path(spark, "sheet")
    delimited.write_csv(df, path)
    sheet = delimited.read_sheet(spark, path + "/*.csv", header_row=0)
    return sheet.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum(F.col("o_totalprice").try_cast("double")), 2).alias("value"),
        F.count("o_orderpriority").alias("ranked"),
    )


@query(
    "sheets_with_quoted_lines",
    "O-01 O-02",
    """
    SELECT p_brand AS brand, count(*) AS parts, CAST(sum(length(p_name) + length(p_type) + 3) AS BIGINT) AS note_chars,
           CAST(sum(CASE WHEN p_partkey % 2 = 0 THEN p_size END) AS BIGINT) AS sizes, max(md5(p_name || chr(10) || p_type || ' "x')) AS last_note
    FROM part GROUP BY 1
    """,
)
def sheets_with_quoted_lines(spark, sf):
    """Two files of one folder with their columns in another order; notes hold line breaks and quotes."""
    note = F.concat("p_name", F.lit("\n"), "p_type", F.lit(' "x'))
    df = table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_brand", "p_size")
    path = scratch_path(spark, "quoted")
    even = df.filter("p_partkey % 2 = 0").select(F.col("p_brand").alias("Brand"), note.alias("Note"), F.col("p_size").alias("Size"))
    odd = df.filter("p_partkey % 2 = 1").select(note.alias("Note"), F.col("p_brand").alias("Brand"))
    for part, name in ((even, "even"), (odd, "odd")):
        part.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(f"{path}/{name}")
    sheet = delimited.read_sheet(spark, f"{path}/*/*.csv")
    return sheet.groupBy(F.col("Brand").alias("brand")).agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum(F.length("Note") - 1).cast("long").alias("note_chars"),
        F.sum(F.col("Size").try_cast("long")).alias("sizes"),
        F.max(F.md5("Note")).alias("last_note"),
    )


@query(
    "query_over_views",
    "O-03",
    """
    SELECT n_name, count(*) AS customers, round(avg(c_acctbal), 6) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
    """,
)
def query_over_views(spark, sf):
    statement = """
        SELECT n_name, count(*) AS customers, round(avg(c_acctbal), 6) AS balance
        FROM {people} JOIN {nations} ON c_nationkey = n_nationkey GROUP BY n_name
    """
    views = {"people": table(spark, sf, "customer"), "nations": table(spark, sf, "nation")}
    return database.read_views(spark, statement, views)


@query(
    "extract_by_year",
    "O-04",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders, round(sum(o_totalprice), 2) AS value
    FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998) GROUP BY 1
    """,
)
def extract_by_year(spark, sf):
    df = table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate").withColumn("order_year", F.year("o_orderdate"))
    path = scratch_path(spark, "years")
    database.land_by_year(df, path, "order_year")
    years = database.read_years(spark, path, "order_year", [1996, 1997, 1998])
    return years.groupBy("order_year").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value"))


@query(
    "records_from_json_pages",
    "O-05",
    """
    SELECT event_type, count(*) AS events, round(sum(value), 2) AS total, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k
    FROM events GROUP BY 1
    """,
)
def records_from_json_pages(spark, sf):
    # A page holds at most 1,000 records, as the service sends them.
    page = F.floor(F.col("event_id") / 1000).alias("page")
    item = F.struct("event_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))
    bodies = (
        table(spark, sf, "events", "event_id", "event_type", "value", "props")
        .groupBy(page)
        .agg(F.to_json(F.struct(F.collect_list(item).alias("elements"))).alias("body"))
    )
    items = records.explode_records(bodies, "body", "event_id: bigint, event_type: string, value: double, props: struct<k: bigint>")
    return items.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"), F.sum("props.k").alias("k")
    )


@query(
    "pages_merged_on_key",
    "O-06",
    """
    SELECT event_type, count(*) AS events, round(sum(CASE WHEN value > 50 THEN value + 1 ELSE value END), 2) AS total FROM events GROUP BY 1
    """,
)
def pages_merged_on_key(spark, sf):
    events = table(spark, sf, "events", "event_id", "event_type", "value")
    changed = events.filter("value > 50").withColumn("value", F.col("value") + 1)
    path = scratch_path(spark, "pages")
    events.withColumn("page", F.lit(1)).write.json(path + "/first")
    changed.withColumn("page", F.lit(2)).write.json(path + "/second")
    landed = records.read_json_records(spark, path + "/*", "event_id bigint, event_type string, value double, page int")
    merged = records.merge_pages(landed, ["event_id"], [F.desc("page")])
    return merged.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"))


PAGES_SQL = """
    SELECT event_type, count(*) AS events, round(sum(value), 2) AS total, count(DISTINCT event_id // 500) AS pages FROM events GROUP BY 1
"""


def _land_pages(spark, sf, path, first=None, last=None):
    """Events as the pages of a service, 500 records each."""
    page = (F.floor(F.col("event_id") / 500) + 1).alias("page")
    events = table(spark, sf, "events", "event_id", "event_type", "value")
    bodies = events.groupBy(page).agg(F.to_json(F.struct(F.collect_list(F.struct("event_id", "event_type", "value")).alias("elements"))).alias("body"))
    if first is not None:
        bodies = bodies.filter(F.col("page").between(first, last))
    bodies.repartition("page").write.mode("append").partitionBy("page").text(path)


def _page_totals(pages):
    items = records.explode_records(pages, "body", "event_id: bigint, event_type: string, value: double")
    return items.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"), F.count_distinct("page").alias("pages")
    )


@query("pages_from_their_source", "O-06", PAGES_SQL)
def pages_from_their_source(spark, sf):
    path = scratch_path(spark, "pages")
    _land_pages(spark, sf, path)
    return _page_totals(paged.read_pages(spark, path, pages_per_task=4))


@query("new_pages_only", "O-06 O-18", PAGES_SQL)
def new_pages_only(spark, sf):
    """Two runs of a stream over one folder: the second reads what has landed in between."""
    path, target, checkpoint = (scratch_path(spark, x) for x in ("pages", "read", "offsets"))
    for first, last in ((1, 2), (3, 1 << 40)):
        _land_pages(spark, sf, path, first, last)
        paged.load_new_pages(spark, path, target, checkpoint)
    return _page_totals(spark.read.schema(paged.SCHEMA).parquet(target))


@query(
    "items_from_markup",
    "O-07",
    """
    WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1)) AS item FROM pages)
    SELECT page_id, count(*) AS items, count(nullif(regexp_extract(item, '(?s)<a(?:\\s[^>]*)?>(.*?)</a>', 1), '')) AS links,
           max(regexp_extract(item, '(?s)<a(?:\\s[^>]*)?>(.*?)</a>', 1)) AS last_link
    FROM l GROUP BY 1
    """,
)
def items_from_markup(spark, sf):
    items = markup.feed_items(table(spark, sf, "pages", "page_id", "html"), "html", {"a": "link", "missing": "missing"}, item="li")
    return items.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("items"), F.count("link").alias("links"), F.max("link").alias("last_link")
    )


@query(
    "nested_list_items",
    "O-07",
    """
    WITH c AS (SELECT n_nationkey, n_name, n_regionkey, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
    i AS (SELECT n_regionkey, r_name AS link, true AS holds_others, 2 AS weight FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY ALL
      UNION ALL SELECT n_regionkey, n_name, customers > 0, 1 FROM c
      UNION ALL SELECT c.n_regionkey, c_name, false, 1 FROM c JOIN customer ON c_nationkey = c.n_nationkey)
    SELECT n_regionkey AS region, count(*) AS items, count(*) FILTER (holds_others) AS lists, min(link) AS first_link, max(link) AS last_link
    FROM i GROUP BY 1
    """,
)
def nested_list_items(spark, sf):
    """Lists in lists, with comments and signs that look like tags; every item counts, with its own link."""
    customers = table(spark, sf, "customer", "c_nationkey", "c_name").groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_name")).alias("names"))
    item = lambda name, rest: F.concat(F.lit("<li title=\"a > b\"><a href='x?y>z'>"), name, F.lit("</a><!-- <li> -->"), rest, F.lit("</li>"))
    listed = lambda items: F.concat(F.lit("<ul>"), F.array_join(items, ""), F.lit("</ul>"))
    nations = table(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey").join(customers, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    inner = F.coalesce(listed(F.transform("names", lambda n: item(n, F.lit("")))), F.lit(""))
    lists = nations.groupBy("n_regionkey").agg(listed(F.array_sort(F.collect_list(item(F.col("n_name"), inner)))).alias("nations"))
    regions = table(spark, sf, "region", "r_regionkey", "r_name").join(lists, F.col("r_regionkey") == F.col("n_regionkey"))
    pages = regions.select(F.col("r_regionkey").cast("int").alias("region"), listed(F.array(item(F.col("r_name"), F.col("nations")))).alias("body"))
    items = markup.feed_items(pages, "body", {"a": "link", "ul": "inside"}, item="li")
    return items.groupBy("region").agg(
        F.count(F.lit(1)).alias("items"), F.count("inside").alias("lists"), F.min("link").alias("first_link"), F.max("link").alias("last_link")
    )


@query(
    "text_files_of_one_document",
    "O-08",
    "SELECT md5(text || chr(10)) AS digest, CAST(length(text) + 1 AS INTEGER) AS chars, count(*) AS files FROM documents GROUP BY ALL",
)
def text_files_of_one_document(spark, sf):
    """Every document in a file of its own; a row is a whole file.

    Files lie in folders, which tasks list.
    """
    path = scratch_path(spark, "texts")
    documents.write_documents(table(spark, sf, "documents", "text"), "text", path)
    read = documents.read_documents(spark, path)
    return read.groupBy(F.md5("text").alias("digest"), F.length("text").alias("chars")).agg(F.count(F.lit(1)).alias("files"))


@query(
    "text_folder_documents",
    "O-08",
    "SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS chars FROM documents GROUP BY 1",
)
def text_folder_documents(spark, sf):
    path = scratch_path(spark, "texts")
    # A file is one document to the reader, so its size stays bounded.
    table(spark, sf, "documents", "lang", "text").write.option("maxRecordsPerFile", 500).partitionBy("lang").text(path)
    read = documents.read_documents(spark, path)
    return read.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"))


@query("table_copy", "O-11", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def table_copy(spark, sf):
    first, second = scratch_path(spark, "copy"), scratch_path(spark, "copy")
    load.full_refresh(table(spark, sf, "supplier"), first)
    load.copy_table(spark, first, second)
    return spark.read.parquet(second)


@query(
    "files_changed_since_load",
    "O-17",
    """
    SELECT 'all' AS since, count(*) AS n FROM customer UNION ALL SELECT 'future', 0
    """,
)
def files_changed_since_load(spark, sf):
    path = scratch_path(spark, "changed")
    load.full_refresh(table(spark, sf, "customer", "c_custkey"), path)
    files = spark.read.parquet(path)

    def count(label, stamp):
        changed = incremental.modified_since(files, F.lit(stamp).cast("timestamp"))
        return changed.agg(F.lit(label).alias("since"), F.count(F.lit(1)).alias("n"))

    return count("all", "2000-01-01 00:00:00").unionByName(count("future", "2999-01-01 00:00:00"))


@query(
    "files_stamped_after",
    "O-18",
    """
    WITH e AS (SELECT isoyear(ts) || '.' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') || '.' || isodow(ts) AS stamp, value FROM events)
    SELECT stamp, count(*) AS events, round(sum(value), 2) AS total FROM e WHERE stamp > '2024.03.5' GROUP BY 1
    """,
)
def files_stamped_after(spark, sf):
    stamp = F.concat(
        F.expr("extract(YEAROFWEEK FROM ts)"), F.lit("."), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"),
        F.lit("."), (F.weekday("ts") + 1),
    )
    path = scratch_path(spark, "stamped")
    events = table(spark, sf, "events", "ts", "value").withColumn("load", stamp)
    events.write.partitionBy("load").parquet(path)
    files = spark.read.parquet(path).select("value", F.col("_metadata.file_path").alias("file"))
    newer = incremental.newer_than_stamp(files, "file", "2024.03.5")
    return newer.groupBy("stamp").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"))
