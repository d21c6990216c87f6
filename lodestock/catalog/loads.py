"""Load modes: the state of a table after its loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F, types as T

from ..operators import asof, audit, columns as cols, contract, load
from ..session import scratch_path
from ..streaming.pickup import pick_up_new_files, replace_slices
from .registry import day_text, query, table

CUSTOMER_TARGET = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        contract.text_field("customer_name", 40),
        T.StructField("balance", T.DoubleType()),
        contract.text_field("segment", 20),
    ]
)


@query(
    "audited_table_load",
    "O-09 O-22 O-50 O-51",
    """
    SELECT c_mktsegment AS segment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance,
           (SELECT 'I' || count(*) FROM customer) || ',E0' AS log FROM customer GROUP BY 1
    """,
)
def audited_table_load(spark, sf):
    df = table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path, log = scratch_path(spark, "customer"), scratch_path(spark, "audit")
    when = datetime(2024, 1, 1)
    load.load_table(df, path, CUSTOMER_TARGET, log, "Demo", "customer.py", "Customers", entry_date=when)
    # One column too few: audited as an error, the table stays as it is.
    load.load_table(df.drop("c_name"), path, CUSTOMER_TARGET, log, "Demo", "customer.py", "Customers", entry_date=when)
    entries = spark.read.schema(audit.AUDIT_SCHEMA).parquet(log)
    trail = entries.agg(
        F.concat(
            F.max(F.when(F.col("log_type") == "I", F.concat(F.lit("I"), "rec_count"))), F.lit(","),
            F.max(F.when(F.col("log_type") == "E", F.concat(F.lit("E"), "rec_count"))),
        ).alias("t")
    )
    loaded = spark.read.schema(CUSTOMER_TARGET).parquet(path)
    per_segment = loaded.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("balance"), 2).alias("balance")
    )
    return per_segment.withColumn("log", trail.scalar())


@query(
    "full_refresh_state",
    "O-12",
    "SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_totalprice > 200000 GROUP BY 1",
)
def full_refresh_state(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "refresh")
    load.full_refresh(orders, path)
    load.full_refresh(orders.filter("o_totalprice > 200000"), path)
    return spark.read.schema(orders.schema).parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "snapshots_with_stamps",
    "O-13 O-23",
    """
    SELECT '2024-01-05' AS load_day, 'loader' AS "LoadBy", 'customer' AS "LoadSource", count(*) AS customers FROM customer
    UNION ALL SELECT '2024-01-12', 'loader', 'customer', count(*) FROM customer WHERE c_acctbal > 0
    """,
)
def snapshots_with_stamps(spark, sf):
    people = table(spark, sf, "customer", "c_custkey", "c_acctbal")
    path = scratch_path(spark, "snapshots")
    for day, rows in (("2024-01-05", people), ("2024-01-12", people.filter("c_acctbal > 0"))):
        load.append_snapshot(cols.stamp_load(rows, f"{day} 06:00:00", "loader", "customer"), path)
    return (
        spark.read.parquet(path)
        .groupBy(day_text("LoadDtm").alias("load_day"), "LoadBy", "LoadSource")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


@query(
    "replaced_year",
    "O-14",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders,
           round(sum(CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1 ELSE o_totalprice END), 2) AS value
    FROM orders GROUP BY 1
    """,
)
def replaced_year(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    path = scratch_path(spark, "slices")
    load.replace_slice(orders, path, ["order_year"])
    changed = orders.filter("order_year = 1997").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    load.replace_slice(changed, path, ["order_year"])
    load.replace_slice(changed, path, ["order_year"])  # a retry changes nothing
    return (
        spark.read.schema(orders.schema)
        .parquet(path)
        .groupBy("order_year")
        .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value"))
    )


@query(
    "slice_deleted_and_appended",
    "O-14 O-81",
    """
    SELECT o_orderpriority, count(*) AS orders, round(sum(CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_totalprice * 2 ELSE o_totalprice END), 2) AS value
    FROM orders GROUP BY 1
    """,
)
def slice_deleted_and_appended(spark, sf):
    orders = table(spark, sf, "orders", "o_orderpriority", "o_totalprice", "o_orderdate")
    recent = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    renewed = orders.filter(recent).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    state = load.without_slice(orders, recent).unionByName(renewed)
    return state.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value")
    )


@query("staged_base_table", "O-15", "SELECT p_brand, count(*) AS parts FROM part WHERE p_size > 10 GROUP BY 1")
def staged_base_table(spark, sf):
    parts = table(spark, sf, "part", "p_partkey", "p_brand", "p_size")
    stage, base = scratch_path(spark, "stage"), scratch_path(spark, "base")
    load.full_refresh(parts, base)
    load.staged_swap(parts.filter("p_size > 10"), stage, base)
    return spark.read.schema(parts.schema).parquet(base).groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))


@query(
    "last_refresh_per_area",
    "O-16",
    """
    WITH log AS (SELECT CASE event_type WHEN 'error' THEN 'E' WHEN 'view' THEN 'W' ELSE 'I' END AS log_type,
        'Python: job' || user_id || '.py' AS log_source, event_type AS data_area, ts AS entry_date, value FROM events)
    SELECT log_source, data_area, strftime(max(entry_date), '%Y-%m-%d %H:%M:%S') AS last_refresh FROM log WHERE log_type = 'I' GROUP BY 1, 2
    """,
)
def last_refresh_per_area(spark, sf):
    kind = F.when(F.col("event_type") == "error", "E").when(F.col("event_type") == "view", "W").otherwise("I")
    log = table(spark, sf, "events", "user_id", "event_type", "ts").select(
        kind.alias("log_type"),
        F.lit("Demo").alias("scope"),
        F.concat(F.lit("Python: job"), "user_id", F.lit(".py")).alias("log_source"),
        F.col("event_type").alias("data_area"),
        F.col("ts").alias("entry_date"),
    )
    latest = audit.last_refresh(log, scope="Demo")
    return latest.select("log_source", "data_area", F.date_format("entry_date", "yyyy-MM-dd HH:mm:ss").alias("last_refresh"))


@query(
    "days_picked_up_by_stream",
    "O-17 O-18 O-14",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1
    """,
)
def days_picked_up_by_stream(spark, sf):
    events = table(spark, sf, "events", "event_id", "ts", "value").select("event_id", "value", day_text("ts").alias("day"))
    landing, target, mark = (scratch_path(spark, k) for k in ("landing", "picked", "mark"))
    # Every day comes in two drops: the later one adds to its slice.
    events.filter("event_id % 2 = 0").write.parquet(landing)
    pick_up_new_files(spark, landing, events.schema, mark, replace_slices(target, ["day"]))
    events.filter("event_id % 2 = 1").write.mode("append").parquet(landing)
    pick_up_new_files(spark, landing, events.schema, mark, replace_slices(target, ["day"]))
    pick_up_new_files(spark, landing, events.schema, mark, replace_slices(target, ["day"]))  # nothing new
    parts = [T.StructField("day", T.StringType()), T.StructField("load_batch", T.LongType())]
    schema = T.StructType([f for f in events.schema if f.name != "day"] + parts)
    picked = spark.read.schema(schema).parquet(target)
    return picked.groupBy("day").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "ids_filled_from_earlier_records",
    "O-19",
    """
    WITH h AS (SELECT o_custkey, o_orderpriority, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderstatus <> 'P'),
    last AS (SELECT o_custkey AS k, o_orderpriority AS p FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority) AS r FROM h) WHERE r = 1)
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, p) AS o_orderpriority
    FROM orders LEFT JOIN last ON o_custkey = k WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    """,
)
def ids_filled_from_earlier_records(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    orders = orders.withColumn("o_orderpriority", known)
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    current = orders.filter(F.col("o_orderdate") >= cut)
    history = orders.filter(F.col("o_orderdate") < cut)
    filled = load.fill_from_earlier(current, history, "o_custkey", "o_orderpriority", "o_orderdate")
    return filled.select("o_orderkey", "o_orderpriority")


@query(
    "ids_filled_as_of_each_date",
    "O-19",
    """
    WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS kind FROM events)
    SELECT event_id, coalesce(kind, (SELECT max(struct_pack(ts := h.ts, id := h.event_id, kind := h.kind)).kind FROM e h
      WHERE h.user_id = e.user_id AND h.ts < e.ts AND h.kind IS NOT NULL)) AS kind FROM e
    """,
)
def ids_filled_as_of_each_date(spark, sf):
    """Missing kinds from the user's latest earlier event, for all report times in one run."""
    kind = F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind")
    events = table(spark, sf, "events", "event_id", "user_id", "ts", "event_type").select("event_id", "user_id", "ts", kind)
    return asof.fill_as_of(events, events, ["user_id"], "kind", "ts", "ts", tie=["event_id"]).select("event_id", "kind")


@query(
    "appended_twice_under_one_id",
    "O-13 O-09",
    "SELECT o_orderstatus, count(*) AS orders, 'week-1' AS load_id FROM orders GROUP BY 1 UNION ALL SELECT 'F', count(*), 'week-2' FROM orders WHERE o_orderstatus = 'F'",
)
def appended_twice_under_one_id(spark, sf):
    """A load that is run again after a failure adds nothing twice."""
    path, orders = scratch_path(spark, "appended"), table(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    load.append_snapshot(orders, path, load_id="week-1")
    load.append_snapshot(orders.filter("o_orderstatus = 'F'"), path, load_id="week-2")
    load.append_snapshot(orders, path, load_id="week-1")
    read = spark.read.option("partitionOverwriteMode", "dynamic").parquet(path)
    return read.groupBy("o_orderstatus", F.col("load_id").cast("string").alias("load_id")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "nulls_updated_after_load",
    "O-20",
    """
    SELECT CASE WHEN o_orderstatus = 'P' AND year(o_orderdate) = 1998 THEN 'N/A' WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS target,
           count(*) AS orders FROM orders GROUP BY 1
    """,
)
def nulls_updated_after_load(spark, sf):
    df = table(spark, sf, "orders", "o_orderstatus", "o_orderdate").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("target"), "o_orderdate"
    )
    df = load.fill_nulls(df, "target", "N/A", F.year("o_orderdate") == 1998)
    return df.groupBy("target").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "earliest_log_per_key",
    "O-21",
    """
    SELECT event_id, user_id, event_type FROM (SELECT *, min(CAST(ts AS DATE)) OVER (PARTITION BY user_id, event_type) AS m FROM events)
    WHERE CAST(ts AS DATE) = m
    """,
)
def earliest_log_per_key(spark, sf):
    df = table(spark, sf, "events", "event_id", "user_id", "event_type", "ts").withColumn("logged", F.to_date("ts"))
    return load.keep_earliest(df, ["user_id", "event_type"], "logged").select("event_id", "user_id", "event_type")
