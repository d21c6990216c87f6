import os
from datetime import datetime

import pytest
from support import rows
from pyspark.sql import functions as F, types as T

from lodestock.operators import audit
from lodestock.sources import database, delimited, documents, incremental, markup, records
from lodestock.operators.load import replace_slice
from lodestock.streaming.pickup import pick_up_new_files, replace_slices


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_line_numbers_across_blocks(spark, tmp_path):
    for name, n in (("a.txt", 500), ("b.txt", 40)):
        write(tmp_path / name, "".join(f"{name} {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = delimited.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 540
    assert all(r.line.split()[1] == str(r.row_pos) for r in got)


def test_sheet_with_preamble_and_tokens(spark, tmp_path):
    path = write(tmp_path / "s.csv", 'Report\n\nName,Qty,Note\nBolt,5,"a, b"\nNut,n/a,-\n')
    df = delimited.read_sheet(spark, path, header_row=2, na_values=["-"]).drop("file")
    assert rows(df, "row_pos") == [(0, "Bolt", "5", "a, b"), (1, "Nut", None, None)]


def test_two_row_header(spark, tmp_path):
    path = write(tmp_path / "p.csv", "title\n,,DDR4,,DDR5\nYear,Month,High,Low,High\n2021,Jan,3,2,9\n,Feb,4,1,8\n")
    df = delimited.read_sheet(spark, path, header_row=[1, 2]).drop("file")
    assert df.columns == ["row_pos", "Year", "Month", "DDR4|High", "DDR4|Low", "DDR5|High"]
    assert rows(df, "row_pos") == [(0, "2021", "Jan", "3", "2", "9"), (1, None, "Feb", "4", "1", "8")]


def test_sheets_by_position(spark, tmp_path):
    sheets = {n: write(tmp_path / f"{n}.csv", f"{n},1\n") for n in ("x", "y")}
    df = delimited.read_sheets(spark, sheets, header_row=None, names=["k", "v"])
    assert rows(df.select("sheet", "k", "v"), "sheet") == [("x", "x", "1"), ("y", "y", "1")]


def test_csv_options(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a;b\n'x;y';\n")
    assert rows(delimited.read_csv(spark, path, "a string, b string", sep=";", quote="'")) == [("x;y", None)]
    assert delimited.read_csv(spark, str(tmp_path), "a string", modified_after="2999-01-01T00:00:00").count() == 0


def test_json_records(spark):
    df = spark.createDataFrame([(1, '{"elements": [{"id": 1, "o": {"n": "x"}}, {"id": 2}]}'), (2, '{"elements": []}')], "page int, body string")
    got = records.explode_records(df, "body", "id: int, o: struct<n: string>").select("page", "id", "o.n")
    assert rows(got, "id") == [(1, 1, "x"), (1, 2, None)]


def test_feed_and_table(spark):
    feed = "<rss><item><title>A</title><gdacs:country>X</gdacs:country></item><item><title>B</title></item></rss>"
    df = spark.createDataFrame([(feed,)], "body string")
    assert rows(markup.feed_items(df, "body", {"title": "t", "gdacs:country": "c"}), "item_pos") == [(0, "A", "X"), (1, "B", None)]
    html = "<table><tr><td>a</td><td><b>1</b></td></tr><tr><td>c</td></tr></table>"
    table = markup.table_rows(spark.createDataFrame([(html,)], "body string"), "body", ["k", "v"])
    assert rows(table, "row_pos") == [(0, "a", "1"), (1, "c", None)]


def test_documents(spark, tmp_path):
    write(tmp_path / "one.txt", "a\nb")
    write(tmp_path / "skip.csv", "c")
    assert rows(documents.read_documents(spark, str(tmp_path))) == [("one", "a\nb")]


def test_year_predicates():
    assert database.year_predicates("d", 2020, 2021) == [
        "d >= DATE '2020-01-01' AND d < DATE '2021-01-01'",
        "d >= DATE '2021-01-01' AND d < DATE '2022-01-01'",
    ]
    options = database.query_options("jdbc:x", "SELECT 1;")
    assert options["dbtable"] == "(SELECT 1) q" and options["fetchsize"] == "10000"


def test_stamps(spark):
    paths = [("/in/PSI_2022.05.3.csv",), ("/in/PSI_2022.04.1.csv",), ("/in/none.csv",)]
    df = incremental.newer_than_stamp(spark.createDataFrame(paths, "p string"), "p", "2022.04.5")
    assert rows(df.select("stamp")) == [("2022.05.3",)]


def test_modified_since(spark, tmp_path):
    old, new = write(tmp_path / "old.txt", "o"), write(tmp_path / "new.txt", "n")
    os.utime(old, (1000, 1000))
    changed = incremental.modified_since(spark.read.text(str(tmp_path)), F.lit("2000-01-01").cast("timestamp"))
    assert rows(changed.select("value")) == [("n",)] and new


def test_last_refresh(spark):
    entries = [
        ("I", "p", "Python: a", "x", 1, None, datetime(2024, 1, 1)),
        ("I", "p", "Python: a", "x", 1, None, datetime(2024, 1, 3)),
        ("E", "p", "Python: a", "x", 0, "bad", datetime(2024, 1, 9)),
        ("I", "q", "Python: a", "x", 1, None, datetime(2024, 1, 8)),
    ]
    log = spark.createDataFrame(entries, audit.AUDIT_SCHEMA)
    assert [r.entry_date for r in audit.last_refresh(log, "p", "x").collect()] == [datetime(2024, 1, 3)]
    assert audit.last_refresh(log, "p", "none").count() == 0
    warned = audit.warning_row(spark, "p", "job.py", "x", "/in").first()
    assert warned.log_type == "W" and warned.log_comment == "Nothing to read in /in."
    with pytest.raises(ValueError):
        audit.audit_row(spark, "Z", "p", "a", "x")


def test_stream_loads_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("day", T.StringType())])
    landing, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    drop = lambda *r: spark.createDataFrame(list(r), schema).coalesce(1).write.mode("append").parquet(landing)
    load = replace_slices(target, ["day"])
    drop((1, "mon"), (2, "tue"))
    assert pick_up_new_files(spark, landing, schema, mark, load) == 1
    assert pick_up_new_files(spark, landing, schema, mark, load) == 0
    drop((5, "tue"), (6, "wed"))
    assert pick_up_new_files(spark, landing, schema, mark, load) == 1
    landed = spark.read.schema(schema).parquet(target).select("v", "day")
    assert rows(landed, "v") == [(1, "mon"), (2, "tue"), (5, "tue"), (6, "wed")]  # a late file adds to its day


def test_cleared_slices(spark, tmp_path):
    """A slice named as cleared does not keep its rows when the new data has none of it."""
    path = str(tmp_path / "slices")
    schema = "v int, day string"
    rows_of = lambda: {(r.v, r.day) for r in spark.read.schema(schema).parquet(path).collect()}
    replace_slice(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], schema), path, ["day"])
    new = spark.createDataFrame([(4, "2024-01-03")], schema)
    replace_slice(new, path, ["day"], cleared=[("2024-01-01",), ("2024-01-09",), (None,)])
    assert rows_of() == {(2, "2024-01-02"), (4, "2024-01-03")}
    with pytest.raises(ValueError):
        replace_slice(new, path, ["day"], cleared=[("a/b",)])
