"""Long lists: time in step with the text."""

import time

from pyspark.sql import functions as F

from lodestock.sources import markup
from support import rows


def nested(items):
    return "<ul><li><a>top</a><ul>" + "".join(f"<li><a>é{i}</a><!-- <li> --></li>" for i in range(items)) + "</ul></li></ul>"


def test_long_list_in_a_list(spark):
    n = 60_000
    df = spark.createDataFrame([(1, nested(n)), (2, nested(2)), (3, None), (4, "")], "page int, body string")
    began = time.time()
    items = markup.feed_items(df, "body", {"a": "link", "ul": "inside", "b": "none"}, item="li")
    found = items.groupBy("page").agg(F.count("*"), F.count("inside"), F.max(F.when(F.col("item_pos") > 0, F.col("link"))), F.count("none"))
    assert rows(found, "page") == [(1, n + 1, 1, "é9999", 0), (2, 3, 1, "é1", 0)]
    spans = df.select("page", F.size(markup.elements(F.col("body"), "li")).alias("n")).filter("page != 3")
    assert rows(spans, "page") == [(1, n + 1), (2, 3), (4, 0)]
    assert time.time() - began < 60


def test_items_keep_odd_columns(spark):
    df = spark.sql("SELECT array(1, null) AS `a.b`, timestamp'2024-01-02 03:04:05' AS t, '<i>x<k/></i><i>y<k>1<k>2</k></k>' AS body")
    df = df.withColumnRenamed("a.b", "ab")
    got = markup.feed_items(df, "body", {"k": "k"}, item="i")
    assert got.columns == ["ab", "t", "item_pos", "k"]
    assert [(r["ab"], r["t"].year, r["item_pos"], r["k"]) for r in got.orderBy("item_pos").collect()] == [([1, None], 2024, 0, ""), ([1, None], 2024, 1, "1<k>2</k>")]
