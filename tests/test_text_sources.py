"""Quoted line breaks, headers per file, nested markup, and landed pages."""

import csv
import io
import random

import pytest
from hypothesis import given, settings, strategies as st
from support import rows
from pyspark.sql import functions as F

from lodestock.functions.text import html_to_text
from lodestock.sources import delimited, markup, paged
from lodestock.sources.records_in_text import QuoteReader, quoted_records


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text('ab,"\n ', max_size=6), min_size=1, max_size=4), min_size=1, max_size=6))
def test_reader_cuts_where_the_csv_module_does(table):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(table)
    lines, reader, inside, records = text.getvalue().split("\n")[:-1], QuoteReader(), False, 0
    for line in lines:
        records += not inside
        inside = reader.after(line, inside)
    assert not inside and records == len(table)


def test_quotes_within_a_cell_are_signs():
    reader = QuoteReader()
    assert not reader.after('5" pipe,3', False) and not reader.after('a,"b ""c""",d"', False)
    assert reader.after('x,"open', False) and reader.after('still ""open""', True) and not reader.after('end",5" pipe', True)
    assert QuoteReader(";", "'").after("a;'b", False) and not QuoteReader("|").after('a|b"', False)


@pytest.mark.parametrize("size", ["150", "700", "128MB"])
def test_records_over_blocks(spark, tmp_path, size):
    """Blocks that begin inside a cell, cells longer than a block, and files of one layout."""
    rng = random.Random(7)
    wanted = {}
    for name in ("a", "b"):
        table = [[f"{name}{i}", "\n".join("x" * rng.randint(0, 60) for _ in range(rng.choice([1, 1, 2, 9]))), 'q"' * (i % 3)] for i in range(60)]
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            csv.writer(file, lineterminator="\n").writerows([["name", "note", "sign"], *table])
        wanted[name] = table
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = delimited.read_sheet(spark, str(tmp_path), keep_default_na=False).collect()
        assert quoted_records(spark, str(tmp_path)).count() == 122
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name, table in wanted.items():
        own = sorted((r for r in got if r["file"].endswith(f"{name}.csv")), key=lambda r: r["row_pos"])
        assert [r["row_pos"] for r in own] == list(range(60))
        assert [[r["name"] or "", r["note"] or "", r["sign"] or ""] for r in own] == table


def test_each_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Report\nName,Qty\nBolt,5\n"Nut\nM8",7\n')
    (tmp_path / "b.csv").write_text('Report,of,b\nQty,"Made\nby",Name\n9,X,Screw\n')
    (tmp_path / "c.csv").write_text("too short\n")
    df = delimited.read_sheet(spark, str(tmp_path), header_row=1)
    assert df.columns == ["file", "row_pos", "Name", "Qty", "Made by"]
    assert rows(df.drop("file"), "Name") == [(0, "Bolt", "5", None), (1, "Nut\nM8", "7", None), (0, "Screw", "9", "X")]


def test_header_names():
    assert delimited.header_names(["a,,b,a,a"]) == ["a", "Unnamed: 1", "b", "a.1", "a.2"]
    assert delimited.header_names(["G,,H", "x,y,x"]) == ["G|x", "G|y", "H|x"]


def test_an_open_cell_runs_to_the_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"never\nclosed\n2,3\n')
    (tmp_path / "b.csv").write_text("x,y\n4,5\n")
    got = quoted_records(spark, str(tmp_path))
    assert rows(got.select("row_pos", "line").filter("row_pos > 0"), "line") == [(1, '1,"never\nclosed\n2,3'), (1, "4,5")]


def inner(spark, text, tag):
    return [tuple(r) for r in spark.createDataFrame([(text,)], "t string").select(F.inline(markup.elements(F.col("t"), tag))).collect()]


def test_equal_tags_in_each_other(spark):
    text = "<ul><li>A<ul><li>B</li><li>C<ul><li>D</li></ul></li></ul></li><li>E</li></ul>"
    assert inner(spark, text, "li") == [
        ("A<ul><li>B</li><li>C<ul><li>D</li></ul></li></ul>", 0), ("B", 1), ("C<ul><li>D</li></ul>", 1), ("D", 2), ("E", 0),
    ]


def test_signs_that_are_no_tags(spark):
    assert inner(spark, "<p title=\"a > b\" x='>'>one</p><!-- <p>no</p> --><p x=don't>two</p><pre>no</pre>", "p") == [("one", 0), ("two", 0)]
    assert inner(spark, "<t><![CDATA[<t>a</t>]]></t><t/><t a='1'/><t>open", "t") == [("<![CDATA[<t>a</t>]]>", 0), ("", 0), ("", 0), ("open", 0)]
    assert inner(spark, "</p>x</p><p>é😀</p\n>", "p") == [("é😀", 0)] and inner(spark, "", "p") == [] == inner(spark, None, "p")


def test_tables_in_tables(spark):
    html = "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr><tr><td>c</td></tr></table>"
    got = markup.table_rows(spark.createDataFrame([(html,)], "body string"), "body", ["k", "v"])
    assert rows(got, "row_pos") == [(0, "ain", "b"), (1, "c", None)]


def test_text_of_tags_with_quoted_signs(spark):
    cases = {
        '<a href="x>y" b=\'>\'>t</a>': "t", "<p x=don't>one</p> it's": "one it's", "a &amp;lt; &#38;lt; &lt;": "a &lt; &lt; <",
        "&eacute;&amp;amp;&nbsp;&copy;": "é&amp; ©", "&unknown; & &;": "&unknown; & &;", "3 < 4 > 2": "3 < 4 > 2", "&amp;eacute;": "&eacute;",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["x"] for r in df.select("t", html_to_text("t").alias("x")).collect()} == cases


def test_pages_are_read_once(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / x) for x in ("pages", "out", "offsets"))
    (tmp_path / "pages").mkdir()

    def land(number, body):
        (tmp_path / "pages" / f"page-{number:03d}.json").write_text(body)

    for n in (1, 2, 4):
        land(n, f"body {n}")
    (tmp_path / "pages" / "other.txt").write_text("no page")
    assert rows(paged.read_pages(spark, folder, 2), "page") == [(1, "body 1"), (2, "body 2"), (4, "body 4")]
    paged.load_new_pages(spark, folder, target, checkpoint)
    read = spark.read.schema(paged.SCHEMA).parquet
    assert [r[0] for r in rows(read(target), "page")] == [1, 2]  # page 3 may still come
    land(3, "late")
    land(1, "changed later")
    for _ in range(2):
        paged.load_new_pages(spark, folder, target, checkpoint)
    assert rows(read(target), "page") == [(1, "body 1"), (2, "body 2"), (3, "late"), (4, "body 4")]


def test_a_page_may_be_a_folder(tmp_path):
    (tmp_path / "page=7").mkdir()
    (tmp_path / "page=7" / "part-1.txt").write_text("b")
    (tmp_path / "page=7" / "part-0.txt").write_text("a")
    (tmp_path / "page=7" / "_SUCCESS").write_text("")
    pages = paged.landed_pages(str(tmp_path))
    assert list(pages) == [7] and list(paged.page_body(str(tmp_path), pages[7])) == ["a", "b"]
    assert paged.landed_pages(str(tmp_path / "none")) == {}
