from datetime import date, datetime

import pytest
from support import rows
from pyspark.sql import functions as F

from lodestock.functions import dates, numbers, text


def one(spark, ddl, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {ddl}")
    return [r[1:] if len(columns) > 1 else r[1] for r in rows(df.select("i", *columns), "i")]


def test_blank_and_na(spark):
    assert one(spark, "string", ["", " \t", " ", "a ", None], text.blank_to_null("c")) == [None, None, None, "a ", None]
    got = one(spark, "string", ["n/a", "NaN", "-", "x", None], text.na_to_null("c", ["-"]))
    assert got == [None, None, None, "x", None]
    assert one(spark, "string", ["n/a", "-"], text.na_to_null("c", ["-"], keep_default=False)) == ["n/a", None]


@pytest.mark.parametrize(
    "policy,expected",
    [
        ("false", [True, False, False, False, False, False]),
        ("null", [True, False, None, None, None, None]),
        ("text", [True, False, True, True, True, None]),
        ("short", [True, False, True, False, False, False]),
    ],
)
def test_yes_no(spark, policy, expected):
    assert one(spark, "string", ["YES", "No", "y", "n", "maybe", None], text.yes_no("c", policy)) == expected


def test_value_maps(spark):
    values = ["NA", "b", None]
    assert one(spark, "string", values, text.map_values("c", {"NA": None, "b": "B"})) == [None, "B", None]
    assert one(spark, "string", values, text.map_values("c", {"b": "B"}, keep_unmapped=False)) == [None, "B", None]
    assert one(spark, "string", values, text.null_where(F.lit(1), "c", ["b"])) == [1, None, 1]
    assert one(spark, "string", ["00000000", "x", None], text.sentinel_to_null("c", ["00000000"])) == [None, "x", None]


def test_html(spark):
    html = "<p class='a'>A &lt;b&gt; &amp;lt; 1 < 2<!-- no --><script>if (a<b) {}</script></p>"
    assert one(spark, "string", [html, None], text.html_to_text("c")) == ["A <b> &lt; 1 < 2", None]


def test_entities(spark):
    values = ["&amp;lt; &eacute;&#233;&#xE9;&#128512; &euro;", "&bogus; & &#0; &#xD800; &#9999999;", "&nbsp;&#160;", "", None]
    found = one(spark, "string", values, text.decode_entities("c"))
    assert found == ["&lt; \u00e9\u00e9\u00e9\U0001f600 \u20ac", "&bogus; & &#0; &#xD800; &#9999999;", "  ", "", None]


def test_code_category(spark):
    rules = [({"c": ["a", "b"]}, [({"c": ["a"]}, "first")]), ({"c": ["d"]}, "second")]
    assert one(spark, "string", ["a", "b", "d", "e", None], text.code_category(rules)) == ["first", None, "second", None, None]


def test_lists(spark):
    got = one(spark, "string", ["Team list, Doe, Ann, Roe, Bob", "Doe, Ann, Roe"], text.tokens_every("c", drop_prefix="Team "))
    assert got == [["DOE, ANN", "ROE, BOB"], ["DOE, ANN", "ROE"]]
    got = one(spark, "string", ["Add CEID: AB, CD", "plain", None], text.listed_after("c", "CEID: "))
    assert got == [["Add CEID: AB", "Add CEID: CD"], ["plain"], [None]]


def test_joined_map_values(spark):
    df = spark.createDataFrame([({"a": "Zed", "b": "Amy"},), ({"0": "One"},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(text.joined_map_values("m")).collect()] == ["Amy,Zed", "One", "None"]


def test_memory_names(spark):
    names = ["8GB DDR4 UDIMM 1Gx8", "16GB DDR4 LR/RDIMM 2Gx4", "4Gb 512Mb 256"]
    got = one(spark, "string", names, text.memory_name_parts("c"))
    assert [tuple(g) for g in got] == [("DDR4", "UDIMM", "x8"), ("DDR4", "LRDIMM", "x4"), ("512Mb", None, None)]


def test_number_parsing(spark):
    assert one(spark, "string", ["1,250 EA", "", "x", None], numbers.digits_to_number("c")) == [1250.0, None, None, None]
    assert one(spark, "string", ["WW12.5, WW14", "202212"], numbers.week_number("c")) == [12.5, 2022.0]
    assert one(spark, "string", ["1 (1 ST of 1)", "12 EA"], numbers.leading_quantity("c")) == [1.0, 12.0]
    assert one(spark, "string", [" $1,234.50 ", "-3", "n", None], numbers.money("c")) == [1234.5, -3.0, None, None]
    assert one(spark, "double", [1e15, None], numbers.id_text("c")) == ["1000000000000000", None]


def test_rounding_and_ratio(spark):
    assert one(spark, "double", [0.5, 1.5, 2.5, -0.5], numbers.half_even("c")) == [0.0, 2.0, 2.0, -0.0]
    assert one(spark, "double", [0.0, 4.0, None], numbers.ratio(F.lit(2.0), "c")) == [None, 0.5, None]


def test_bands_and_units(spark):
    label = numbers.band("c", [2, 5], ["low", "mid", "high"])
    assert one(spark, "int", [1, 2, 4, 5, None], label) == ["low", "mid", "mid", "high", None]
    got = one(spark, "string", ["8GB", "8Gb", "8MB", "8Mb", "8KB", "8TB"], numbers.density_gigabytes("c"))
    assert got == [8.0, 1.0, 0.008, 0.001, 0.000008, None]


def test_dates(spark):
    got = one(spark, "string", ["03/05/2021", "2021-03-05", "03/05/1999", "x", None], dates.parse_date("c", ["MM/dd/yyyy", "yyyy-MM-dd"], 2000))
    assert got == [date(2021, 3, 5), date(2021, 3, 5), None, None, None]
    days = [date(2024, 1, 20), date(2024, 1, 21), date(2024, 3, 31)]
    assert one(spark, "date", days, dates.report_month("c")) == [date(2023, 12, 1), date(2024, 1, 1), date(2024, 3, 1)]
    assert one(spark, "string", ["Q3-21"], dates.quarter_label("c")) == ["2021-Q03"]
    assert one(spark, "string", ["Jan 21"], dates.month_label_date("c")) == [date(2021, 1, 1)]
    closed = [date(2024, 1, 5), None]
    assert one(spark, "date", closed, dates.days_open("c", F.lit("2024-01-01").cast("date"), "2024-01-11")) == [4, 10]
    assert one(spark, "date", [date(2024, 1, 1), date(2024, 1, 2)], dates.expired_flag("c", "2024-03-31")) == ["n", "y"]
    valid = dates.in_effect(F.lit("2024-01-01").cast("date"), "c", "2024-02-01")
    assert one(spark, "date", [date(2024, 2, 1), date(2024, 2, 2)], valid) == [False, True]


def test_time_zone(spark):
    got = one(spark, "timestamp", [datetime(2024, 1, 1, 8)], F.date_format(dates.to_utc("c", "US/Pacific"), "HH:mm"))
    assert got == ["16:00"]
