from datetime import date, datetime

import pytest
from support import rows
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lodestock.ml import features, models, text as words
from lodestock.plans import contracts, costs, incidents, phrases, stock, survey, tools


def test_returns_at_the_age_limit_count_nowhere(spark):
    items = spark.createDataFrame([("i",)], "item string")
    returns = spark.createDataFrame(
        [("i", 1, date(2024, 1, 1)), ("i", 2, date(2024, 1, 2)), ("i", 4, date(2024, 1, 3))], "part string, return_qty int, returned_on date"
    )
    got = stock.open_returns(items, returns, F.lit("2024-01-16").cast("date"), {"item": "part"})
    assert rows(got) == [("i", 1, 4)]


def test_dispositions(spark):
    ddl = (
        "item string, avail_qty int, max_qty int, open_po_qty int, open_order_qty int, reject_qty int, nrr_aging int, "
        "nrr_not_aging int, category string, new_price double, oldest_order timestamp"
    )
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 30)
    data = [
        ("exact", 0, 20, 0, 1, 1, 0, 0, None, 100.0, old),  # 20 missing, 2000: neither of the last codes
        ("cheap", 0, 10, 0, 0, 0, 2, 0, "x", 100.0, None),
        ("dear", 0, 50, 0, 2, 0, 0, 3, "x", 100.0, new),
        ("idle", 0, 10, 0, 0, 5, 0, 0, "In House Repair", 1.0, None),
        ("house", 0, 10, 0, 4, 5, 0, 0, "In House Repair", 1.0, old),
        ("full", 90, 10, 0, 0, 0, 0, 0, None, 1.0, None),
    ]
    excess = spark.createDataFrame([("dear", 5)], "item string, excess_qty int")
    out = stock.dispositions(spark.createDataFrame(data, ddl), excess, F.lit("2024-02-01").cast("date"))
    got = {r["item"]: r for r in out.collect()}
    assert set(got) == {"exact", "cheap", "dear", "idle", "house"}
    assert got["exact"].disposition == "1-Release Repair PO" and got["exact"].missing_amount == 2000
    assert got["cheap"].disposition == ";2-Facilitate NRR Returns;4-Release New Buy PO"
    assert got["dear"].disposition == (
        ";2-Facilitate NRR Returns;3-Initiate Excess Transfer;5-Require CostRep Disposition (NB/Algo/Backorder)"
    )
    assert got["idle"].disposition == "0-No Action" and got["idle"].final_missing_qty == 5
    assert got["house"].disposition == "1-Release Repair PO" and got["house"].final_missing_qty == 0
    assert [got[i].backorder_age for i in ("exact", "cheap", "dear")] == ["Aging", "", "NotAging(<7days)"]


def test_linked_tools_keep_nulls_and_duplicates(spark):
    ddl = (
        "`T1 Supplier Name` string, Entity string, SSEID int, `T1 Site` string, `Tool Quantity` int, "
        "T2ExFD_Tool1 string, T2ExFD_Tool2 string, T2TD_Tool1 string, T2TD_Tool3 string"
    )
    data = [
        (None, "e", 1, None, None, "01/02/2021", None, "03/04/1999", None),
        ("s", "f", 2, "x", 2, None, None, None, "05/06/2022"),
    ]
    got = rows(tools.linked_tools(spark.createDataFrame(data, ddl)).select("Entity", "LinkedTool", "T2ExFD", "T2TD"), "Entity", "LinkedTool")
    assert got == [
        ("e", "Tool1", date(2021, 1, 2), None),
        ("f", "Tool1", None, None),
        ("f", "Tool2", None, None),
        ("f", "Tool3", None, date(2022, 5, 6)),
    ]


def test_costs_skip_zero_quantities(spark):
    standard = spark.createDataFrame([("p", "i", 10.0, 2, "EUR", 1, date(2024, 1, 1))], "plant string, item string, price double, price_unit int, currency string, year_week int, as_of date")
    rates = spark.createDataFrame([("EUR", 1, 1.5)], "currency string, year_week int, rate double")
    invoices = spark.createDataFrame([("p", "i", 0.0, 5.0), ("p", "i", 1.0, 4.0), ("p", "i", 3.0, 6.0)], "plant string, item string, quantity double, amount double")
    fair = spark.createDataFrame([("p", "i", 2.0), ("p", "i", 4.0)], "plant string, item string, value double")
    got = {r.model: (r.unit_cost, r.unit_cost_x100) for r in costs.unit_costs(standard, rates, invoices, fair).collect()}
    assert got == {"Standard Cost": (7.5, 750.0), "Weighted Average": (2.5, 250.0), "Fair Market Value": (3.0, 300.0)}


def test_survey(spark):
    body = (
        '{"questions": {"QID1": {"questionName": "Q1", "questionType": {"type": "MC"}, "choices": {"1": {"choiceText": "Yes"},'
        ' "4": {"choiceText": "Other"}}}, "QID2": {"questionName": "Q2", "questionType": {"type": "TE"}}}}'
    )
    labels = survey.choice_labels(spark.createDataFrame([(body,)], "body string"), "body")
    answers = spark.createDataFrame(
        [(1, "1", None, "5"), (2, "4", "by bus", None), (3, "9", None, "9"), (4, None, None, "1")],
        "id int, `Q1 how` string, `Q1_4_TEXT how` string, `Q3 ok` string",
    )
    got = rows(survey.decode_answers(answers, labels, ["Q1 how"], ["Q3 ok"], {("Q1 how", "4"): "Q1_4_TEXT how"}), "id")
    assert got == [(1, "Yes", "Strongly Disagree"), (2, "by bus", None), (3, "Old", None), (4, None, "Strongly Agree")]


def test_price_columns(spark):
    cells = [("d", 1, 1, 1, "77"), ("d", 1, 1, 2, "$1,200.50"), ("d", 1, 1, 3, "1200.5"), ("d", 1, 2, 1, "88"), ("d", 1, 2, 3, "9"), ("e", 1, 1, 1, "x")]
    prices = [("77", 1200.5), ("88", 9.0)]
    out = contracts.price_column_labels(
        spark.createDataFrame(cells, "document string, `table` int, `row` int, `column` int, value string"),
        spark.createDataFrame(prices, "item string, price double"),
    )
    assert rows(out.select("document", "column", "label"), "document", "column") == [
        ("d", 1, "NotPrice"), ("d", 2, "NotPrice"), ("d", 3, "Price"), ("e", 1, "Other"),
    ]


def test_phrases(spark):
    docs = spark.createDataFrame([(1, "The net price; the-neté NET price, thenet price"), (2, "none")], "id int, t string")
    got = rows(phrases.phrase_counts(docs, "id", "t", ["the", "net price", "net"]))
    assert got == [(1, 2, 2, 2, 6)]


def test_incident_without_fields(spark):
    body = "<h4>Incident Details</h4><table><tr><td>Eruption at X</td></tr><tr><td>Time: 11:30 PM UTC on 05 May 2021</td></tr></table>"
    row = incidents.incident_fields(spark.createDataFrame([(1, body)], "id int, body string"), "id", "body").first()
    assert (row.incident, row.time, row.incident_type) == ("Eruption at X", datetime(2021, 5, 5, 23, 30), "Volcano")
    assert row.link is None and row.latitude is None and row.outage_probability is None


# --- models ----------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    df = spark.range(400).select(
        "id",
        (F.col("id") % 10 + F.when(F.col("id") % 4 == 0, 20).otherwise(0)).cast("double").alias("x"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("cat"),
        (F.col("id") % 4 == 0).cast("double").alias("label"),
    )
    return df.cache()


def test_split_is_stable_and_whole(labelled):
    train, test = features.train_test(labelled, ["id"], 0.7, seed=5)
    again, _ = features.train_test(labelled.repartition(7), ["id"], 0.7, seed=5)
    assert {r.id for r in train.collect()} == {r.id for r in again.collect()}
    assert train.count() + test.count() == 400 and 240 < train.count() < 320


def test_encoding_hashes_wide_columns(spark):
    stages = features.encoding_stages(["cat"], ["x"], hashed=["cat"])
    assert [type(s).__name__ for s in stages] == ["FeatureHasher", "VectorAssembler"]
    stages = features.encoding_stages(["cat"], ["x"])
    assert [type(s).__name__ for s in stages] == ["StringIndexer", "OneHotEncoder", "VectorAssembler"]


@pytest.mark.parametrize("kind", ["random_forest", "logistic", "naive_bayes", "decision_tree", "linear_svm", "boosting"])
def test_classifiers_beat_the_majority(labelled, kind):
    params = {"random_forest": {"numTrees": 5}, "boosting": {"maxIter": 3}}.get(kind, {})
    inputs = VectorAssembler(inputCols=["x"], outputCol="features") if kind != "naive_bayes" else None
    df = labelled if inputs else labelled.withColumns({"low": (F.col("x") < 15).cast("double"), "high": (F.col("x") >= 15).cast("double")})
    inputs = inputs or VectorAssembler(inputCols=["low", "high"], outputCol="features")
    scored = models.fit(df, [inputs, models.classifier(kind, **params)]).transform(df)
    card = models.score_card(scored).first()
    assert card.rows == 400 and card.accuracy > 0.9 and card.recall > 0.9


def test_threshold(labelled):
    inputs = VectorAssembler(inputCols=["x"], outputCol="features")
    scored = models.fit(labelled, [inputs, models.classifier("logistic")]).transform(labelled)
    out = models.apply_threshold(scored, 0.44)
    assert out.filter("(p_positive >= 0.44) <> (decision = 1)").count() == 0


def test_over_sample(labelled):
    out = features.over_sample(labelled, "label", ["id"], seed=2)
    sizes = dict(rows(out.groupBy("label").count()))
    assert sizes == {0.0: 300, 1.0: 300}
    uneven = labelled.filter("label = 0 or id < 280")  # 300 and 70 rows
    first = features.over_sample(uneven, "label", ["id"]).groupBy("id").count()
    again = features.over_sample(uneven.repartition(7), "label", ["id"]).groupBy("id").count()
    assert rows(first, "id") == rows(again, "id")
    copies = {r["count"] for r in first.filter("id % 4 = 0").collect()}
    assert copies == {4, 5} and first.count() == 370


def test_box_cox_exponent(spark):
    df = spark.range(1, 2001).select(F.exp(F.randn(7)).alias("x"))
    assert abs(features.box_cox_lambda(df, "x")) < 0.1


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    assert rows(features.standard_scale(df, ["a", "b"]), "b") == [(0.0, -1.0), (0.0, 1.0)]
    assert rows(features.min_max_scale(df, ["a", "b"]), "b") == [(0.0, 0.0), (0.0, 1.0)]


def test_tokens(spark):
    df = spark.createDataFrame([("Price (USD): 12.50 the",)], "t string").select(words.tokens("t").alias("tokens"))
    assert df.first().tokens == ["Price", "USD", ":", "__", ".", "__", "the"]
    assert words.stop_words("tokens", "kept").transform(df).first().kept == ["Price", "USD", ":", "__", ".", "__"]
