"""Fits and scores that visit only the values a sparse row has."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, NaiveBayesModel, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lodestock.catalog import models as catalog
from lodestock.ml import models, sparse_trees
from lodestock.ml.sparse_bayes import score_sparse
from lodestock.ml.sparse_trees import fit_sparse
from lodestock.session import cut_wide


@pytest.fixture(scope="module")
def ready(spark):
    """Two numbers, one category in one column each, one hashed to 300 columns."""
    n = F.col("id")
    word = F.when(n % 13 == 0, F.lit("w0")).otherwise(F.concat(F.lit("w"), (n * n % 47).cast("string")))
    df = spark.range(900).select(
        ((n * 7 % 11 + n % 5 + F.when(word == "w4", 9).otherwise(0)) > 7).cast("double").alias("label"),
        (n * 37 % 101 / 10 - 5).alias("x"), F.when(n % 3 > 0, n % 29).otherwise(0).cast("double").alias("y"), (n % 5).cast("double").alias("kind"), word.alias("word"),
    )
    hashed = FeatureHasher(inputCols=["word"], outputCol="hashed", numFeatures=300).transform(df)
    hot = OneHotEncoder(inputCols=["kind"], outputCols=["hot"], dropLast=False).fit(hashed).transform(hashed)
    out = VectorAssembler(inputCols=["x", "y", "hot", "hashed"], outputCol="features").transform(hot)
    return cut_wide(out.select("label", "features").repartition(3))


def parts(model, df):
    found = model.transform(df).select("prediction", "probability").collect()
    return [r["prediction"] for r in found], np.array([r["probability"].toArray() for r in found])


@pytest.mark.parametrize(
    ("kind", "params"),
    [
        ("decision_tree", {"maxDepth": 5}),
        ("decision_tree", {"maxDepth": 3, "maxBins": 8, "minInstancesPerNode": 40, "minInfoGain": 0.01}),
        ("random_forest", {"numTrees": 10, "maxDepth": 5, "seed": 4}),
        ("random_forest", {"numTrees": 3, "maxDepth": 2, "bootstrap": False, "subsamplingRate": 0.5, "featureSubsetStrategy": "0.3"}),
        ("boosting", {"maxIter": 5, "maxDepth": 4}),
    ],
)
def test_trees_of_sparse_rows_are_those_of_mllib(ready, kind, params):
    estimator = models.classifier(kind, **params)
    ours, plain = fit_sparse(estimator, ready), estimator.fit(ready)
    assert type(ours) is type(plain) and ours.numFeatures == plain.numFeatures
    if kind != "boosting":  # its sums of fractions differ in their last digits
        assert ours.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]
    (a, p), (b, q) = parts(ours, ready), parts(plain, ready)
    assert a == b and np.abs(p - q).max() < 1e-9
    assert len(set(a)) == 2


def test_a_row_keeps_the_values_it_has(spark):
    wide = 500_000
    vectors = [(1.0, Vectors.sparse(wide, [3, 499_999], [1.0, 2.0])), (0.0, Vectors.sparse(wide, [], [])), (1.0, Vectors.sparse(wide, [499_999], [0.0]))]
    bins = sparse_trees.Bins(np.full((wide, 1), 0.5), np.ones(wide, int), np.zeros(wide, bool))
    cells = sparse_trees.binned(spark.createDataFrame(vectors, ["label", "features"]), bins, "label", "features").collect()
    assert [np.frombuffer(r["cell"], "<i4").tolist() for r in cells] == [[1, 7, 999_999], [0], [1]]


def test_dense_and_sparse_vectors_give_the_same_parts():
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    column = pa.array([(0, 3, [2], [5.0]), (1, None, None, [0.0, 1.0, 2.0]), (0, 3, [], [])], kind)
    assert [x.tolist() for x in sparse_trees.vector_parts(column)] == [[0, 1, 1, 1], [2, 0, 1, 2], [5.0, 0.0, 1.0, 2.0]]


def test_fits_of_another_kind_are_left_to_mllib(spark):
    rows = [(float(i % 3), float(i % 2), Vectors.dense([float(i % 3), float(i % 2)])) for i in range(30)]
    df = spark.createDataFrame(rows, ["three", "label", "features"])
    assert fit_sparse(models.classifier("decision_tree", labelCol="three"), df).numClasses == 3
    assert fit_sparse(models.classifier("logistic", maxIter=2), df).numClasses == 2
    weighted = fit_sparse(models.classifier("decision_tree", weightCol="label"), df)
    assert weighted.transform(df).agg(F.min("prediction")).first()[0] == 1.0


def test_naive_bayes_scores_the_values_a_row_has(ready, monkeypatch):
    model = models.classifier("naive_bayes", modelType="gaussian").fit(ready)
    plain = model.transform(ready).collect()
    monkeypatch.setattr(NaiveBayesModel, "_transform", lambda *a: pytest.fail("looked up every feature"))
    ours = score_sparse(model, ready)
    assert ours.columns == ["label", "features", "rawPrediction", "probability", "prediction"]
    for a, b in zip(ours.collect(), plain, strict=True):
        assert a["prediction"] == b["prediction"]
        assert np.allclose(a["rawPrediction"].toArray(), b["rawPrediction"].toArray(), rtol=1e-9)
        assert np.allclose(a["probability"].toArray(), b["probability"].toArray(), atol=1e-9)


def test_lateness_trees_are_not_unfolded(spark, tmp_path, monkeypatch):
    columns = "order_id long, line_id int, status string, days_late int, label double, week_due string, carriers string, supplier_text string, " + ", ".join(f"{c} double" for c in catalog.LATE_NUMBERS)
    lines = [
        (i, 1, "COMPLETE", i % 3, float(i % 3 > 0), f"Week {i % 4}", "A" if i % 2 else "N", str(i % 7), *[float((i * (k + 3)) % 11) for k in range(len(catalog.LATE_NUMBERS))])
        for i in range(120)
    ]
    monkeypatch.setattr(catalog, "lateness_lines", lambda spark, sf: spark.createDataFrame(lines, columns))
    for kind in (GBTClassifier, DecisionTreeClassifier, RandomForestClassifier):
        monkeypatch.setattr(kind, "_fit", lambda *a: pytest.fail("kept a number for every feature"))
    found = catalog.lateness_boosting_scores(spark, str(tmp_path)).collect()
    assert [r["model"] for r in found] == ["boosting"] and 0 < found[0]["rows"] < 120
    assert sorted(r["model"] for r in catalog.lateness_classifier_scores(spark, str(tmp_path)).collect()) == ["decision_tree", "linear_svm", "logistic", "naive_bayes", "random_forest"]
