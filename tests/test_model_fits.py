"""Rows that a fit encodes once."""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from lodestock.catalog import models as catalog
from lodestock.ml import models


def test_a_fit_encodes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(float(i % 2), float(i % 7), None if i % 5 == 0 else float(i)) for i in range(60)]
    train = spark.createDataFrame(rows, "label double, x double, y double").repartition(3).mapInArrow(count, "label double, x double, y double")
    stages = [VectorAssembler(inputCols=["x", "y"], outputCol="features", handleInvalid="skip"), models.classifier("logistic", maxIter=5)]
    cached = set(spark.sparkContext._jsc.getPersistentRDDs())
    once = models.fit_encoded(train, stages)
    assert seen.value == 60
    plain = models.fit(train, stages)
    assert seen.value > 2 * 60
    assert once.stages[-1].coefficients == plain.stages[-1].coefficients and once.stages[-1].intercept == plain.stages[-1].intercept
    assert len(once.stages) == 2 and set(spark.sparkContext._jsc.getPersistentRDDs()) <= cached


def test_open_lines_are_scored_by_rows_encoded_once(spark, tmp_path, monkeypatch):
    columns = "order_id long, line_id int, status string, days_late int, label double, carriers string, " + ", ".join(f"{c} double" for c in catalog.LATE_NUMBERS)
    numbers = [[float((i * (k + 3)) % 11) for k in range(len(catalog.LATE_NUMBERS))] for i in range(40)]
    lines = [(i, 1, *(("COMPLETE", i % 3, float(i % 3 > 0)) if i < 30 else ("OPEN", None, None)), "A" if i % 2 else "N", *numbers[i]) for i in range(40)]
    cached = []
    fit = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: cached.append(df.storageLevel.useMemory) or fit(self, df))
    monkeypatch.setattr(catalog, "lateness_lines", lambda spark, sf: spark.createDataFrame(lines, columns))
    assert sorted(r["order_id"] for r in catalog.open_lines_scored(spark, str(tmp_path)).collect()) == list(range(30, 40))
    assert cached == [True]
