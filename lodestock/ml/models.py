"""Estimators, grids, thresholds and scores."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, functions as F

from ..session import cut_wide
from .features import split_share


def classifier(kind: str, seed: int = 0, **params) -> Estimator:
    """Estimator by name, on ``features`` and ``label``."""
    makers = {
        "random_forest": lambda: RandomForestClassifier(seed=seed, **params),
        "logistic": lambda: LogisticRegression(**params),
        "naive_bayes": lambda: NaiveBayes(**params),
        "decision_tree": lambda: DecisionTreeClassifier(seed=seed, **params),
        "linear_svm": lambda: LinearSVC(**params),
        "boosting": lambda: GBTClassifier(seed=seed, **params),
    }
    return makers[kind]()


def fit(train: DataFrame, stages: Sequence[Transformer | Estimator]) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(train)


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def score_card(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision and recall of the positive class, in one pass."""
    hit = (F.col(label) == 1) & (F.col(prediction) == 1)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"),
        F.try_divide(F.count_if(hit), F.count_if(F.col(prediction) == 1)).alias("precision"),
        F.try_divide(F.count_if(hit), F.count_if(F.col(label) == 1)).alias("recall"),
    )


def apply_threshold(scored: DataFrame, threshold: float, name: str = "decision") -> DataFrame:
    """Positive where the probability of class one reaches the threshold."""
    p = vector_to_array("probability")[1]
    return scored.withColumns({"p_positive": p, name: (p >= threshold).cast("int")})


def _ready(df: DataFrame, stages: Sequence[Estimator]) -> DataFrame:
    """``df`` kept with what the stages read; of several stages that is not known, so all of it.

    Trees take their split points from a sample by partition, which a cache leaves in place.
    """
    if len(stages) == 1:
        params = [p for p in ("featuresCol", "labelCol", "weightCol") if stages[0].hasParam(p) and stages[0].isDefined(p)]
        df = df.select(*dict.fromkeys(c for c in map(stages[0].getOrDefault, params) if c))
    return df.persist()


def fit_encoded(train: DataFrame, stages: Sequence[Transformer | Estimator]) -> PipelineModel:
    """``fit`` that encodes the rows once: the last stage reads them many times."""
    encoder = fit(train, stages[:-1])
    ready = _ready(encoder.transform(train), stages[-1:])
    model = PipelineModel([*encoder.stages, stages[-1].fit(ready)])
    ready.unpersist()
    return model


def grid_search(
    train: DataFrame, stages: Sequence[Transformer | Estimator], grid: list[dict], keys: Sequence[str], folds: int = 3,
    metric: str = "f1", parallelism: int = 4,
) -> CrossValidatorModel:
    """k-fold search with folds fixed by the row key.

    The leading stages that ``grid`` leaves alone are fitted once per fold and
    once on all rows, as their result is the same for every setting; what they
    make is cached, so the fits of a fold read it instead of making it again.
    """
    fold = F.least(F.floor(split_share(keys, 17) * folds), F.lit(folds - 1)).cast("int")
    rows = train.withColumn("_fold", fold)
    varied = {p.parent for params in grid for p in params}
    lead = next((i for i, s in enumerate(stages) if s.uid in varied or i == len(stages) - 1), 0)
    fixed, searched = list(stages[:lead]), Pipeline(stages=list(stages[lead:]))
    evaluator = MulticlassClassificationEvaluator(metricName=metric)
    run_on = inheritable_thread_target(train.sparkSession)

    def made(part: DataFrame) -> tuple[PipelineModel, DataFrame]:
        encoder = fit(part, fixed)
        return encoder, _ready(encoder.transform(part), stages[lead:])

    @run_on
    def score(ready: DataFrame, held_out: DataFrame, params: dict) -> float:
        return evaluator.evaluate(searched.fit(ready, params).transform(held_out))

    scores: list[list[float]] = []
    with ThreadPoolExecutor(parallelism) as pool:
        for k in range(folds):
            learnt, kept_out = rows.filter(F.col("_fold") != k), rows.filter(F.col("_fold") == k)
            for name, part in (("training", learnt), ("validation", kept_out)):
                if part.isEmpty():
                    raise ValueError(f"The {name} data at fold {k} is empty.")
            encoder, ready = made(learnt)
            held_out = _ready(encoder.transform(kept_out), stages[lead:])
            scores.append(list(pool.map(score, [ready] * len(grid), [held_out] * len(grid), grid)))
            ready.unpersist()
            held_out.unpersist()
    means = [float(np.mean(of)) for of in zip(*scores, strict=True)]
    best = int((np.argmax if evaluator.isLargerBetter() else np.argmin)(means))
    encoder, ready = made(rows)
    model = PipelineModel([*encoder.stages, *searched.fit(ready, grid[best]).stages])
    ready.unpersist()
    return CrossValidatorModel(model, means, [], [float(np.std(of)) for of in zip(*scores, strict=True)])


def clustered_groups(df: DataFrame, key: str, value: str, values: Sequence[str], share: float = 0.75, seed: int = 1) -> DataFrame:
    """K-means of groups by how often each of ``values`` occurs in them.

    ``counts`` has the occurrences in the order of ``values``; the number of
    clusters is a share of the number of groups, two at least.  ``apart`` has the
    squared distance to each centre.
    """
    each = [F.count_if(F.col(value) == v) for v in values]
    groups = cut_wide(df.groupBy(key).agg(F.array(*each).alias("counts")))
    ready = groups.withColumn("features", array_to_vector(F.transform("counts", lambda n: n.cast("double"))))
    model = KMeans(k=max(2, round(groups.count() * share)), seed=seed, maxIter=20).fit(ready)
    apart = [
        sum((F.get("counts", F.lit(i)) - float(x)) * (F.get("counts", F.lit(i)) - float(x)) for i, x in enumerate(centre))
        for centre in model.clusterCenters()
    ]
    return model.transform(ready).select(key, "counts", F.col("prediction").alias("cluster"), F.array(*apart).alias("apart"))
