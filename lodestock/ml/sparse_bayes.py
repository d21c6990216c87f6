"""Scores of Gaussian naive Bayes for wide rows that are mostly zero."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from .sparse_trees import vector_parts


def score_sparse(model, df: DataFrame) -> DataFrame:
    """``model.transform(df)``; Gaussian naive Bayes visits only the values a sparse row has.

    MLlib looks up every feature of every class in a row.  Here a class starts from
    its distance to a row of zeros, and each value of the row corrects it.
    """
    if not isinstance(model, NaiveBayesModel) or model.getModelType() != "gaussian" or model.isDefined("thresholds"):
        return model.transform(df)
    prior, mean, variance = model.pi.toArray(), model.theta.toArray(), model.sigma.toArray()
    if not (variance > 0).all():
        return model.transform(df)
    start = prior - ((mean * mean / variance).sum(axis=1) + np.log(variance).sum(axis=1)) / 2

    def run(vectors: pa.Array) -> pa.Array:
        n = len(vectors)
        row, place, value = vector_parts(vectors)
        scores = np.stack([s - np.bincount(row, value * (value - 2 * m[place]) / v[place], n) / 2 for s, m, v in zip(start, mean, variance, strict=True)], axis=1)
        first = np.arange(n + 1, dtype=np.int32) * scores.shape[1]
        raw = pa.ListArray.from_arrays(pa.array(first), pa.array(scores.ravel()))
        return pa.StructArray.from_arrays([raw, pa.array(scores.argmax(axis=1).astype(float))], ["raw", "prediction"])

    found = F.arrow_udf(run, "struct<raw:array<double>,prediction:double>")(F.unwrap_udt(model.getFeaturesCol()))
    shares = F.transform(F.col("_bayes.raw"), lambda x: F.exp(x - F.array_max("_bayes.raw")))
    whole = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("_bayes", found).select(
        *[F.col(f"`{c}`") for c in df.columns],
        array_to_vector("_bayes.raw").alias(model.getRawPredictionCol()),
        array_to_vector(F.transform(shares, lambda x: x / whole)).alias(model.getProbabilityCol()),
        F.col("_bayes.prediction").alias(model.getPredictionCol()),
    )
