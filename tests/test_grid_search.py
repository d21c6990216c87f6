"""Work that a grid search does once."""

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from lodestock.ml import models
from support import rows


class CountedScaler(MinMaxScaler):
    fits = 0

    def _fit(self, dataset):
        CountedScaler.fits += 1
        return super()._fit(dataset)


def test_grid_search_fits_the_encoders_once_a_fold(spark):
    df = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 > 3).cast("double").alias("label"))
    tree = models.classifier("decision_tree", seed=1)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1, 3]).addGrid(tree.minInstancesPerNode, [1, 500]).build()
    stages = [VectorAssembler(inputCols=["x"], outputCol="raw"), CountedScaler(inputCol="raw", outputCol="features"), tree]
    best = models.grid_search(df, stages, grid, ["id"], folds=2)
    assert CountedScaler.fits == 3 and len(best.avgMetrics) == 4 and best.avgMetrics[0] == 1.0
    assert rows(models.confusion(best.transform(df)), "label") == [(0.0, 0.0, 229), (1.0, 1.0, 171)]
