"""Splits, scaling, encoding, bins and transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import FeatureHasher, Imputer, MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import box_cox
from ..operators.columns import quoted
from ..session import cut_wide, known_size


def split_share(keys: Sequence[str], seed: int = 0) -> Column:
    """A number in [0, 1) fixed by the row's key, the same in every run and task."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def train_test(df: DataFrame, keys: Sequence[str], train: float = 0.7, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split by key hash: a recomputed partition lands on the same side."""
    share = split_share(keys, seed)
    return df.filter(share < train), df.filter(share >= train)


def _divisor(c: Column) -> Column:
    return F.when(c == 0, 1.0).otherwise(c)


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minus mean over population deviation, from one pass; a constant column becomes zero."""
    stats = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("x")
    ).scalar()
    return df.withColumns({c: (F.col(c) - stats[c]["m"]) / _divisor(stats[c]["s"]) for c in columns})


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To the range 0 to 1, from one pass; a constant column becomes zero."""
    stats = df.agg(
        F.struct(*[F.struct(F.min(c).alias("a"), F.max(c).alias("b")).alias(c) for c in columns]).alias("x")
    ).scalar()
    return df.withColumns({c: (F.col(c) - stats[c]["a"]) / _divisor(stats[c]["b"] - stats[c]["a"]) for c in columns})


def encoding_stages(
    categories: Sequence[str], numbers: Sequence[str], hashed: Sequence[str] = (), hashed_features: int = 1 << 12,
    scale: str | None = None,
) -> list[Transformer]:
    """Pipeline stages from columns to ``features``.

    An indexer keeps its labels on the driver, so the caller names the columns
    whose labels grow with the data as ``hashed``: those need no labels at all.
    The choice does not depend on the rows.  Unknown labels are ignored.
    With ``scale`` ("standard" or "min_max") numbers get the median where they
    are missing and are scaled; both are fitted with the pipeline, so they know
    the training rows alone.
    """
    narrow = [c for c in categories if c not in hashed]
    wide = [c for c in categories if c in hashed]
    stages: list[Transformer] = []
    inputs = list(numbers)
    if scale:
        filled = [f"{c}_filled" for c in numbers]
        scaler = {"standard": StandardScaler(withMean=True), "min_max": MinMaxScaler()}[scale]
        stages.append(Imputer(inputCols=list(numbers), outputCols=filled, strategy="median"))
        stages.append(VectorAssembler(inputCols=filled, outputCol="numbers_raw", handleInvalid="keep"))
        stages.append(scaler.setInputCol("numbers_raw").setOutputCol("numbers"))
        inputs = ["numbers"]
    if narrow:
        indexed, encoded = [f"{c}_index" for c in narrow], [f"{c}_hot" for c in narrow]
        stages.append(StringIndexer(inputCols=narrow, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True))
        inputs += encoded
    if wide:
        stages.append(FeatureHasher(inputCols=wide, outputCol="hashed", categoricalCols=wide, numFeatures=hashed_features))
        inputs.append("hashed")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def fixed_bins(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin ``(edge, next edge]``; null outside all bins."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.when(c <= edges[0], None)
    for edge, label in zip(edges[1:], labels, strict=True):
        out = out.when(c <= edge, label)
    return out


def log_one_plus(c: Column | str) -> Column:
    return F.log1p(c)


def box_cox_likelihood(column: str, lam: float) -> Column:
    """Aggregate: log-likelihood of the exponent for a positive column."""
    x = F.col(quoted(column)).cast("double")
    return (F.lit(float(lam)) - 1) * F.sum(F.log(x)) - F.count(x) / 2 * F.log(F.var_pop(box_cox(x, lam)))


def box_cox_lambda(df: DataFrame, column: str, low: float = -2.0, high: float = 2.0, rounds: int = 5, steps: int = 10) -> float:
    """Exponent with the largest Box-Cox likelihood over the positive values.

    Each round scores a grid of exponents in one aggregate and narrows to the
    neighbours of the best one; the grid moves on when the best is at an edge.
    """
    x = F.col(quoted(column)).cast("double")
    values = cut_wide(df.select(x.alias("x")).filter("x > 0"))
    for _ in range(rounds):
        grid = [low + (high - low) * i / steps for i in range(steps + 1)]
        scores = [box_cox_likelihood("x", lam).alias(str(i)) for i, lam in enumerate(grid)]
        found = values.agg(*scores).first()
        best = max(range(len(grid)), key=lambda i: float("-inf") if found[i] is None else found[i])
        step = (high - low) / steps
        half = step if 0 < best < steps else (high - low) / 2
        low, high = grid[best] - half, grid[best] + half
    return (low + high) / 2


def over_sample(df: DataFrame, label: str, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Repeat rows of the smaller classes up to about the size of the largest.

    Each row stands ``largest // size`` times, and once more if its key's share
    lies below the fraction that is left, so a recomputed task repeats the same
    rows.  Class sizes are an aggregate that is joined back; null is a class.
    """
    sizes = df.groupBy(F.col(quoted(label)).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = known_size(sizes)
    largest = sizes.agg(F.max("_n")).scalar()
    more = split_share(keys, seed) * F.col("_n") < F.col("_largest") % F.col("_n")
    copies = F.floor(F.col("_largest") / F.col("_n")) + more.cast("int")
    joined = df.join(sizes.withColumn("_largest", largest), F.col(quoted(label)).eqNullSafe(F.col("_class")))
    return joined.select(
        *[F.col(quoted(c)) for c in df.columns], F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy")
    ).drop("_copy")
