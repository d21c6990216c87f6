"""Whitening of embeddings with distributed block matrices.

Entries become integers, so sums and deviations are exact.  The centred rows are
numbered without gaps and cut into blocks of a ``BlockMatrix``; its transpose
times itself is the scatter, whose eigenvectors are found on the driver (it is as
large as the dimension squared), and the block matrix times the whitening matrix
projects the rows.

The product of the transpose and the blocks has one block for a small dimension;
its middle dimension is split, so every task multiplies and adds its own blocks
and only sums of that size meet.  Blocks hold ``BLOCK_ROWS`` rows, more only when
there would be over ``MOST_BLOCKS`` of them: the product lists their places on the
driver.  The rows are written once before they are numbered; all products
start from the blocks' shuffle, which is rebuilt from that table.

Defined results: rows drop whose vector is null, empty, or has null or
non-finite entries, or another length than most vectors (ties: the longer);
repeated rows and null ids stay; integers end at the ends of a long; components with an eigenvalue that rounding
cannot tell from zero are left out, so one row or equal rows give none; a
deviation beyond a long is null; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_wide

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_ROWS, BLOCK_COLUMNS, MOST_BLOCKS = 2048, 1024, 50_000
MOST = (1 << 63) - 1
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _finite(vector: Column) -> Column:
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(good(c), F.lit(False)))


def integer_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id``, integer vector ``x`` and row number ``row`` from zero without gaps."""
    own = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
    own = own.filter(_finite(F.col("_v")))
    sizes = own.groupBy(F.size("_v").alias("_d")).count().orderBy(F.desc("count"), F.desc("_d")).limit(1).collect()
    own = own.filter(F.size("_v") == (sizes[0]["_d"] if sizes else 0))
    whole = lambda c: F.least(F.floor(c * scale), F.lit(MOST - shift)) + shift
    # The number of the writing task and the place in it.
    rows = cut_wide(own.select("vec_id", F.transform("_v", whole).alias("x"), F.monotonically_increasing_id().alias("_id")))
    part = F.shiftright("_id", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    starts = counts.select("_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select("vec_id", "x", (F.col("_before") + F.col("_id") - F.col("_first")).alias("row"))


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension."""
    exploded = rows.select(F.posexplode("x").alias("at", "value"))
    sums = exploded.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(20,0)")).alias("s"))
    found = sums.orderBy("at").collect()  # one row per dimension
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [])


def _numbers(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def centred_blocks(rows: DataFrame, n: int, sums: list[int]) -> BlockMatrix:
    """The rows less their mean, as blocks.

    The whole part of the mean is taken off as an integer, the rest in floating point.
    """
    whole, rest = [s // n for s in sums], [(s % n) / n for s in sums]
    exact = lambda x, m: F.try_subtract(x, m).cast("double")
    off = F.zip_with("x", _numbers(whole, "bigint"), lambda x, m: F.coalesce(exact(x, m), x.cast("double") - m.cast("double")))
    centred = F.zip_with(off, _numbers(rest, "double"), lambda x, m: x - m)
    frame = MLUtils.convertVectorColumnsFromML(rows.select(F.col("row").alias("index"), array_to_vector(centred).alias("vector")), "vector")
    height = max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    return IndexedRowMatrix(frame, n, len(sums)).toBlockMatrix(height, min(len(sums), BLOCK_COLUMNS))


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The transpose times the blocks, as a local matrix of the dimension squared."""
    splits = max(1, -(-blocks.numRows() // blocks.rowsPerBlock))
    turned = blocks.transpose()._java_matrix_wrapper
    product = turned.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


@dataclass(frozen=True)
class Whitening:
    values: np.ndarray  # eigenvalues of the kept components, falling
    matrix: np.ndarray  # dimension x components
    trace: float

    @classmethod
    def of(cls, covariance: np.ndarray, components: int) -> Whitening:
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        floor = len(values) * np.finfo(float).eps * max(values[0], 0.0)
        kept = min(components, int((values > floor).sum()))
        return cls(values[:kept], vectors[:, :kept] / np.sqrt(values[:kept]), float(np.trace(covariance)))


def project(blocks: BlockMatrix, matrix: np.ndarray) -> BlockMatrix:
    """The blocks times a small local matrix."""
    height = blocks.colsPerBlock
    parts = [
        ((i // height, 0), Matrices.dense(part.shape[0], part.shape[1], part.ravel(order="F").tolist()))
        for i in range(0, len(matrix), height)
        for part in [matrix[i : i + height]]
    ]
    context = blocks.blocks.context
    return blocks.multiply(BlockMatrix(context.parallelize(parts, len(parts)), height, matrix.shape[1], *matrix.shape))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per vector and component.

    ``whitened`` is the centred vector along the component over the root of its
    eigenvalue, ``explained`` the eigenvalue's share; ``deviation`` sums the
    squares of ``n x - S`` over the dimensions; ``identity_error`` is the largest
    entry of the whitened covariance less the identity.
    """
    spark = vectors.sparkSession
    rows = integer_rows(vectors, key, vector, scale, shift)
    n, sums = _sums(rows)
    if not n:
        return spark.createDataFrame([], RESULT)
    blocks = centred_blocks(rows, n, sums)
    fitted = Whitening.of(scatter(blocks) / n, components)
    kept = len(fitted.values)
    if not kept:
        return spark.createDataFrame([], RESULT)
    projected = project(blocks, fitted.matrix)
    error = float(np.abs(scatter(projected) / n - np.eye(kept)).max())
    found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = found.select(F.col("index").alias("row"), vector_to_array("vector").alias("_z"))

    gap = F.zip_with("x", F.transform(_numbers([str(s) for s in sums], "string"), lambda s: s.try_cast("long")), lambda x, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x), s))
    squares = F.aggregate(gap, F.lit(0).cast("long"), lambda total, g: F.try_add(total, F.try_multiply(g, g)))
    facts = rows.select("row", "vec_id", squares.alias("deviation")).join(found, "row")
    shares = _numbers([float(v / fitted.trace) for v in fitted.values], "double")
    long = facts.select("vec_id", "deviation", F.posexplode("_z").alias("_at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
