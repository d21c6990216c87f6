"""Scheduled file pickup as a stream that runs until nothing is left."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.load import replace_slice


def pick_up_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    load: Callable[[DataFrame, int], None],
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    path_glob: str | None = None,
) -> int:
    """Load every file not seen before; returns the number of batches.

    The checkpoint remembers the files, so a rerun after a lost job loads each
    file's batch again under the same number and ``load`` must be idempotent.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if path_glob is not None:
        reader = reader.option("pathGlobFilter", path_glob)
    batches = 0

    def counted(batch: DataFrame, batch_id: int) -> None:
        nonlocal batches
        load(batch, batch_id)
        batches += 1

    query = (
        reader.load(folder)
        .writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return batches


def replace_slices(path: str, slice_columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch loader for slices that a later batch may add to.

    A batch's rows of a slice are a partition ``load_batch`` of it, so a batch
    that is repeated replaces its own rows only, and a late file for a slice
    leaves the rows that came before.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        replace_slice(batch.withColumn("load_batch", F.lit(batch_id)), path, [*slice_columns, "load_batch"])

    return load
