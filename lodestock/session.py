"""Session settings, the shared working folder, and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs.  Sizing settings (executor memory, shuffle
# partitions) belong to the cluster; adaptive execution coalesces from there.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_LOCAL_FOLDERS: dict[str, str] = {}
# Files behind frames of ``cut_lineage``, by the frame's identity.
_FILES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def build_session(app_name: str = "lodestock", master: str | None = None, **extra: str) -> SparkSession:
    """Create or reuse a session carrying ``SESSION_SETTINGS``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder stands in for it only where driver and executors are
    one process; on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[0-9*, ]+\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _LOCAL_FOLDERS.setdefault(context.applicationId, tempfile.mkdtemp(prefix="lodestock-"))


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/lodestock-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder.

    For the end of a job: frames that read those files stop working.
    """
    delete_folder(spark, scratch_root(spark))


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder and its files, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(*frames: DataFrame) -> None:
    """Remove the files of ``cut_lineage`` frames that no later step reads."""
    for frame in frames:
        folder = _FILES.pop(frame, None)
        if folder:
            delete_folder(frame.sparkSession, folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the files.

    The files outlive lost executors, so loops can restart from them.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FILES[out] = path
    return out


def known_size(df: DataFrame) -> DataFrame:
    """Write the small side of a join first, so it is joined by its real size.

    Of an aggregate the planner knows no size: it would shuffle the large side
    before adaptive execution finds the other one small.  Read back from files
    the side has a measured size, and is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return cut_lineage(df)


def cut_wide(df: DataFrame) -> DataFrame:
    """``cut_lineage`` with at least one partition per core, for heavy readers.

    A small result comes back in fewer partitions than there are cores and is
    written once more, spread out; a large one is left as it is.
    """
    out = cut_lineage(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    # ``out`` is a plain file scan: its partitions are known without running it.
    return out if out.rdd.getNumPartitions() >= cores else cut_lineage(out.repartition(cores))
