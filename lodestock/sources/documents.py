"""Folders of text, one row per document."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

FOLDER_FILES = 1024
SPREAD, TASK_FOLDERS, BATCH_BYTES = 4, 16, 8 << 20
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")  # unpacked by Spark
STRANGE = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The folder as tasks see it, if it needs no other file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = urlsplit(target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString())
    return unquote(whole.path) if whole.scheme == "file" else None


def _is_text(entry: os.DirEntry, suffix: str) -> bool:
    return entry.name.endswith(suffix) and not entry.name.startswith((".", "_")) and entry.is_file()


def _one_of_each_folder(top: str, suffix: str) -> list[str]:
    """A file of every folder that has some; none where only Spark's rules tell which folders count."""
    found, waiting = [], [top]
    while waiting:
        first, filled, inner = None, False, []
        with os.scandir(waiting.pop()) as entries:
            for entry in entries:
                if entry.is_dir() and not entry.name.startswith("."):
                    inner.append(entry)
                elif not filled and _is_text(entry, suffix):
                    first, filled = entry.path, entry.stat().st_size > 0
        if inner and first or any("=" not in e.name for e in inner if not e.name.startswith("_")) or any("=" in e.name for e in inner if e.name.startswith("_")):
            return []
        waiting += [e.path for e in inner if not e.name.startswith("_")]
        found += [first] if first else []
    return found


def _read_by_tasks(spark: SparkSession, path: str, top: str, suffix: str) -> DataFrame | None:
    """Name, bytes and folder columns of all files; each task lists folders, or slices of them, and reads their files."""
    found = _one_of_each_folder(top, suffix)
    if not found:
        return None
    some = spark.read.option("basePath", path).text([f"{path}{f[len(top):]}" for f in found], wholetext=True)
    folders = [f for f in some.schema.fields if f.name != "value"]
    names = [f.name for f in folders]
    cores = spark.sparkContext.defaultParallelism
    slices = -(-cores * SPREAD // len(found))
    places = some.select(F.col("_metadata.file_path").alias("_place"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"), *names)
    places = places.repartition(max(cores * SPREAD, len(found) // TASK_FOLDERS))
    schema = StructType([StructField("_name", StringType()), StructField("_bytes", BinaryType()), *folders])

    def files(place: str, part: int) -> Iterator[tuple[str, bytes]]:
        folder = os.path.dirname(unquote(urlsplit(place).path))
        with os.scandir(folder) as entries:
            for entry in entries:
                if zlib.crc32(os.fsencode(entry.name)) % slices == part and _is_text(entry, suffix):
                    with open(entry.path, "rb") as file:
                        data = file.read()
                    if data:  # Spark passes over empty files; the name is as in ``_metadata.file_path``
                        yield STRANGE.sub(lambda m: f"%{ord(m[0]):02X}", entry.name), data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cells(batch: pa.RecordBatch, i: int, held: list[tuple[str, bytes]]) -> pa.RecordBatch:
            own = [pa.array([x[0] for x in held], pa.string()), pa.array([x[1] for x in held], pa.binary())]
            return pa.RecordBatch.from_arrays([*own, *(pa.array(batch.column(c)[i : i + 1].to_pylist() * len(held), batch.column(c).type) for c in names)], schema.names)

        for batch in batches:
            for i in range(len(batch)):
                held, size = [], 0
                for name, data in files(batch.column("_place")[i].as_py(), batch.column("_slice")[i].as_py()):
                    held.append((name, data))
                    size += len(data)
                    if size >= BATCH_BYTES:
                        yield cells(batch, i, held)
                        held, size = [], 0
                yield cells(batch, i, held)

    return places.mapInArrow(run, schema)


def read_documents(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """File name without suffix, whole text, and any folder columns.

    Opening a file by Hadoop costs many times its reading, so tasks read the files
    of a mounted folder themselves, and the driver holds one name per folder.
    """
    plain = not set("*?[]{}\\") & set(path + suffix) and not suffix.endswith(PACKED)
    top = _mounted(spark, path) if plain else None
    read = _read_by_tasks(spark, path.rstrip("/"), top.rstrip("/"), suffix) if top and os.path.isdir(top) else None
    if read is not None:
        name, text, own = F.col("_name"), F.col("_bytes").cast("string"), ["_name", "_bytes"]
    else:
        read = spark.read.option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
        name, text, own = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.col("value"), ["value"]
    doc = F.regexp_replace(name, suffix.replace(".", r"\.") + "$", "")
    return read.select(doc.alias("doc"), text.alias("text"), *[c for c in read.columns if c not in own])


def write_documents(df: DataFrame, column: str, path: str) -> None:
    """A file per text of ``df``, its value and a line end, in folders of up to ``FOLDER_FILES``.

    In a shared folder that is mounted, tasks write the files themselves: without its
    native library Hadoop starts a process for the rights of every file.  A file gets its
    name when it is whole, and the same one from every attempt of its task.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    texts = df.select(F.col(column).alias("text"))
    if texts.rdd.getNumPartitions() < cores:
        texts = texts.repartition(cores)
    top = _mounted(spark, path)
    if top is None:
        folder = F.floor(F.monotonically_increasing_id() / FOLDER_FILES)
        texts.withColumn("folder", folder).write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
        return
    os.makedirs(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        for batch in batches:
            for text in batch.column(0):
                place = f"{task.partitionId():05}-{n:010}"
                folder = f"{top}/folder={(task.partitionId() << 23) + n // FOLDER_FILES}"
                if n % FOLDER_FILES == 0:
                    os.makedirs(folder, exist_ok=True)
                open_name = f"{folder}/.{place}-{task.taskAttemptId()}"
                with open(open_name, "wb") as out:
                    out.write((text.as_py() or "").encode() + b"\n")
                os.replace(open_name, f"{folder}/part-{place}.txt")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    texts.mapInArrow(run, "files long").agg(F.sum("files")).collect()
