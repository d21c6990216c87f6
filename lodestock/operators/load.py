"""Load modes: full refresh, append, replace slice, staged swap, updates."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import cut_lineage, delete_folder
from .audit import append_audit, error_row, success_row
from .columns import quoted
from .contract import ContractError, assert_fits, conform
from .picks import first_per_key


def write_version(df: DataFrame, path: str) -> None:
    """Replace a table: the new rows are written beside it and renamed into place.

    Until the rename the old table stays whole, so a failed write loses nothing,
    and ``df`` may read the table that it replaces.  Between the two renames a
    reader finds no table.
    """
    spark = df.sparkSession
    base, tag = path.rstrip("/"), uuid.uuid4().hex
    made = spark._jvm.org.apache.hadoop.fs.Path
    new, now, old = made(f"{base}.new-{tag}"), made(base), made(f"{base}.old-{tag}")
    df.write.parquet(new.toString())
    files = now.getFileSystem(spark._jsc.hadoopConfiguration())
    replaces = files.exists(now)
    if replaces and not files.rename(now, old):
        raise OSError(f"{base} could not be set aside")
    if not files.rename(new, now):
        if replaces:
            files.rename(old, now)
        raise OSError(f"the new version of {base} could not be put in place")
    if replaces:
        files.delete(old, True)
    spark.catalog.refreshByPath(base)


def full_refresh(df: DataFrame, path: str) -> None:
    write_version(df, path)


def append_snapshot(df: DataFrame, path: str, load_id: str | None = None) -> None:
    """Add rows to a table.

    With a ``load_id`` the rows are a slice of their own, named by it in a column
    ``load_id``: a load that is run again replaces what its first run had written
    and adds nothing twice.  Without one a repeated call repeats the rows.
    """
    if load_id is None:
        df.write.mode("append").parquet(path)
        return
    _folder_text(load_id)
    replace_slice(df.withColumn("load_id", F.lit(load_id)), path, ["load_id"], cleared=[[load_id]])


def replace_slice(
    df: DataFrame, path: str, slice_columns: Sequence[str], cleared: Sequence[Sequence[object]] = ()
) -> None:
    """Replace the slices present in ``df`` and keep all others.

    ``cleared`` names slices by their values, in the order of ``slice_columns``:
    those are emptied first, so one that ``df`` has no rows of does not keep its
    old rows.

    The table is partitioned by the slice, so only the touched partitions are
    rewritten, and writing the same slice twice leaves the same table.  Rows
    are spread by slice and a row hash, so one slice holding most of the rows
    is written by many tasks.
    """
    for values in cleared:
        pairs = zip(slice_columns, values, strict=True)
        delete_folder(df.sparkSession, "/".join([path.rstrip("/"), *[f"{c}={_folder_text(v)}" for c, v in pairs]]))
    spread = df.repartition(*[F.col(c) for c in slice_columns], F.pmod(F.xxhash64(*df.columns), F.lit(32)))
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*slice_columns)
        .parquet(path)
    )


def _folder_text(value: object) -> str:
    """A slice's value as a partition folder names it."""
    text = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
    if not re.fullmatch(r"[\w.+-]+", text, re.ASCII):
        raise ValueError(f"a slice to clear must be plain text, number or date: {text!r}")
    return text


def without_slice(base: DataFrame, condition: Column) -> DataFrame:
    """Rows that a delete on ``condition`` would leave; an unknown outcome stays."""
    return base.filter(~F.coalesce(condition, F.lit(False)))


def staged_swap(df: DataFrame, stage: str, base: str, schema: T.StructType | None = None) -> int:
    """Write to a stage, check what arrived, then replace the base from it.

    The base changes only after the stage is whole, so a failure before that
    leaves the old base readable.  Returns the number of rows staged.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    if schema is not None:
        assert_fits(staged, schema)
    rows = staged.count()
    write_version(staged, base)
    return rows


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Read everything and replace the target."""
    write_version(spark.read.parquet(source), target)


def load_table(
    df: DataFrame,
    path: str,
    target: T.StructType,
    audit_path: str,
    scope: str,
    log_source: str,
    data_area: str,
    columns: Sequence[str] | None = None,
    categorical: Sequence[str] = (),
    truncate: bool = True,
    entry_date=None,
    load_id: str | None = None,
) -> bool:
    """Conform, check, write and audit.  An appended load with a ``load_id`` may be run again.

    A contract error is audited, not raised; any other failure is audited and
    raised.
    """
    spark = df.sparkSession
    try:
        # Staged once: the checks, the count and the load all read the stage.
        ready = cut_lineage(conform(df, target, columns, categorical))
        assert_fits(ready, target)
        if truncate:
            write_version(ready, path)
        else:
            append_snapshot(ready, path, load_id)
    except Exception as error:
        append_audit(error_row(spark, scope, log_source, data_area, error, entry_date), audit_path)
        if isinstance(error, ContractError):
            return False
        raise
    append_audit(success_row(spark, scope, log_source, data_area, ready.count(), entry_date), audit_path)
    return True


def fill_from_earlier(
    current: DataFrame, history: DataFrame, key: str, value: str, order: str
) -> DataFrame:
    """Fill missing values from the key's latest earlier record.

    The history shrinks to one row per key before the join.
    """
    known = history.filter(F.col(value).isNotNull()).select(key, value, order)
    latest = first_per_key(known, [key], [F.desc(order), F.asc(value)]).select(
        F.col(key).alias("_key"), F.col(value).alias("_known")
    )
    joined = current.join(latest, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(value, F.coalesce(value, "_known")).select([quoted(c) for c in current.columns])


def fill_nulls(df: DataFrame, column: str, value: object, condition: Column | None = None) -> DataFrame:
    """Conditional update: a constant for nulls on the chosen rows."""
    c = F.col(quoted(column))
    where = c.isNull() if condition is None else c.isNull() & condition
    return df.withColumn(column, F.when(where, F.lit(value)).otherwise(c))


def keep_earliest(df: DataFrame, keys: Sequence[str], logged: str) -> DataFrame:
    """Duplicates of a key keep only the earliest log time; ties all stay.

    Rows without a log time stay, since no comparison removes them.
    """
    first = df.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(F.min(logged).alias("_first"))
    same = None
    for i, k in enumerate(keys):
        term = F.col(k) == F.col(f"_key_{i}")
        same = term if same is None else same & term
    later = F.coalesce(F.col(logged) > F.col("_first"), F.lit(False))
    return df.join(first, same, "left").filter(~later).select([quoted(c) for c in df.columns])
