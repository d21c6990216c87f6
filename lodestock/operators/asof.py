"""As-of join: each row with the last known record of its key before the row's time.

Both sides are put in one order by key and time, cut into blocks of rows by range,
so one key may fill many blocks.  Within a block the last record is a running
value; what a block hands on is one small row, the last record of its last key,
and only keys that go over a block's edge need it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, known_size
from .columns import quoted


def _struct(names: dict[str, str]) -> Column:
    return F.struct(*[F.col(quoted(c)).alias(alias) for alias, c in names.items()])


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
    strict: bool = True,
    prefix: str = "",
    blocks: int | None = None,
) -> DataFrame:
    """``left`` with ``columns`` of the key's last record of ``right`` before the row's time.

    ``strict`` leaves out records of the same time.  Of records of one time the
    last by ``tie``, then by the columns themselves, counts.  ``by`` names the key
    on both sides.  Rows without a match, with a null in the key or without a time
    get nulls.  Every row of ``left`` stays once.
    """
    spark = left.sparkSession
    keys = {f"_k{i}": c for i, c in enumerate(by)}
    found = {f"_v{i}": c for i, c in enumerate(columns)}
    order = {f"_o{i}": c for i, c in enumerate([*tie, *columns])}
    # At the same time: rows of the left come first if they must not see the record.
    rows = left.select(
        *[F.col(quoted(c)).alias(k) for k, c in keys.items()],
        F.col(quoted(left_time)).alias("_time"),
        F.lit(0 if strict else 2).alias("_kind"),
        _struct({f"_c{i}": c for i, c in enumerate(left.columns)}).alias("_row"),
    )
    known = right.select(
        *[F.col(quoted(c)).alias(k) for k, c in keys.items()],
        F.col(quoted(right_time)).alias("_time"),
        F.lit(1).alias("_kind"),
        _struct(order).alias("_order"),
        _struct(found).alias("_known"),
    )
    usable = " AND ".join([*[f"{k} IS NOT NULL" for k in keys], "_time IS NOT NULL"])
    lost = rows.filter(f"NOT ({usable})").withColumn("_known", F.lit(None).cast(known.schema["_known"].dataType))
    both = rows.filter(usable).unionByName(known.filter(usable), allowMissingColumns=True)
    sequence = [*keys, "_time", "_kind", "_order"]
    count = blocks or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = cut_lineage(both.repartitionByRange(count, *sequence).withColumn("_block", F.spark_partition_id()))

    running = Window.partitionBy("_block", *keys).orderBy("_time", "_kind", "_order")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = both.withColumn("_last", F.last("_known", ignorenulls=True).over(running))

    # Blocks that share a key with the one before: the last record each of them hands on.
    per_block = both.groupBy(*keys, "_block").agg(F.max(F.when(F.col("_kind") == 1, F.struct("_time", "_order", "_known"))).alias("_end"))
    spanning = both.groupBy(*keys).agg(F.min("_block").alias("_low"), F.max("_block").alias("_high")).filter("_low < _high")
    spanning = known_size(spanning.select(*keys))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    seeds = per_block.join(spanning, list(keys)).withColumn("_seed", F.last("_end", ignorenulls=True).over(earlier))
    seeds = known_size(seeds.filter("_seed IS NOT NULL").select(*keys, "_block", F.col("_seed._known").alias("_seed")))

    asked = inside.filter("_kind <> 1").join(seeds, [*keys, "_block"], "left")
    asked = asked.select("_row", F.coalesce("_last", "_seed").alias("_known"))
    out = asked.unionByName(lost.select("_row", "_known"))
    return out.select(
        *[F.col(f"_row._c{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"_known.{v}").alias(prefix + c) for v, c in found.items()],
    )


def fill_as_of(
    current: DataFrame, history: DataFrame, by: Sequence[str], value: str, current_time: str, history_time: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Missing values filled from the key's latest record before each row's own time.

    Rows of many report dates are filled in one run, each from what was known then.
    """
    known = history.filter(F.col(quoted(value)).isNotNull())
    joined = as_of_join(current, known, by, current_time, history_time, [value], tie, prefix="_as_of_")
    filled = F.coalesce(F.col(quoted(value)), F.col(quoted(f"_as_of_{value}")))
    return joined.select(*[filled.alias(c) if c == value else F.col(quoted(c)) for c in current.columns])
