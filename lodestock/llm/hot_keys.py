"""Joins of many rows to one row per key, where a key may have a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_SHARE, SALTS = 4096, 64


def join_heads(
    rows: DataFrame, heads: DataFrame, on: list[str], weight: str, spread: list[str], hint: str | None = None
) -> DataFrame:
    """``rows`` joined to ``heads`` by ``on``; ``heads`` has one row per key, and its rows as ``weight``.

    Keys with more than a 4096th of all rows are at most 4096, so the list of them
    is broadcast; their rows are dealt to ``SALTS`` tasks by the columns ``spread``,
    and their heads go to all of those.  ``heads`` should be read from files.
    """
    total = heads.agg(F.sum(weight)).first()[0] or 0
    hot = F.broadcast(heads.filter(F.col(weight) * HOT_SHARE > total).select(*on, F.lit(True).alias("_hot")))
    dealt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(hot, on, "left").withColumn("_salt", dealt).drop("_hot")
    right = heads.join(hot, on, "left").withColumn("_salt", F.explode(parts)).drop("_hot")
    return left.join(right.hint(hint) if hint else right, [*on, "_salt"]).drop("_salt")
