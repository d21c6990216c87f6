"""Groups of names that are nearly the same.

Two names are similar when ``100 * (1 - levenshtein / longer length)`` reaches
the threshold.  Similar names are found by shared keys in equi-joins, never by
comparing all pairs, and no similar pair is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, release
from .name_search import Groups, bucket_links

WILDCARD = "\x00"
STAR_BUDGET = 2
FORM_BATCH = 64
CELL_NAMES = 20_000


def edit_budget(length: int, threshold: int) -> int:
    """Edits allowed when the longer name has this length."""
    return length * (100 - threshold) // 100


def _budgets(length: int, threshold: int) -> list[int]:
    """Edit budgets of the pairs a name of this length can be part of."""
    out, longest = [], length
    while longest - length <= edit_budget(longest, threshold):
        out.append(edit_budget(longest, threshold))
        longest += 1
    return sorted({b for b in out if b > 0})


def edited_forms(name: str, budget: int) -> Iterator[tuple[str, int, int]]:
    """Forms with ``wild`` characters masked and ``cut`` ones removed.

    Names within ``wild + cut + cut'`` edits of each other share a form.
    """
    spots = range(len(name))
    for cut in range(budget + 1):
        for gone in combinations(spots, cut):
            left = [i for i in spots if i not in gone]
            for wild in range(budget - cut + 1):
                for masked in combinations(left, wild):
                    yield "".join(WILDCARD if i in masked else name[i] for i in left), wild, cut


def _form_rows(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in range(0, len(batch), FORM_BATCH):
            rows = [
                (name, b, form, wild, cut)
                for name in batch["name"].iloc[part : part + FORM_BATCH]
                for b in _budgets(len(name), threshold)
                if b <= STAR_BUDGET
                for form, wild, cut in set(edited_forms(name, b))
            ]
            yield pd.DataFrame(rows, columns=["name", "budget", "form", "wild", "cut"])


def short_name_edges(names: DataFrame, threshold: int) -> DataFrame:
    """Edges that connect similar names with at most two edits between them.

    Names sharing a form with ``c`` and ``c'`` removed characters are within
    ``wild + c + c'`` edits, so where that fits the budget every such pair is
    similar and one representative per form and cut connects them all: the
    number of edges is linear in the forms, with no pair left out.
    """
    forms = names.mapInPandas(
        lambda batches: _form_rows(batches, threshold),
        "name string, budget int, form string, wild int, cut int",
    )
    keys = ["budget", "form", "wild"]
    cuts = range(STAR_BUDGET + 1)
    heads = forms.groupBy(*keys).agg(
        *[F.min(F.when(F.col("cut") == c, F.col("name"))).alias(f"head_{c}") for c in cuts],
        F.count(F.lit(1)).alias("members"),
    )
    joined = forms.join(heads.filter("members > 1"), keys)
    linked = []
    for c in cuts:
        longer = F.length("form") + F.greatest(F.col("cut"), F.lit(c))
        fits = (F.col("wild") + F.col("cut") + c <= F.col("budget")) & (
            F.floor(longer * (100 - threshold) / 100) == F.col("budget")
        )
        linked.append(F.when(fits & (F.col(f"head_{c}") != F.col("name")), F.col(f"head_{c}")))
    edges = joined.select(F.col("name").alias("a"), F.explode(F.array_compact(F.array(*linked))).alias("b"))
    return edges.distinct()


def _piece(name: Column, length: Column, parts: Column, i: Column, move: Column) -> Column:
    """Piece of ``name`` at the place of the i-th of even parts, moved."""
    start = F.floor(i * length / parts)
    return F.substring(name, (start + move + 1).cast("int"), (F.floor((i + 1) * length / parts) - start).cast("int"))


def long_name_edges(names: DataFrame, threshold: int) -> DataFrame:
    """Similar pairs that may be three edits or more apart.

    The shorter name is cut into ``2 (b + 1)`` parts for a budget of ``b``
    edits, so at least ``b + 2`` parts survive the edits and at least one of
    any ``b + 1`` parts does.  Only its ``b + 1`` rarest parts are indexed: a
    prefix shared by a third of all names is a key for none of them, as long as
    it fills less than half of the name.  The longer name looks up every part a
    name of each length in reach could leave in it.  Names that meet are
    searched in a trie, which gives a dense group about as many edges as names.
    """
    length, budget = F.col("length"), F.col("budget")
    sized = names.select("name", F.length("name").alias("length"))
    loss = 100 - threshold
    parts = 2 * (budget + 1)

    # Budgets of the pairs in which this is the shorter name: the longer one
    # has between ceil(100 b / loss) and length + b characters.
    most = F.floor(length * loss / threshold)
    shorter = (
        sized.withColumn("budget", F.explode(F.sequence(F.floor(length * loss / 100), F.greatest(most, F.floor(length * loss / 100)))))
        .filter((budget > STAR_BUDGET) & (F.ceil(budget * 100 / loss) <= length + budget))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .withColumn("piece", _piece(F.col("name"), length, parts, F.col("part"), F.lit(0)))
    )
    key = ["budget", "length", "part", "piece"]
    counted = shorter.join(shorter.groupBy(*key).agg(F.count(F.lit(1)).alias("names")), key)
    rarest = Window.partitionBy("name", "budget").orderBy("names", "part")
    index = counted.withColumn("_rank", F.row_number().over(rarest)).filter(F.col("_rank") <= budget + 1)

    gap = F.col("full") - length
    longer = (
        sized.select("name", F.col("length").alias("full"), F.floor(F.col("length") * loss / 100).alias("budget"))
        .filter(budget > STAR_BUDGET)
        .withColumn("length", F.explode(F.sequence((F.col("full") - budget).cast("int"), F.col("full"))))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .withColumn("move", F.explode(F.sequence(-F.floor((budget - gap) / 2), F.floor((budget + gap) / 2))))
    )
    at = F.floor(F.col("part") * length / parts) + F.col("move")
    end = F.floor((F.col("part") + 1) * length / parts) + F.col("move")
    probe = longer.filter((at >= 0) & (end <= F.col("full"))).select(
        F.col("name").alias("a"),
        "budget",
        "length",
        "part",
        _piece(F.col("name"), length, parts, F.col("part"), F.col("move")).alias("piece"),
    )
    return _bucket_edges(
        index.select(F.col("name"), *key).withColumn("asks", F.lit(False)).unionByName(
            probe.select(F.col("a").alias("name"), *key).withColumn("asks", F.lit(True))
        ),
        key, threshold,
    )


def _bucket_edges(entries: DataFrame, key: list[str], threshold: int, most: int = CELL_NAMES) -> DataFrame:
    """Edges between the searching names (``asks``) of each bucket and its indexed ones.

    Buckets share tasks by hash.  A bucket beyond ``most`` names on a side is cut in
    parts; every part of its index meets every part of its searches in a cell of
    its own, so no task holds a whole hot bucket.
    """
    cores = entries.sparkSession.sparkContext.defaultParallelism
    entries = cut_lineage(entries.distinct().withColumn("bucket", F.xxhash64(*key)))
    sizes = entries.groupBy("bucket").agg(F.count_if(F.col("asks")).alias("_asked"), F.count_if(~F.col("asks")).alias("_held"))
    # A bucket is of use if both sides have names; most have one name that meets only itself.
    sizes = cut_lineage(sizes.filter("_asked > 0 AND _held > 0 AND _asked + _held > 2"))
    parts = lambda c: F.ceil(F.col(c) / most).cast("int")
    used = entries.join(sizes.select("bucket", parts("_held").alias("_rows"), parts("_asked").alias("_columns")), "bucket")
    own = lambda c: F.array(F.pmod(F.xxhash64("name"), F.col(c)).cast("int"))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    spread = used.withColumn("_row", F.explode(F.when(F.col("asks"), every("_rows")).otherwise(own("_rows"))))
    spread = spread.withColumn("_column", F.explode(F.when(F.col("asks"), own("_columns")).otherwise(every("_columns"))))
    total = sizes.agg(F.sum(F.col("_asked") + F.col("_held"))).first()[0] or 0
    tasks = max(cores, -(-total // most))
    alone = (F.col("_rows") == 1) & (F.col("_columns") == 1)
    cell = F.when(alone, F.struct(F.pmod("bucket", F.lit(tasks)).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c")))
    cell = cell.otherwise(F.struct(F.col("bucket").alias("a"), (F.col("_row") + 1).alias("b"), F.col("_column").alias("c")))

    def reach(name: str) -> int:
        return edit_budget(len(name), threshold)

    def run(table: pa.Table) -> pa.Table:
        buckets: dict[int, tuple[list[str], list[str]]] = {}
        for bucket, name, asks in zip(*(table.column(c).to_pylist() for c in ("bucket", "name", "asks")), strict=True):
            buckets.setdefault(bucket, ([], []))[asks].append(name)
        groups, edges = Groups(), []
        for held, asked in buckets.values():
            edges += bucket_links(sorted(asked), sorted(held), reach, groups)
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return spread.select("bucket", "name", "asks", cell.alias("_cell")).groupBy("_cell").applyInArrow(run, "a string, b string")


def similar_edges(names: DataFrame, threshold: int = 90) -> DataFrame:
    """Edges whose connected components are the groups of similar names."""
    plain = names.select(F.trim("name").alias("name")).filter(F.length("name") > 0).distinct()
    # Read by three branches, and each name unfolds to many keys: spread them.
    plain = cut_lineage(plain).repartition(names.sparkSession.sparkContext.defaultParallelism, "name")
    return short_name_edges(plain, threshold).unionByName(long_name_edges(plain, threshold))


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Node and its component's smallest node, for edges (a, b).

    Alternating large-star and small-star rounds; each round writes its edges
    to the shared folder, and a round that changes nothing ends the loop.
    """
    current = cut_lineage(edges.select("a", "b").filter("a != b").distinct())
    seen = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        before, current = current, cut_lineage(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        release(before)
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(heads)


def group_similar(names: DataFrame, threshold: int = 90) -> DataFrame:
    """Each distinct name with its group's key, the smallest name of the group."""
    groups = connected_components(similar_edges(names, threshold))
    plain = names.select(F.trim("name").alias("name")).filter(F.length("name") > 0).distinct()
    return plain.join(groups, F.col("name") == F.col("node"), "left").select(
        "name", F.coalesce("component", "name").alias("group_key")
    )
