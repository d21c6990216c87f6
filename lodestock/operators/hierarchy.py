"""Bill-of-materials trees as repeated joins of an edge table, or as one recursive query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage, release
from .columns import quoted


def flatten_tree(
    edges: DataFrame,
    roots: DataFrame,
    parent: str = "parent",
    child: str = "child",
    max_depth: int = 3,
    guard_cycles: bool = True,
) -> DataFrame:
    """Every edge below each root, with its depth, down to ``max_depth``.

    ``roots`` has one column ``root``.  One equi-join per level.  The edges and
    each level are written to the shared folder as they are found: otherwise
    the union of the levels would compute the first one again for every level
    below it.  With ``guard_cycles`` a path never enters a node twice.
    """
    steps = cut_lineage(edges.withColumnsRenamed({parent: "_parent", child: "_child"}))
    extra = [c for c in edges.columns if c not in (parent, child)]
    level = roots.select(
        F.col("root"), F.col("root").alias("_node"), F.array("root").alias("_path")
    )
    found = []
    for depth in range(1, max_depth + 1):
        below = level.join(steps, F.col("_node") == F.col("_parent"))
        if guard_cycles:
            below = below.filter(~F.array_contains("_path", F.col("_child")))
        path = F.concat("_path", F.array("_child")) if depth < max_depth else F.col("_path")
        below = cut_lineage(
            below.select("root", "_parent", F.col("_child").alias("_node"), *extra, path.alias("_path"))
        )
        found.append(below.withColumn("depth", F.lit(depth)))
        level = below.select("root", "_node", "_path")
    columns = ["root", F.col("_parent").alias(parent), F.col("_node").alias(child), *extra, "depth"]
    return reduce(DataFrame.unionByName, found).select(columns)


def first_matching_level(
    edges: DataFrame,
    wanted: Column,
    parent: str = "parent",
    child: str = "child",
    levels: int = 3,
    name: str = "match",
) -> DataFrame:
    """Per root path of exactly ``levels`` edges: the topmost wanted node.

    ``wanted`` is a condition on a column ``node``.  Paths without a wanted
    node drop, the rest are distinct per root and node.
    """
    flagged = edges.select(
        F.col(parent).alias("_p"), F.col(child).alias("_c"), F.col(child).alias("node")
    ).withColumn("_hit", wanted)
    flagged = cut_lineage(flagged.drop("node"))  # read once per level
    path = flagged.select(
        F.col("_p").alias("root"), F.col("_c").alias("_node"), F.when(F.col("_hit"), F.col("_c")).alias(name)
    )
    for _ in range(levels - 1):
        below = path.join(flagged, F.col("_node") == F.col("_p"))
        path = below.select(
            "root", F.col("_c").alias("_node"), F.coalesce(name, F.when(F.col("_hit"), F.col("_c"))).alias(name)
        )
    return path.filter(F.col(name).isNotNull()).select("root", name).distinct()


ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def flatten_tree_recursive(
    edges: DataFrame, roots: DataFrame, parent: str = "parent", child: str = "child", max_depth: int = 3
) -> DataFrame:
    """``flatten_tree`` as one ``WITH RECURSIVE`` query; the same rows.

    A path never enters a node twice.  Spark stops a recursion at a million rows
    unless told otherwise, so the result is written while that limit is lifted.
    The edges are written first: every level would compute them again.
    """
    spark = edges.sparkSession
    extra = [c for c in edges.columns if c not in (parent, child)]
    steps = edges.select(
        F.col(quoted(parent)).alias("_parent"), F.col(quoted(child)).alias("_child"), *[F.col(quoted(c)).alias(f"_x{i}") for i, c in enumerate(extra)]
    )
    steps = cut_lineage(steps)
    names = "".join(f", _x{i}" for i in range(len(extra)))
    taken = "".join(f", e._x{i}" for i in range(len(extra)))
    statement = f"""
        WITH RECURSIVE flat(root, _parent, _child, depth, path{names}) AS (
            SELECT r.root, e._parent, e._child, 1, array(r.root, e._child){taken}
            FROM {{roots}} r JOIN {{steps}} e ON e._parent = r.root WHERE e._child <> r.root
            UNION ALL
            SELECT f.root, e._parent, e._child, f.depth + 1, array_append(f.path, e._child){taken}
            FROM flat f JOIN {{steps}} e ON e._parent = f._child
            WHERE f.depth < {int(max_depth)} AND NOT array_contains(f.path, e._child))
        SELECT root, _parent, _child, depth{names} FROM flat
    """
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        found = cut_lineage(spark.sql(statement, roots=roots.select("root"), steps=steps))
    finally:
        spark.conf.set(ROW_LIMIT, before)
    release(steps)
    return found.select(
        "root", F.col("_parent").alias(parent), F.col("_child").alias(child), *[F.col(f"_x{i}").alias(c) for i, c in enumerate(extra)], "depth"
    )


PART_ROWS = 1 << 18


def distinct_edges(found: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """Distinct rows of a flattened tree, in as many parts as its rows ask for, so a task's memory stays the same."""
    parts = max(1, -(-found.count() // PART_ROWS))
    return found.repartition(parts, F.col(quoted(parent)), F.col(quoted(child))).distinct()


def cyclic_edges(edges: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """Distinct edges that lie on a cycle, or lead from one cycle to another.

    Edges from nodes that none enters, and into nodes that none leaves, are trimmed
    until all that is left is entered and left again; a tree leaves nothing.  The
    rounds are as many as the longest path to or from a cycle has edges.
    """
    left = cut_lineage(edges.select(F.col(quoted(parent)).alias("_p"), F.col(quoted(child)).alias("_c")).dropna().distinct())
    size = left.count()
    while size:
        entered, leaving = left.select(F.col("_c").alias("_p")).distinct(), left.select(F.col("_p").alias("_c")).distinct()
        before, left = left, cut_lineage(left.join(entered, "_p", "left_semi").join(leaving, "_c", "left_semi").select("_p", "_c"))
        release(before)
        size, earlier = left.count(), size
        if size == earlier:
            break
    return left.select(F.col("_p").alias(parent), F.col("_c").alias(child))
