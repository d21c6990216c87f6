"""Recursion, cycles, and loads that are run again."""

import pytest
from support import rows

from lodestock.operators import hierarchy, load

EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "a"), ("d", "e"), ("e", "d"), ("e", "f"), ("s", "s"), (None, "a"), ("q", "r")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(p, c, i) for i, (p, c) in enumerate(EDGES)], "parent string, child string, `pieces per unit` int")


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_recursion_gives_the_rows_of_the_loop(spark, edges, depth):
    roots = spark.createDataFrame([("a",), ("x",), ("s",), ("none",)], "root string")
    limit = spark.conf.get(hierarchy.ROW_LIMIT)
    by_query = hierarchy.flatten_tree_recursive(edges, roots, max_depth=depth)
    by_loop = hierarchy.flatten_tree(edges, roots, max_depth=depth)
    assert by_query.columns == by_loop.columns and sorted(rows(by_query)) == sorted(rows(by_loop))
    assert spark.conf.get(hierarchy.ROW_LIMIT) == limit


def test_cycles_are_reported(spark, edges):
    found = sorted(rows(hierarchy.cyclic_edges(edges)))
    assert found == [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "d"), ("s", "s")]
    tree = edges.filter("parent IN ('x', 'q')")
    assert hierarchy.cyclic_edges(tree).count() == 0 == hierarchy.cyclic_edges(edges.limit(0)).count()


def test_a_load_that_runs_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    for _ in range(3):
        load.append_snapshot(df, path, load_id="2024-W01")
    load.append_snapshot(df.limit(1), path, load_id="2024-W02")
    assert rows(spark.read.parquet(path).groupBy("load_id").count(), "load_id") == [("2024-W01", 2), ("2024-W02", 1)]
    load.append_snapshot(df.limit(0), path, load_id="2024-W01")  # the repeated run has no rows any more
    assert [r[0] for r in rows(spark.read.parquet(path).select("load_id").distinct())] == ["2024-W02"]
    with pytest.raises(ValueError):
        load.append_snapshot(df, path, load_id="a/b")
