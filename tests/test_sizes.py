"""Work that is done once, and parts that follow the number of rows."""

from pyspark.sql import functions as F

from lodestock.ml import stems
from lodestock.operators import hierarchy
from lodestock.plans import contracts
from support import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stems_move_no_tokens(spark):
    docs = [(1, ["hope", "hopes"]), (1, ["hoping", None]), (None, ["cats"]), (None, ["cat"])]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    counts = stems.stem_counts(df, "id", "tokens")
    assert "Join" not in plan(counts) and plan(counts).count("Exchange hashpartitioning") == 1
    assert sorted(rows(counts), key=str) == [(1, "hope", 3), (None, "cat", 2)]


def test_recursion_computes_edges_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "c")], "parent string, child string").mapInArrow(count, "parent string, child string")
    roots = spark.createDataFrame([("r",)], "root string")
    assert rows(hierarchy.flatten_tree_recursive(edges, roots), "depth") == [("r", "r", "a", 1), ("r", "a", "b", 2), ("r", "b", "c", 3)]
    assert seen.value == 3


def test_distinct_edges_in_parts(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "PART_ROWS", 10)
    df = spark.range(100).select((F.col("id") % 50).alias("parent"), (F.col("id") % 25).alias("child"))
    out = hierarchy.distinct_edges(df)
    assert out.count() == 50 and out.rdd.getNumPartitions() == 10


def test_one_file_a_document_in_folders(spark, tmp_path, monkeypatch):
    from lodestock.catalog import sources

    spark.createDataFrame([("a",), ("b",), ("a",)], "text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(sources, "scratch_path", lambda spark, label: f"{tmp_path}/texts")
    found = sources.text_files_of_one_document(spark, str(tmp_path))
    assert sorted(r["files"] for r in found.collect()) == [1, 2]
    assert not list((tmp_path / "texts").glob("*.txt")) and len(list((tmp_path / "texts").glob("folder=*/*.txt"))) == 3


def test_a_cell_meets_the_prices_of_its_item_as_arrays(spark, monkeypatch):
    monkeypatch.setattr(contracts, "PRICES_HELD", 2)
    prices = spark.createDataFrame([("i", 1.0), ("i", 2.0), ("i", 3.0), ("j", 3.0), (None, 1.0), ("k", None), ("zz", 9.0)], "item string, price double")
    assert sorted(rows(contracts.priced_items(prices))) == [("i", [1.0, 2.0]), ("i", [3.0]), ("j", [3.0]), ("zz", [9.0])]
    cells = [("D", 1, 1, 1, "i"), ("D", 1, 1, 2, "$3.0"), ("D", 1, 1, 3, "2.0"), ("D", 1, 2, 1, "j"), ("D", 1, 2, 2, "3"), ("E", 1, 1, 1, "i"), ("E", 1, 1, 2, "99"), ("E", 1, None, 1, "3")]
    out = contracts.price_column_labels(spark.createDataFrame(cells, "document string, table int, row int, column int, value string"), prices)
    assert rows(out, "document", "column") == [("D", 1, 1, 2, "NotPrice"), ("D", 1, 2, 2, "Price"), ("D", 1, 3, 1, "NotPrice"), ("E", 1, 1, 2, "Other"), ("E", 1, 2, 1, "Other")]
