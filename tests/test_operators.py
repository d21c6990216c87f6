import math
import random

import pytest
from support import rows
import numpy as np
from pyspark.sql import functions as F, types as T

from lodestock.operators import aggregates, columns as cols, contract, hierarchy, joins, lists, load, picks, profiling, quantiles, reshape
from lodestock.operators import rows as row_ops, scopes
from lodestock.operators.similarity import connected_components, edit_budget, group_similar
from lodestock.session import scratch_path


def frame(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


# --- columns ---------------------------------------------------------------


def test_keep_and_align(spark):
    df = frame(spark, "a int, `b c` string", (1, "x"))
    assert cols.keep_columns(df, ["b c", "a"]).columns == ["b c", "a"]
    with pytest.raises(cols.MissingColumns):
        cols.keep_columns(df, ["a", "z"])
    with pytest.raises(cols.MissingColumns):
        cols.drop_columns(df, ["z"], must_exist=True)
    assert rows(cols.align_columns(df, ["z", "b c"])) == [(None, "x")]
    assert cols.drop_null_columns(frame(spark, "a int, b int", (1, None), (None, None))).columns == ["a"]


def test_decoded_names():
    assert cols.decoded_name("Remain_x0020_on_x0020_Annual_x00") == "Remain on Annual"
    assert cols.decoded_name("plain_xyz_long_tail") == "plain_xyz_long_tail"


# --- rows ------------------------------------------------------------------


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_forward_fill_any_block(spark, block):
    random.seed(block)
    data = [(k, i, random.choice([None, None, i])) for k in ("a", None) for i in range(20)]
    expected = {}
    last = {}
    for k, i, v in data:
        last[k] = v if v is not None else last.get(k)
        expected[k, i] = last[k]
    df = frame(spark, "k string, row_pos int, v int", *random.sample(data, len(data)))
    got = row_ops.forward_fill(df, ["v"], by=["k"], block_rows=block).collect()
    assert {(r.k, r.row_pos): r.v for r in got} == expected


def test_sections(spark):
    data = ["a", "Total", "skip", "Demand", "b", None, "c", "Total", "x"]
    df = frame(spark, "row_pos int, label string", *list(enumerate(data)))
    for block in (2, 100):
        first = row_ops.section_rows(df, "label", "Demand", "Total", active_first=True, block_rows=block)
        assert rows(first.select("label", "section"), "row_pos") == [("a", 1), ("b", 2), ("c", 2)]
    later = row_ops.section_rows(df, "label", "Demand", "Total", active_first=False)
    assert [r[0] for r in rows(later.select("label", "row_pos"), "row_pos")] == ["b", "c"]


def test_footer(spark):
    df = frame(spark, "row_pos int", *[(i,) for i in range(5)])
    assert rows(row_ops.drop_footer(df, 3), "row_pos") == [(0,), (1,)]


def test_rows_per_file(spark):
    """A short and a long sheet keep their own footers and sections; null is a file too."""
    sheets = {"a": ["x", "Total", "y"], "b": ["Demand", "p", "Total", "q", "Demand", "r", "s"], None: ["n", "m"]}
    df = frame(spark, "file string, row_pos int, label string", *[(f, i, x) for f, d in sheets.items() for i, x in enumerate(d)])
    kept = row_ops.drop_footer(df, 1, by=["file"])
    assert {(r.file, r.row_pos) for r in kept.collect()} == {(f, i) for f, d in sheets.items() for i in range(len(d) - 1)}
    for block in (2, 100):
        got = row_ops.section_rows(df, "label", "Demand", "Total", True, block_rows=block, by=["file"])
        assert {(r.file, r.label, r.section) for r in got.collect()} == {
            ("a", "x", 1), ("b", "p", 1), ("b", "r", 2), ("b", "s", 2), (None, "n", 1), (None, "m", 1)
        }


# --- picks and joins -------------------------------------------------------


def test_ties(spark):
    df = frame(spark, "k string, v int, x int", ("a", 2, 1), ("a", 2, 2), ("a", 1, 3), (None, 5, 4))
    assert rows(picks.extreme_rows(df, ["k"], "v").select("x"), "x") == [(1,), (2,), (4,)]
    assert rows(picks.first_per_key(df, ["k"], [F.desc("v"), F.asc("x")]).select("x"), "x") == [(1,), (4,)]
    items = frame(spark, "g int, c int", (1, 7), (1, 5), (2, 9))
    assert rows(picks.most_frequent(items, ["g"], "c"), "g") == [(1, 5, 1), (2, 9, 1)]


def test_null_safe_join(spark):
    left = frame(spark, "a string, b string, x int", ("p", None, 1), (None, None, 2), ("q", "r", 3))
    right = frame(spark, "a string, b string, y int", ("p", None, 10), (None, None, 20))
    assert rows(joins.join_null_safe(left, right, ["a", "b"]).select("x", "y"), "x") == [(1, 10), (2, 20), (3, None)]


def test_trailing_sum_equals_pairs(spark):
    random.seed(1)
    data = [(random.choice("ab"), f"2024-01-{random.randint(1, 28):02d}", random.randint(1, 9)) for _ in range(60)]
    df = frame(spark, "k string, d string, q int", *data).withColumn("d", F.to_date("d"))
    got = {(r.k, str(r.d)): r.t for r in joins.trailing_sum(df, ["k"], "d", "q", 5, "t").collect()}
    expected = {}
    for k, d, _ in data:
        for k2, d2, q in data:
            if k == k2 and 0 <= int(d[-2:]) - int(d2[-2:]) <= 5:
                expected[k, d] = expected.get((k, d), 0) + q
    assert got == expected


def test_names_for_ids(spark):
    df = frame(spark, "i int, ids string", (1, "3; 1"), (2, "9"), (3, "1"))
    people = frame(spark, "id int, n string", (1, "Amy"), (3, "Cy"))
    assert rows(lists.names_for_ids(df, ["i"], "ids", people, "id", "n", "names"), "i") == [(1, "Cy; Amy"), (2, None), (3, "Amy")]


# --- aggregates ------------------------------------------------------------


def test_join_texts_hot_key_is_exact(spark):
    data = [("hot", i, f"v{i % 50}") for i in range(5000)] + [("cold", 1, "z"), ("cold", 0, None), ("none", 0, None)]
    df = frame(spark, "k string, p int, v string", *random.sample(data, len(data)))
    got = {r.k: r.t for r in aggregates.join_texts(df, ["k"], "v", ["p"], "t", max_chars=120).collect()}
    assert got == {"hot": ", ".join(f"v{i % 50}" for i in range(5000))[:120], "cold": "z"}
    whole = {r.k: r.t for r in aggregates.join_texts(df, ["k"], "v", ["p"], "t").collect()}
    assert whole == {"hot": ", ".join(f"v{i % 50}" for i in range(5000)), "cold": "z"}
    distinct = aggregates.join_texts(df, ["k"], "v", [], "t", sep=",", distinct=True, descending=True, max_chars=20)
    assert {r.k: r.t for r in distinct.collect()}["hot"] == ",".join(sorted({f"v{i}" for i in range(50)}, reverse=True))[:20]


def test_sums_of_nothing(spark):
    df = frame(spark, "k int, v int", (1, None), (2, 3))
    assert rows(df.groupBy("k").agg(aggregates.sum_or_zero("v").alias("s")), "k") == [(1, 0), (2, 3)]
    priced = frame(spark, "k int, p double, q double", (1, 2.0, 1.0), (1, 4.0, 3.0), (2, 5.0, 0.0))
    assert rows(aggregates.weighted_average(priced, ["k"], "p", "q", "w"), "k") == [(1, 3.5), (2, None)]


def test_group_total_with_null_key(spark):
    df = frame(spark, "s string, v int", ("a", 1), ("a", 2), (None, 5), (None, 6))
    assert rows(aggregates.group_total(df, ["s"], "v", "t").select("v", "t"), "v") == [(1, 3), (2, 3), (5, 11), (6, 11)]


def test_cross_tab_shares(spark):
    df = frame(spark, "a string, b string", ("x", "p"), ("x", "q"), ("x", "q"), ("y", "p"))
    got = rows(aggregates.cross_tab(df, "a", "b", ["p", "q"], shares=True), "a")
    assert got == [("x", pytest.approx(1 / 3), pytest.approx(2 / 3)), ("y", 1.0, 0.0)]


# --- reshape ---------------------------------------------------------------


def test_reshape(spark):
    wide = frame(spark, "id int, `2022 S` int, `2023 S` int", (1, 5, None))
    assert rows(reshape.unpivot(wide, ["id"], ["2022 S", "2023 S"]), "variable") == [(1, "2022 S", 5), (1, "2023 S", None)]
    assert rows(reshape.unpivot(wide, ["id"], ["2022 S", "2023 S"], drop_null=True)) == [(1, "2022 S", 5)]
    marks = frame(spark, "id int, m1 string, m2 string", (1, "x", " "), (2, None, "y"))
    assert rows(reshape.marked_cells(marks, ["id"], ["m1", "m2"]), "id") == [(1, "m1"), (2, "m2")]
    attributes = frame(spark, "i int, a string, v string", (1, "e", "b"), (1, "e", "a"), (1, "e", "a"), (2, "c", "z"))
    assert rows(reshape.pivot_texts(attributes, ["i"], "a", {"e": "ehs", "c": "box"}, "v"), "i") == [(1, "a,b", None), (2, None, "z")]
    split = reshape.split_by_rule(frame(spark, "s string", ("done",), ("new",), (None,)), [("d", F.col("s") == "done")], None)
    assert rows(split) == [("done", "d")]


# --- contract --------------------------------------------------------------

TARGET = T.StructType(
    [
        T.StructField("RequestID", T.IntegerType()),
        contract.text_field("EventName", 5),
        T.StructField("Amount", T.DecimalType(18, 2)),
    ]
)


def test_conform_by_position_and_name(spark):
    df = frame(spark, "a double, b string, c string", (7.0, " ", "1.239"), (float("nan"), "nan", "NaT"))
    assert [tuple(map(str, r)) for r in contract.conform(df, TARGET).collect()] == [("7", "None", "1.24"), ("None", "None", "None")]
    with pytest.raises(contract.BadValue, match="Amount: 2 "):
        contract.conform(frame(spark, "a double, b string, c string", (1.0, "x", "12.5"), (2.0, "y", "n.v."), (3.0, "z", "1,200")), TARGET)
    named = contract.conform(df.select("b", "a"), TARGET, columns=["eventname", "[REQUESTID]"])
    assert named.columns == ["EventName", "RequestID"]
    ids = contract.conform(frame(spark, "x double", (1e12,), (None,)), T.StructType([contract.text_field("Id")]), categorical=["x"])
    assert rows(ids) == [("1000000000000",), (None,)]


@pytest.mark.parametrize(
    "source,columns,error",
    [
        (["a", "a", "b"], None, contract.DuplicateColumn),
        (["a", "b"], None, contract.MissingSourceColumn),
        (["a", "b", "c", "d"], None, contract.ExtraSourceColumn),
        (["a", "b"], ["RequestID"], contract.WrongColumnCount),
        (["a", "b"], ["RequestID", "Nope"], contract.UnknownColumn),
        (["a"], ["Nope"], contract.UnknownTable),
    ],
)
def test_contract_errors(source, columns, error):
    with pytest.raises(error):
        contract.matched_fields(source, TARGET, columns)


def test_unknown_table(spark):
    with pytest.raises(contract.UnknownTable):
        contract.target_schema(spark, "no_such_table")


def test_truncation_names_the_column(spark):
    df = contract.conform(frame(spark, "a int, b string, c int", (1, "too long", 1)), TARGET)
    with pytest.raises(contract.TruncatedText, match="EventName: 8 > 5"):
        contract.assert_fits(df, TARGET)


def test_round_trip(spark):
    path, log = scratch_path(spark, "t"), scratch_path(spark, "l")
    df = frame(spark, "a int, b string, c int", (1, "x", 2), (2, "y", 3))
    assert load.load_table(df, path, TARGET, log, "p", "job.py", "area")
    back = spark.read.schema(TARGET).parquet(path)
    assert [tuple(map(str, r)) for r in back.orderBy("RequestID").collect()] == [("1", "x", "2.00"), ("2", "y", "3.00")]
    long = frame(spark, "a int, b string, c int", (1, "too long", 2))
    assert not load.load_table(long, path, TARGET, log, "p", "job.py", "area")
    assert spark.read.parquet(path).count() == 2
    trail = spark.read.parquet(log).orderBy("log_type").collect()
    assert [(r.log_type, r.rec_count, r.log_source) for r in trail] == [("E", 0, "Python: job.py"), ("I", 2, "Python: job.py")]


# --- load ------------------------------------------------------------------


def test_keep_earliest_keeps_ties_and_nulls(spark):
    df = frame(spark, "k int, t int, x int", (1, 5, 1), (1, 5, 2), (1, 6, 3), (1, None, 4), (None, 9, 5))
    assert rows(load.keep_earliest(df, ["k"], "t").select("x"), "x") == [(1,), (2,), (4,), (5,)]


def test_without_slice_keeps_unknown(spark):
    df = frame(spark, "y int", (1996,), (1997,), (None,))
    assert rows(load.without_slice(df, F.col("y") == 1997), "y") == [(None,), (1996,)]


# --- trees and scopes ------------------------------------------------------


def test_tree_depth_and_cycle(spark):
    edges = frame(spark, "parent string, child string, qty int", ("a", "b", 1), ("b", "c", 2), ("c", "d", 3), ("d", "e", 4), ("c", "a", 5))
    roots = frame(spark, "root string", ("a",))
    got = rows(hierarchy.flatten_tree(edges, roots).select("parent", "child", "qty", "depth"), "depth", "child")
    assert got == [("a", "b", 1, 1), ("b", "c", 2, 2), ("c", "d", 3, 3)]
    free = rows(hierarchy.flatten_tree(edges, roots, guard_cycles=False).select("child", "depth"), "depth", "child")
    assert free == [("b", 1), ("c", 2), ("a", 3), ("d", 3)]


def test_first_level(spark):
    edges = frame(spark, "parent string, child string", ("r", "m"), ("m", "x"), ("x", "y"), ("r", "n"), ("n", "p"), ("p", "q"))
    got = rows(hierarchy.first_matching_level(edges, F.col("node").isin("x", "y", "q")), "match")
    assert got == [("r", "q"), ("r", "x")]


def test_scopes(spark):
    machines = ["A1272", "B1272 C4", "C1227", "D1274/1276 C4", "E9"]
    expected = {
        "1272": ["A1272"],
        "1272 C4": ["B1272 C4"],
        "All 1272": ["A1272", "B1272 C4"],
        "1227 & 1272": ["A1272", "C1227"],
        "All 1274 & All 1276": ["D1274/1276 C4"],
        "All C4": ["B1272 C4", "D1274/1276 C4"],
        "All Non-C4": ["A1272", "C1227", "E9"],
        "All Processes": machines,
        "other": [],
    }
    requests = frame(spark, "id int, sheet int, scope string", *[(i, 1, s) for i, s in enumerate(expected)])
    grid = frame(spark, "sheet int, machine string", *[(1, m) for m in machines], (2, "F1272"))
    out = scopes.expand_scopes(requests, grid, "scope", "machine", ["sheet"]).collect()
    got = {s: sorted(r.machine for r in out if r.scope == s) for s in expected}
    assert got == {s: sorted(m) for s, m in expected.items()}


def test_scopes_broadcast_no_unfolded_side(spark):
    requests = spark.range(40).selectExpr("id", "id % 4 AS sheet", "'All Processes' AS scope")
    grid = spark.range(8).selectExpr("id % 4 AS sheet", "concat('M', id, ' 1272') AS machine")
    out = scopes.expand_scopes(requests, grid, "scope", "machine", ["sheet"])
    assert out.count() == 80
    assert "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()


# --- quantiles and similarity ---------------------------------------------


def test_exact_quantiles_of_several_columns(spark):
    random.seed(4)
    values = [random.choice([0.0, -0.0, 1e300, -5e-324, 1e12, random.random(), -random.random() * 1e9]) for _ in range(999)]
    df = frame(spark, "x double, n long, none double", *[(v if i % 50 else None, i, None) for i, v in enumerate(values)])
    ordered = sorted(v for i, v in enumerate(values) if i % 50)

    def plain(p):
        at = p * (len(ordered) - 1)
        a, b = math.floor(at), math.ceil(at)
        return ordered[a] + (ordered[b] - ordered[a]) * (at - a)

    shares = [0.0, 0.001, 0.25, 0.5, 0.731, 1.0]
    got = quantiles.quantiles_of(df.repartition(5), {"x": shares, "n": [0.5], "none": [0.1, 0.9]})
    assert got == {"x": [plain(p) for p in shares], "n": [499.0], "none": [None, None]}
    even = frame(spark, "x double", (1.0,), (2.0,), (4.0,), (9.0,), (None,), (float("nan"),))
    assert profiling.exact_quantiles(even, "x", [0.5, 1.0]) == [3.0, 9.0]
    assert quantiles.quantiles_of(even.limit(0), {"x": [0.5]}) == {"x": [None]}


def test_keys_of_doubles_keep_their_order():
    values = np.array([-np.inf, -1e308, -1.5, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.5, np.inf])
    keys = quantiles.ordered_keys(values)
    assert (np.diff(keys.astype(object)) > 0).all() and [quantiles.value_of(int(k)) for k in keys] == values.tolist()
    assert quantiles.ordered_keys(np.array([-0.0])) == quantiles.ordered_keys(np.array([0.0]))


def _edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_similar_names_match_brute_force(spark):
    random.seed(11)
    names = set()
    for length in (9, 10, 18, 19, 20, 28, 29, 30, 33, 41):
        for start in ("", "shared prefix "):
            cur = start + "".join(random.choice("abc") for _ in range(max(3, length - len(start))))
            for _ in range(4):
                names.add(cur)
                chars = list(cur)
                for _ in range(random.randint(1, 3)):
                    i = random.randrange(len(chars))
                    kind = random.random()
                    if kind < 0.4:
                        chars[i] = random.choice("abc")
                    elif kind < 0.7:
                        del chars[i]
                    else:
                        chars.insert(i, random.choice("abc"))
                cur = "".join(chars).strip()
    names = sorted(names)
    group = {n: n for n in names}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if _edits(a, b) <= edit_budget(max(len(a), len(b)), 90):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    group = {n: root(n) for n in names}
    got = dict(rows(group_similar(frame(spark, "name string", *[(n,) for n in names]))))
    assert got == group


def test_components_of_a_long_chain(spark):
    edges = frame(spark, "a string, b string", *[(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)], ("x", "y"))
    got = dict(rows(connected_components(edges)))
    assert len(got) == 63 and set(got.values()) == {"n000", "x"}


def test_failures_are_audited_and_keep_the_table(spark, tmp_path):
    target = T.StructType([T.StructField("a", T.LongType())])
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    good = spark.createDataFrame([(1,), (2,)], "a long")
    assert load.load_table(good, path, target, log, "p", "job.py", "area")
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("source gone"))).otherwise(F.col("id")).cast("long").alias("a"))
    with pytest.raises(Exception, match="source gone"):
        load.load_table(broken, path, target, log, "p", "job.py", "area")
    assert sorted(r["log_type"] for r in spark.read.parquet(log).collect()) == ["E", "I"]
    with pytest.raises(Exception, match="source gone"):
        load.full_refresh(broken, path)
    assert sorted(r["a"] for r in spark.read.parquet(path).collect()) == [1, 2]
    load.full_refresh(spark.read.parquet(path).filter("a = 2"), path)  # reads what it replaces
    assert [r["a"] for r in spark.read.parquet(path).collect()] == [2]
