"""MLlib's trees, forests and boosted trees over wide rows that are mostly zero.

MLlib keeps a row as one bin number per feature and adds all of them to the
statistics at every level.  Here a row keeps only the bins that differ from the
bin of zero; what the other rows of a node add up to is the node's total less
those.  Work and space follow the values a row has, not the number of features.

The rest is MLlib's: split points, bags and feature subsets come from its own
code and seeds, gains and ties follow its rules, and the result is its model.
With more open nodes than ``maxMemoryInMB`` holds, subsets may be drawn in another
order.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage, release

EPSILON = np.finfo(float).eps


@dataclass
class Bins:
    """Bins of all features, numbered one after the other; such a number is a code."""

    thresholds: np.ndarray  # a row per feature, filled up with infinity
    splits: np.ndarray  # split points per feature
    binary: np.ndarray  # features that are categories 0 and 1
    start: np.ndarray = field(init=False)  # a feature's first code
    zero: np.ndarray = field(init=False)  # its code of zero
    feature: np.ndarray = field(init=False)  # the feature of a code

    def __post_init__(self):
        sizes = self.splits + 1
        self.start = (np.cumsum(sizes) - sizes).astype(np.int32)
        self.feature = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.zero = self.codes(np.arange(len(sizes)), np.zeros(len(sizes)))

    def codes(self, features: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Codes of values: a bin holds what is above its lower threshold, up to its upper one."""
        strange = self.binary[features] & (values != 0) & (values != 1)
        if strange.any():
            raise ValueError(f"feature {features[strange][0]} has categories 0 and 1, not {values[strange][0]}")
        below = np.zeros(len(values), np.int32)  # thresholds below the value, found by halves
        step = (self.thresholds.shape[1] + 1) >> 1
        while step:
            below += step * (self.thresholds[features, below + step - 1] < values)
            step >>= 1
        return self.start[features] + below


@dataclass
class Tree:
    """Nodes by number; a leaf is its own child, so a row that is there stays."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)  # codes above it go right, or left where turned
    turned: list[bool] = field(default_factory=list)
    by_zero: list[bool] = field(default_factory=list)  # whether rows without a value of the feature go right
    children: list[tuple[int, int]] = field(default_factory=list)
    level: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    stats: list[np.ndarray | None] = field(default_factory=list)

    def add(self, level: int, stats: np.ndarray | None = None) -> int:
        node = len(self.level)
        columns = (self.feature, self.cut, self.turned, self.by_zero, self.children, self.level, self.gain, self.stats)
        for column, value in zip(columns, (-1, -1, False, False, (node, node), level, 0.0, stats), strict=True):
            column.append(value)
        return node

    def is_leaf(self, node: int) -> bool:
        return self.children[node] == (node, node)


class Walk:
    """A tree as arrays, for tasks."""

    def __init__(self, tree: Tree):
        self.feature, self.cut = np.array(tree.feature, np.int32), np.array(tree.cut, np.int32)
        self.turned, self.by_zero = np.array(tree.turned, bool), np.array(tree.by_zero, bool)
        self.left, self.right = np.array(tree.children, np.int32).T.copy()
        self.depth = max((level + 1 for node, level in enumerate(tree.level) if not tree.is_leaf(node)), default=0)

    def nodes(self, rows: Rows) -> np.ndarray:
        """The node each row comes to."""
        at = np.zeros(rows.n, np.int32)
        for _ in range(self.depth):
            here = at[rows.row]
            asked = np.flatnonzero(self.feature[here] == rows.feature)
            here = here[asked]
            right = self.by_zero[at]
            right[rows.row[asked]] = (rows.codes[asked] > self.cut[here]) ^ self.turned[here]
            at = np.where(right, self.right[at], self.left[at])
        return at


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the binary cells of a column end, and their bytes."""
    _, ends, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return ends - ends[0], held


def _to_cells(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary cells of ``sizes`` numbers each."""
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes * data.itemsize, out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


class Rows:
    """Binned rows of a batch: label, times in each tree's bag, and the row, code and feature of each value."""

    def __init__(self, batch: pa.RecordBatch, feature: np.ndarray):
        ends, data = _cells(batch.column("cell"))
        numbers, ends = data.copy().view("<i4"), ends // 4
        self.n = len(batch)
        self.label = numbers[ends[:-1]].astype(float)
        self.codes = np.delete(numbers, ends[:-1])
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(ends) - 1)
        self.feature = feature[self.codes]
        self.counts = None
        if "counts" in batch.schema.names:
            self.counts = _cells(batch.column("counts"))[1].copy().view(">i4").reshape(self.n, -1).astype(float)


def vector_parts(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of what the vectors of a batch hold, in the order of the rows."""
    values = column.field("values")
    sizes = values.value_lengths().to_numpy(zero_copy_only=False)
    rows, held = np.repeat(np.arange(len(column), dtype=np.int32), sizes), values.flatten().to_numpy(zero_copy_only=False)
    places = (np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
    thin = column.field("type").to_numpy(zero_copy_only=False) == 0
    places[thin[rows]] = column.field("indices").flatten().to_numpy(zero_copy_only=False)
    return rows, places, held


def binned(df: DataFrame, bins: Bins, label: str, features: str) -> DataFrame:
    """A cell per row: its label, then its codes that are not those of zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place, value = vector_parts(batch.column("vector"))
            codes = bins.codes(place, value)
            kept = codes != bins.zero[place]
            sizes = np.bincount(row[kept], minlength=len(batch))
            labels = batch.column("label").to_numpy().astype("<i4")
            numbers = np.insert(codes[kept].astype("<i4"), np.cumsum(sizes) - sizes, labels)
            yield pa.RecordBatch.from_arrays([_to_cells(numbers, sizes + 1)], ["cell"])

    plain = df.select(F.col(label).cast("double").alias("label"), F.unwrap_udt(features).alias("vector"))
    return plain.mapInArrow(run, "cell binary")


def _module(package, name: str):
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def bagged(rows: DataFrame, estimator: Estimator) -> DataFrame:
    """``binned`` rows with ``counts``: how often the bag of each tree holds the row.

    MLlib draws bags by partition and place, so ``rows`` must lie as the training
    rows do.  A bagged point leaves the JVM serialized: the cell, an array of bytes,
    is followed by the counts, an array of integers.
    """
    session, jvm, trees = rows.sparkSession, rows.sparkSession._jvm, estimator.getNumTrees()
    point, encoders = _module(jvm.org.apache.spark.ml.tree.impl, "BaggedPoint"), jvm.org.apache.spark.sql.Encoders
    weight = getattr(point, "convertToBaggedRDD$default$5")()
    cells = getattr(rows._jdf, "as")(encoders.BINARY()).rdd()
    drawn = point.convertToBaggedRDD(cells, float(estimator.getSubsamplingRate()), trees, estimator.getBootstrap(), weight, estimator.getSeed())
    kind = jvm.org.apache.spark.ml.tree.impl.BaggedPoint(None, None, 1.0).getClass()
    sent = DataFrame(session._jsparkSession.createDataset(drawn, encoders.javaSerialization(kind)).toDF(), session)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ends, data = _cells(batch.column(0))
            number = lambda places: data[places[:, None] + np.arange(4)].copy().view(">i4").ravel().astype(np.int64)
            # An array: two marks, the length of its type's name and the name; then version, flags, fields, two marks, length.
            start = ends[:-1] + bytes(data[: ends[1]]).index(b"\x00\x02[B") + 4 + 13
            sizes = number(start)
            after = start + 4 + sizes + 2 + 4 + 13
            if (sizes < 4).any() or (number(after - 17) != int.from_bytes(b"\x00\x02[I")).any() or (number(after) != trees).any():
                raise ValueError("a bagged point has another form than expected")
            cell = data[np.repeat(start + 4 - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
            counts = data[(after + 4)[:, None] + np.arange(4 * trees)].ravel()
            yield pa.RecordBatch.from_arrays([_to_cells(cell, sizes), _to_cells(counts, np.full(len(batch), 4 * trees))], ["cell", "counts"])

    return sent.mapInArrow(run, "cell binary, counts binary")


# What a row adds to the statistics of its node, for a tree: a number per statistic.
Shares = Callable[[Rows, int], list[np.ndarray]]


def class_shares(rows: Rows, tree: int) -> list[np.ndarray]:
    """Times in the bag, by class."""
    times = np.ones(rows.n) if rows.counts is None else rows.counts[:, tree]
    return [times * (rows.label == 0), times * (rows.label == 1)]


def residual_shares(walks: Sequence[Walk], values: Sequence[np.ndarray]) -> Shares:
    """Count, sum and sum of squares of what the trees so far leave of the label."""

    def run(rows: Rows, tree: int) -> list[np.ndarray]:
        label = rows.label * 2 - 1
        left = label
        if walks:
            margin = sum(value[walk.nodes(rows)] for walk, value in zip(walks, values, strict=True))
            left = 4 * label / (1 + np.exp(2 * label * margin))
        return [np.ones(rows.n), left, left * left]

    return run


def _sums(rows: DataFrame, bins: Bins, walks: dict[int, Walk], slots: dict[int, np.ndarray], subsets: np.ndarray | None, shares: Shares, stats: int) -> pa.Table:
    """Sums by slot and code; a slot is a node that is to be split, its total has code -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(bins.feature) + 1
        first = {t: of[of >= 0].min() for t, of in slots.items()}
        held = {t: np.zeros((stats, (of.max() + 1 - first[t]) * width)) for t, of in slots.items()}
        for batch in batches:
            rows = Rows(batch, bins.feature)
            for t, walk in walks.items():
                slot, adds = slots[t][walk.nodes(rows)], shares(rows, t)
                live = slot >= 0
                mine = live[rows.row]
                if subsets is not None:
                    mine &= subsets[slot[rows.row], rows.feature]
                row = rows.row[mine]
                key = (slot[row] - first[t]).astype(np.int64) * width + rows.codes[mine] + 1
                total = (slot[live] - first[t]).astype(np.int64) * width
                for i, add in enumerate(adds):
                    held[t][i] += np.bincount(key, add[row], held[t].shape[1]) + np.bincount(total, add[live], held[t].shape[1])
        for t, sums in held.items():
            at = np.flatnonzero(sums.any(axis=0))
            columns = [(at // width + first[t]).astype(np.int32), (at % width - 1).astype(np.int32), *sums[:, at]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slot", "code", *(f"s{i}" for i in range(stats))])

    names = [f"s{i}" for i in range(stats)]
    parts = rows.mapInArrow(run, "slot int, code int, " + ", ".join(f"{n} double" for n in names))
    # A task has one row of a code; few tasks hold all sums.
    spread = parts.repartition(rows.sparkSession.sparkContext.defaultParallelism, "slot", "code")
    return spread.groupBy("slot", "code").agg(*[F.sum(n).alias(n) for n in names]).toArrow()


def weight_of(stats: np.ndarray) -> np.ndarray:
    """Rows in the statistics: of two classes, or count, sum and sum of squares."""
    return stats[..., 0] + stats[..., 1] if stats.shape[-1] == 2 else stats[..., 0]


def impurity(stats: np.ndarray) -> np.ndarray:
    """Gini impurity of two classes, variance of three moments."""
    n = weight_of(stats)
    some = np.where(n == 0, 1.0, n)
    if stats.shape[-1] == 2:
        a, b = stats[..., 0] / some, stats[..., 1] / some
        out = 1.0 - a * a - b * b
    else:
        out = (stats[..., 2] - stats[..., 1] * stats[..., 1] / some) / some
    return np.where(n == 0, 0.0, out)


def prediction(stats: np.ndarray) -> float:
    if len(stats) == 2:
        return float(np.argmax(stats))
    return float(stats[1] / stats[0]) if stats[0] else 0.0


def best_split(sums: np.ndarray, total: np.ndarray, bins: Bins, features: np.ndarray, least: tuple[float, float, float]):
    """Gain, feature, split point, order of its categories, and statistics of both sides; the first of equal gains.

    ``least`` has the rows and weight a side needs, and the gain.
    """
    found = []
    parent = impurity(total)
    place = np.arange(len(features))
    for size in np.unique(bins.splits[features]):
        if size == 0:
            continue
        of = place[bins.splits[features] == size]
        some, every = features[of], np.arange(len(of))
        cells = sums[bins.start[some][:, None] + np.arange(size + 1)]
        zero = bins.zero[some] - bins.start[some]
        cells[every, zero] = 0
        cells[every, zero] = total - cells.sum(axis=1)
        rank = cells[..., 1] if len(total) == 2 else cells[..., 1] / np.where(cells[..., 0] == 0, 1.0, cells[..., 0])
        rank = np.where(weight_of(cells) == 0, np.inf, rank)
        turned = bins.binary[some] & (rank[:, 1] < rank[:, 0])
        cells[turned] = cells[turned][:, ::-1]
        sides = np.cumsum(cells, axis=1)
        left, right = sides[:, :-1], sides[:, -1:] - sides[:, :-1]
        a, b = weight_of(left), weight_of(right)
        n = np.where(a + b == 0, 1.0, a + b)
        gain = parent - a / n * impurity(left) - b / n * impurity(right)
        if len(total) == 3:  # sums of fractions come in any order: no choice is to follow from their last digits
            unit = 1e-12 * total[2] / total[0] or 1.0
            gain = np.round(gain / unit) * unit
        poor = (np.minimum(a, b) < max(least[0], least[1])) | (gain < least[2])
        gain = np.where(poor, -np.inf, gain)
        best = gain.argmax(axis=1)
        top = gain[every, best]
        i = int(top.argmax())
        found.append((top[i], -of[i], int(some[i]), int(best[i]), bool(turned[i]), left[i, best[i]], right[i, best[i]]))
    if not found:
        return None
    gain, _, *split = max(found, key=lambda x: x[:2])
    return (float(gain), *split) if gain > 0 else None


def _fields(jvm, value) -> list:
    """The fields of what a JVM array holds, in one call."""
    shown = jvm.com.fasterxml.jackson.annotation
    mapper = jvm.com.fasterxml.jackson.databind.ObjectMapper()
    mapper.setVisibility(getattr(shown.PropertyAccessor, "FIELD"), getattr(getattr(shown, "JsonAutoDetect$Visibility"), "ANY"))
    return json.loads(mapper.writeValueAsString(value))


class Plan:
    """What a fit takes over from MLlib: its metadata, split points, and draws of feature subsets."""

    def __init__(self, spark: SparkSession, estimator: Estimator, df: DataFrame, arity: dict[int, int], boosted: bool):
        jvm = spark._jvm
        self.jvm, self.spark, self.java = jvm, spark, estimator._java_obj
        ml = jvm.org.apache.spark.ml
        algo, categories = _module(jvm.org.apache.spark.mllib.tree.configuration, "Algo"), _arity(jvm, df, estimator)
        if boosted:
            strategy = self.java.getOldBoostingStrategy(categories, algo.Classification()).treeStrategy().copy()
            getattr(strategy, "algo_$eq")(algo.Regression())
            getattr(strategy, "impurity_$eq")(_module(jvm.org.apache.spark.mllib.tree.impurity, "Variance"))
        else:
            strategy = self.java.getOldStrategy(categories, 2, algo.Classification(), self.java.getOldImpurity(), 1.0)
        forest = isinstance(estimator, RandomForestClassifier)
        subset = estimator.getFeatureSubsetStrategy() if forest or boosted else "all"
        points = _module(ml.util, "DatasetUtils").extractInstances(self.java, df._jdf, jvm.scala.Some(2))
        of = _module(ml.tree.impl, "DecisionTreeMetadata").buildMetadata(points, strategy, estimator.getNumTrees() if forest else 1, subset)
        splits = _module(ml.tree.impl, "RandomForest").findSplits(points, of, estimator.getSeed())
        self.features, self.depth = of.numFeatures(), of.maxDepth()
        self.drawn = of.numFeaturesPerNode() if of.subsamplingFeatures() else None
        self.least = (of.minInstancesPerNode(), of.minWeightPerNode(), of.minInfoGain())
        self.held = estimator.getMaxMemoryInMB() << 20
        points_of = [[0.5] if f in arity else [p["threshold"] for p in found] for f, found in enumerate(_fields(jvm, splits))]
        counts = np.array([len(points) for points in points_of])
        thresholds = np.full((self.features, max((1 << int(counts.max()).bit_length()) - 1, 1)), np.inf)
        for f, points in enumerate(points_of):
            thresholds[f, : len(points)] = points
        self.bins = Bins(thresholds, counts, np.isin(np.arange(self.features), list(arity)))
        # Looked up once: every step along a package's name is a call to the JVM.
        tree, impurities = ml.tree, jvm.org.apache.spark.mllib.tree.impurity
        self.leaf, self.inner, self.category, self.number = tree.LeafNode, tree.InternalNode, tree.CategoricalSplit, tree.ContinuousSplit
        self.impurity = impurities.VarianceCalculator if boosted else impurities.GiniCalculator
        self.hash_map, self.map = jvm.scala.collection.mutable.HashMap, _module(jvm.scala.collection.immutable, "Map")
        if self.drawn is not None:
            every, self.tag = _module(jvm.scala.collection.immutable, "Range"), _module(jvm.scala.reflect, "ClassTag").Int()
            self.every, self.sampling, self.text = every.apply(0, self.features), jvm.org.apache.spark.util.random.SamplingUtils, jvm.java.util.Arrays

    def subset(self, seed: int) -> np.ndarray:
        """Features of a node, in the order they were drawn."""
        drawn = self.sampling.reservoirSampleAndCount(self.every.iterator(), self.drawn, seed, self.tag)
        return np.array(self.text.toString(drawn._1())[1:-1].split(", "), int)

    def order(self, trees: Iterable[int]) -> list[int]:
        """Trees in the order of MLlib's map, in which it takes up their nodes."""
        held = self.hash_map()
        for t in trees:
            held.put(t, t)
        return [int(k) for k in getattr(self.map, "from")(held).keysIterator().mkString(",").split(",")]

    def numbers(self, values: Sequence[float]):
        out = self.spark.sparkContext._gateway.new_array(self.jvm.double, len(values))
        for i, value in enumerate(values):
            out[i] = float(value)
        return out

    def node(self, tree: Tree, at: int) -> tuple[object, float | None]:
        """The tree below a node as MLlib's, and what it predicts if it is a leaf; leaves of one parent that predict the same become one."""
        stats = tree.stats[at]
        told = prediction(stats)
        known = told, float(impurity(stats)), self.impurity(self.numbers(stats), int(weight_of(stats)))
        if tree.is_leaf(at):
            return self.leaf(*known), told
        (left, a), (right, b) = (self.node(tree, child) for child in tree.children[at])
        if a is not None and a == b:
            return self.leaf(*known), told
        feature = tree.feature[at]
        if self.bins.binary[feature]:
            split = self.category(feature, self.numbers([tree.turned[at]]), 2)
        else:
            split = self.number(feature, float(self.bins.thresholds[feature, tree.cut[at] - self.bins.start[feature]]))
        return self.inner(*known[:2], tree.gain[at], left, right, split, known[2]), None


def grow(rows: DataFrame, plan: Plan, trees: int, shares: Shares, stats: int, seed: int) -> list[Tree]:
    """Trees level by level: a pass over the rows sums up as many open nodes as ``maxMemoryInMB`` holds."""
    bins, forest = plan.bins, [Tree() for _ in range(trees)]
    random = plan.jvm.java.util.Random(seed)
    most = max(1, plan.held // ((len(bins.feature) + 1) * stats * 8))
    waiting = [(t, tree.add(0)) for t, tree in enumerate(forest)]
    while waiting:
        # The last one goes first, as in MLlib, whose draws follow that order.
        group: dict[int, list[int]] = {}
        subsets: dict[tuple[int, int], np.ndarray] = {}
        while waiting and sum(map(len, group.values())) < most:
            t, node = waiting.pop()
            group.setdefault(t, []).append(node)
            if plan.drawn is not None:
                subsets[t, node] = plan.subset(random.nextLong())
        order = [(t, node) for t in plan.order(group) for node in group[t]]
        slots = {t: np.full(len(forest[t].level), -1, np.int32) for t in group}
        allowed = np.zeros((len(order), plan.features), bool) if subsets else None
        for slot, (t, node) in enumerate(order):
            slots[t][node] = slot
            if subsets:
                allowed[slot, subsets[t, node]] = True
        found = _sums(rows, bins, {t: Walk(forest[t]) for t in group}, slots, allowed, shares, stats)
        slot, code = found["slot"].to_numpy(), found["code"].to_numpy()
        sums = np.zeros((len(order), len(bins.feature) + 1, stats))
        sums[slot, code + 1] = np.stack([found[f"s{i}"].to_numpy() for i in range(stats)], axis=1)
        for i, (t, node) in enumerate(order):
            tree = forest[t]
            if tree.stats[node] is None:
                tree.stats[node] = sums[i, 0]
            split = best_split(sums[i, 1:], tree.stats[node], bins, subsets.get((t, node), np.arange(plan.features)), plan.least)
            if split is None or tree.level[node] == plan.depth:
                continue
            gain, feature, cut, turned, *sides = split
            tree.gain[node], tree.feature[node], tree.turned[node] = gain, feature, turned
            tree.cut[node] = int(bins.start[feature]) + cut
            tree.by_zero[node] = bool(bins.zero[feature] > tree.cut[node]) ^ turned
            level = tree.level[node] + 1
            tree.children[node] = tuple(tree.add(level, side) for side in sides)
            for child, side in zip(tree.children[node], sides, strict=True):
                if level < plan.depth and abs(impurity(side)) >= EPSILON:
                    waiting.append((t, child))
    return forest


def _arity(jvm, df: DataFrame, estimator: Estimator):
    field = df._jdf.schema().apply(estimator.getFeaturesCol())
    return _module(jvm.org.apache.spark.ml.util, "MetadataUtils").getCategoricalFeatures(field)


def _fits(estimator: Estimator, df: DataFrame, arity: dict[int, int]) -> bool:
    """Whether the fit is of the kind below: two classes, unweighted rows, categories 0 and 1."""
    if type(estimator) not in (DecisionTreeClassifier, GBTClassifier, RandomForestClassifier) or estimator.isDefined("weightCol"):
        return False
    if isinstance(estimator, GBTClassifier):
        plain = not estimator.isDefined("validationIndicatorCol") and estimator.getSubsamplingRate() == 1
    else:
        found = df.agg(F.max(estimator.getLabelCol())).first()[0]
        plain = estimator.getImpurity() == "gini" and found == 1
    return plain and set(arity.values()) <= {2}


def fit_sparse(estimator: Estimator, df: DataFrame) -> Model:
    """``estimator.fit(df)``; trees do not unfold sparse rows to their full width."""
    spark = df.sparkSession
    if type(estimator) not in (DecisionTreeClassifier, GBTClassifier, RandomForestClassifier):
        return estimator.fit(df)
    estimator._transfer_params_to_java()
    categories = _arity(spark._jvm, df, estimator).iterator()
    arity = {}
    while categories.hasNext():
        pair = categories.next()
        arity[int(pair._1())] = int(pair._2())
    if not _fits(estimator, df, arity):
        return estimator.fit(df)
    boosted, many = isinstance(estimator, GBTClassifier), isinstance(estimator, RandomForestClassifier)
    plan = Plan(spark, estimator, df, arity, boosted)
    rows = binned(df, plan.bins, estimator.getLabelCol(), estimator.getFeaturesCol())
    if many and (estimator.getBootstrap() or estimator.getSubsamplingRate() < 1):
        rows = bagged(rows, estimator)
    rows = cut_lineage(rows)
    gateway, ml, uid = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml, estimator.uid
    if boosted:
        rate, forest, walks, values = estimator.getStepSize(), [], [], []
        for i in range(estimator.getMaxIter()):
            forest += grow(rows, plan, 1, residual_shares(walks, values), 3, estimator.getSeed() + i)
            walks.append(Walk(forest[-1]))
            values.append(np.array([prediction(s) for s in forest[-1].stats]) * (rate if i else 1.0))
        trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(forest))
        weights = gateway.new_array(spark._jvm.double, len(forest))
        for i, tree in enumerate(forest):
            trees[i], weights[i] = ml.regression.DecisionTreeRegressionModel(plan.node(tree, 0)[0], plan.features), rate if i else 1.0
        java = ml.classification.GBTClassificationModel(uid, trees, weights, plan.features, 2)
    else:
        forest = grow(rows, plan, estimator.getNumTrees() if many else 1, class_shares, 2, estimator.getSeed())
        if many:
            trees = gateway.new_array(ml.classification.DecisionTreeClassificationModel, len(forest))
            for i, tree in enumerate(forest):
                trees[i] = ml.classification.DecisionTreeClassificationModel(plan.node(tree, 0)[0], plan.features, 2)
            java = ml.classification.RandomForestClassificationModel(uid, trees, plan.features, 2)
        else:
            java = ml.classification.DecisionTreeClassificationModel(uid, plan.node(forest[0], 0)[0], plan.features, 2)
    release(rows)
    return estimator._copyValues(estimator._create_model(java))
