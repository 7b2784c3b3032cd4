"""MLlib's random forest with its passes over the rows counted by numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark import StorageLevel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.session import scratch, staged_path

# So many rows are counted at a time: their arrays stay in a core's cache.
CHUNK_ROWS = 32_768
# So many rows are stored as one value, which spares reading them one by one.
STORED_ROWS = 16


class ForestRegressor(RandomForestRegressor):
    """MLlib's forest of the same parameters, tree for tree, for large tables.

    Bins, samples and the model are MLlib's own; the nodes of a pass, their features and splits are chosen here by
    MLlib's rules and numbers. The passes over the rows are another: MLlib takes a row through all trees before the next
    one, which reads another part of a few MB for every tree, and keeps an int for every row and tree. Here a chunk of rows
    goes through one tree at a time, in columns, and the binned rows are stored once, with a byte for every tree.
    Weighted rows and samples without replacement are left to MLlib. Sums are added in another order than MLlib's, which
    is not fixed either: of two splits that gain the same but for rounding, the other one may be taken.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        if not self.getBootstrap() or (self.isDefined(self.weightCol) and self.getWeightCol()):
            return super()._fit(dataset)
        self._transfer_params_to_java()
        kept = dataset.storageLevel.useDisk or dataset.storageLevel.useMemory
        rows = dataset if kept else dataset.persist(StorageLevel.DISK_ONLY)
        try:
            with scratch(dataset.sparkSession):
                return self._copyValues(_Training(self, rows).model())
        finally:
            if not kept:
                rows.unpersist()


class ForestModel(RandomForestRegressionModel):
    """MLlib's model, with its trees at hand for predictions in columns."""

    def __init__(self, java: JavaObject, layout: _Layout, plans: list[_Plan]) -> None:
        super().__init__(java)
        self._layout, self._plans = layout, plans

    def predictions(self, rows: DataFrame, label: str) -> DataFrame:
        """The predictions that ``transform`` makes, beside the label alone."""
        features = vector_to_array(self.getFeaturesCol()).alias("features")
        asked = rows.select(F.col(label).cast("double").alias("label"), features)
        layout, plans = self._layout, self._plans
        found = asked.mapInArrow(lambda batches: _predict(batches, layout, plans), "label double, prediction double")
        return found.withColumnRenamed("label", label)


# ----------------------------------------------------------------- on the driver


@dataclass
class _Node:
    """A node as MLlib numbers it: children are twice its number and one more. ``sums`` are ``[weight, label, square]``."""

    sums: np.ndarray | None = None
    gain: float = 0.0
    valid: bool = True
    split: tuple[int, int | list[int]] | None = None
    left: np.ndarray | None = None


class _Training:
    """One run of MLlib's training loop. Its bins, its metadata and the model are MLlib's own objects."""

    def __init__(self, forest: ForestRegressor, rows: DataFrame) -> None:
        self.spark, self.rows, self.forest = rows.sparkSession, rows, forest
        self.jvm = jvm = self.spark.sparkContext._jvm
        java = self.java = forest._java_obj
        self.impl = _module(jvm, "org.apache.spark.ml.tree.impl.RandomForest")
        self.seed, self.trees = forest.getSeed(), forest.getNumTrees()
        field = rows._jdf.schema().apply(forest.getFeaturesCol())
        categories = _module(jvm, "org.apache.spark.ml.util.MetadataUtils").getCategoricalFeatures(field)
        algo = _module(jvm, "org.apache.spark.mllib.tree.configuration.Algo").Regression()
        strategy = java.getOldStrategy(categories, 0, algo, java.getOldImpurity())
        data = _module(jvm, "org.apache.spark.ml.util.DatasetUtils")
        instances = data.extractInstances(java, rows._jdf, _module(jvm, "scala.None"))
        self.partitions = instances.getNumPartitions()
        build = _module(jvm, "org.apache.spark.ml.tree.impl.DecisionTreeMetadata").buildMetadata
        known = self.metadata = build(instances, strategy, self.trees, forest.getFeatureSubsetStrategy())
        self.splits = [list(found) for found in self.impl.findSplits(instances, known, self.seed)]
        self.bins = list(known.numBins())
        every = range(len(self.bins))
        self.continuous = [known.isContinuous(f) for f in every]
        found = [[s.threshold() for s in self.splits[f]] if self.continuous[f] else None for f in every]
        self.thresholds = [None if values is None else np.array(values) for values in found]
        self.numbers_of_splits = [known.numSplits(f) for f in every]
        self.chosen_features = known.numFeaturesPerNode() if known.subsamplingFeatures() else None
        self.deepest, self.most_bytes = known.maxDepth(), strategy.maxMemoryInMB() * 1024 * 1024
        self.least = known.minInstancesPerNode(), known.minWeightPerNode(), known.minInfoGain()
        self.layout = _Layout(self.trees, self.thresholds, max(self.bins) + 1)

    def model(self) -> ForestModel:
        stored = self._stored()
        random = _Random(self.seed)
        grown: list[dict[int, _Node]] = [{1: _Node()} for _ in range(self.trees)]
        stack = [(tree, 1) for tree in range(self.trees)]
        while stack:
            pending = self._group(stack, random)
            plans = [_plan(tree, grown[tree], nodes, self.bins) for tree, nodes in pending.items()]
            counts = _counted(stored, self.layout, plans)
            cells = {plan.tree: plan.cells for plan in plans}
            for tree in self._order(list(pending)):
                for number, features in pending[tree].items():
                    start, end = cells[tree][number]
                    stack += [(tree, n) for n in self._grow(grown[tree], number, features, counts[tree][:, start:end])]
        walks = [_plan(tree, nodes, {}, self.bins) for tree, nodes in enumerate(grown)]
        return ForestModel(self._built(grown), self.layout, walks)

    # ------------------------------------------------------------ rows

    def _stored(self) -> DataFrame:
        """Of each row, the label, the bin of each feature and how often each tree draws it, as bytes."""
        path = staged_path(self.spark, "forest-rows")
        label = F.col(self.forest.getLabelCol()).cast("double").alias("label")
        features = vector_to_array(self.forest.getFeaturesCol()).alias("features")
        read = self.rows.select(label, features, self._draws().alias("draws"))
        layout = self.layout
        read.mapInArrow(lambda batches: _pack(batches, layout), "rows binary").write.parquet(path)
        return self.spark.read.schema("rows binary").parquet(path)

    def _draws(self) -> Column:
        """How often each tree draws a row, as a text with a character for each, whose code is the number.

        The numbers are MLlib's, from its generator for the row's partition; each task has its own copy of the generators.
        A mean of 1 at most leaves no numbers above 127, which would take two bytes.
        """
        jvm, catalyst = self.jvm, self.jvm.org.apache.spark.sql.catalyst.expressions
        kinds, named = jvm.org.apache.spark.sql.types, jvm.java.lang.Class.forName
        poisson = jvm.org.apache.commons.math3.distribution.PoissonDistribution
        generators = jvm.java.util.ArrayList()
        for partition in range(self.partitions):
            generator = poisson(float(self.forest.getSubsamplingRate()))
            generator.reseedRandomGenerator(self.seed + partition + 1)
            generators.add(generator)

        def seq(*found: JavaObject) -> JavaObject:
            listed = jvm.java.util.ArrayList()
            for one in found:
                listed.add(one)
            return jvm.org.apache.spark.api.python.PythonUtils.toSeq(listed)

        def invoke(on: JavaObject, method: str, kind: JavaObject, argument: JavaObject) -> JavaObject:
            return catalyst.objects.Invoke(on, method, kind, seq(argument), seq(), False, False, False)

        integer = _module(jvm, "org.apache.spark.sql.types.IntegerType")
        every = catalyst.Literal(generators, kinds.ObjectType(named("java.util.ArrayList")))
        kind = kinds.ObjectType(named("org.apache.commons.math3.distribution.PoissonDistribution"))
        own = invoke(every, "get", kind, catalyst.SparkPartitionID())
        drawn = invoke(own, "sample", kinds.ObjectType(named("[I")), catalyst.Literal(self.trees, integer))
        text, none = named("java.lang.String"), _module(jvm, "scala.None")
        ends = catalyst.Literal(0, integer), catalyst.Literal(self.trees, integer)
        letters = catalyst.objects.NewInstance(text, seq(drawn, *ends), seq(), False, kinds.ObjectType(text), none)
        kept = named("org.apache.spark.unsafe.types.UTF8String")
        kind = _module(jvm, "org.apache.spark.sql.types.StringType")
        found = catalyst.objects.StaticInvoke(
            kept, kind, "fromString", seq(letters), seq(), False, False, False, none
        )
        return Column(_module(jvm, "org.apache.spark.sql.classic.ExpressionUtils").column(found))

    # ----------------------------------------------------------- nodes

    def _group(self, stack: list[tuple[int, int]], random: _Random) -> dict[int, dict[int, list[int]]]:
        """The nodes of the next pass and their features: from the top of the stack, as many as MLlib's memory holds."""
        chosen: dict[int, dict[int, list[int]]] = {}
        used = 0
        while stack:
            tree, number = stack[-1]
            n = len(self.bins)
            features = list(range(n))
            if self.chosen_features is not None:
                features = random.reservoir(n, self.chosen_features)
            size = 3 * sum(self.bins[f] for f in features) * 8
            if used and used + size > self.most_bytes:
                break
            stack.pop()
            chosen.setdefault(tree, {})[number] = features
            used += size
        return chosen

    def _order(self, trees: list[int]) -> list[int]:
        """The trees in the order that MLlib grows them in, that of its map: it decides what the next nodes draw."""
        scala = self.jvm.scala
        stack, pair = scala.collection.mutable.ListBuffer(), scala.Tuple2
        node = self.jvm.org.apache.spark.ml.tree.LearningNode.emptyNode(1)
        for tree in trees:
            stack.append(pair(tree, node))
        found = self.impl.selectNodesToSplit(stack, 2**62, self.metadata, scala.util.Random())
        return [int(tree) for tree in found._1().keysIterator().mkString(" ").split()]

    def _grow(self, tree: dict[int, _Node], number: int, features: list[int], counts: np.ndarray) -> list[int]:
        """Split a node if that gains; the children to be split in turn, the last one first."""
        node, level = tree[number], number.bit_length() - 1
        best, start = None, 0
        for f in features:
            cells = counts[:, start : start + self.bins[f]]
            start += self.bins[f]
            if not self.numbers_of_splits[f]:
                continue
            order = np.arange(cells.shape[1])
            if not self.continuous[f]:
                with np.errstate(divide="ignore", invalid="ignore"):
                    centre = np.where(cells[0] != 0, cells[1] / cells[0], np.finfo(float).max)
                order = np.argsort(centre, kind="stable")
            sums = np.cumsum(cells[:, order], axis=1)
            lefts = sums[:, :-1]
            rights = sums[:, -1:] - lefts
            if node.sums is None:
                node.sums = lefts[:, 0] + rights[:, 0]
            gains = self._gains(node.sums, lefts, rights)
            at = int(np.argmax(gains))
            if best is None or gains[at] > best[0]:
                best = gains[at], f, at, order, lefts[:, at], rights[:, at]
        if best is None:  # no feature has two values
            node.sums = counts[:, : self.bins[features[0]]].sum(axis=1) if node.sums is None else node.sums
        node.valid = best is not None and np.isfinite(best[0])
        if best is None or best[0] <= 0 or level == self.deepest:
            return []
        node.gain, f, at, order, left, right = best
        node.left = np.zeros(self.layout.most, bool)
        node.left[order[: at + 1]] = True
        node.split = f, at if self.continuous[f] else [int(c) for c in order[: at + 1]]
        below = []
        for child, sums in ((2 * number, left), (2 * number + 1, right)):
            tree[child] = _Node(sums.copy())
            if level + 1 < self.deepest and abs(_variance(sums)) >= 2.0**-52:
                below.append(child)
        return below

    def _gains(self, parent: np.ndarray, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """What each split gains, by MLlib's order of operations; minus infinity where one is not allowed."""
        rows, weight, gain = self.least
        least = max(rows, weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            total = lefts[0] + rights[0]
            gains = _variance(parent) - lefts[0] / total * _variance(lefts) - rights[0] / total * _variance(rights)
            allowed = (lefts[0] >= least) & (rights[0] >= least) & ~(gains < gain)
        return np.where(allowed, gains, -np.inf)

    # ----------------------------------------------------------- model

    def _built(self, grown: list[dict[int, _Node]]) -> JavaObject:
        jvm, context = self.jvm, self.spark.sparkContext
        regression, parameters = jvm.org.apache.spark.ml.regression, jvm.org.apache.spark.ml.param.ParamMap()
        tree = jvm.org.apache.spark.ml.tree
        leaf, inner, categorical = tree.LeafNode, tree.InternalNode, tree.CategoricalSplit
        calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        copy = jvm.java.util.Arrays.copyOfRange
        one = regression.DecisionTreeRegressionModel
        fitted = context._gateway.new_array(one, self.trees)
        for at, nodes in enumerate(grown):
            # the sums and categories go over at once, each node takes its part
            parts = [n.sums for n in nodes.values()]
            chosen = [n for n, node in nodes.items() if node.split and not self.continuous[node.split[0]]]
            parts += [np.array(nodes[n].split[1], float) for n in chosen]
            ends = iter(np.cumsum([len(p) for p in parts]).tolist())
            values = _py2java(context, DenseVector(np.concatenate(parts))).values()
            place = {number: (end - 3, end) for number, end in zip(nodes, ends)}
            left = {n: (end - len(nodes[n].split[1]), end) for n, end in zip(chosen, ends)}
            made: dict[int, tuple[JavaObject, float | None]] = {}
            for number in sorted(nodes, reverse=True):
                node = nodes[number]
                weight, label, _ = node.sums
                prediction = float(label / weight) if weight else 0.0
                statistics = calculator(copy(values, *place[number]), int(weight))
                impurity = float(_variance(node.sums))
                if node.split is None:
                    made[number] = leaf(prediction, impurity if node.valid else -1.0, statistics), prediction
                    continue
                (low, low_leaf), (high, high_leaf) = made[2 * number], made[2 * number + 1]
                if low_leaf is not None and low_leaf == high_leaf:
                    made[number] = leaf(low_leaf, impurity, statistics), low_leaf
                    continue
                f, found = node.split
                if self.continuous[f]:
                    split = self.splits[f][found]
                else:
                    split = categorical(f, copy(values, *left[number]), self.bins[f])
                made[number] = inner(prediction, impurity, float(node.gain), low, high, split, statistics), None
            fitted[at] = self.java.copyValues(one(made[1][0], len(self.bins)), parameters)
        whole = regression.RandomForestRegressionModel(self.java.uid(), fitted, len(self.bins))
        return self.java.copyValues(whole.setParent(self.java), parameters)


def _module(jvm: JavaObject, name: str) -> JavaObject:
    """The one instance of a Scala object."""
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return jvm.java.lang.Class.forName(f"{name}$", True, loader).getField("MODULE$").get(None)


def _variance(sums: np.ndarray) -> np.ndarray:
    weight, label, square = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight == 0, 0.0, (square - label * label / weight) / weight)


def _plan(tree: int, nodes: dict[int, _Node], pending: dict[int, list[int]], bins: list[int]) -> _Plan:
    place = {number: i for i, number in enumerate(nodes)}
    most, width = max(bins) + 1, max(map(len, pending.values()), default=0)
    feature = np.zeros(len(place), np.int64)
    below = np.repeat(np.arange(len(place))[:, None], most, axis=1)
    for number, node in nodes.items():
        if node.split:
            feature[place[number]] = node.split[0]
            below[place[number]] = np.where(node.left, place[2 * number], place[2 * number + 1])
    size = sum(bins[f] for features in pending.values() for f in features)
    asked, base = np.zeros((width, len(place)), np.int64), np.full((width, len(place)), size)
    cells, done = {}, 0
    for number, features in pending.items():
        start = done
        for i, f in enumerate(features):
            asked[i, place[number]], base[i, place[number]] = f, done
            done += bins[f]
        cells[number] = start, done
    known = [np.zeros(3) if node.sums is None else node.sums for node in nodes.values()]
    values = np.array([label / weight if weight else 0.0 for weight, label, _ in known])
    return _Plan(tree, max(nodes).bit_length() - 1, feature, below, values, asked, base, size, cells)


class _Random:
    """``scala.util.Random``, as far as MLlib draws the features of nodes with it."""

    def __init__(self, seed: int) -> None:
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _word(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        return self.state >> 16

    def reservoir(self, n: int, most: int) -> list[int]:
        """``SamplingUtils.reservoirSampleAndCount`` of ``range(n)``, seeded with the next number."""
        high, low = self._word(), self._word()
        low -= (low >> 31) << 32
        seed = _hashed((high << 32) + low)
        kept = list(range(min(n, most)))
        for i in range(most, n):
            parts = []
            for bits in (26, 27):
                seed ^= seed << 21 & (1 << 64) - 1
                seed ^= seed >> 35
                seed ^= seed << 4 & (1 << 64) - 1
                parts.append(seed & (1 << bits) - 1)
            place = int(((parts[0] << 27) + parts[1]) * 2.0**-53 * (i + 1))
            if place < most:
                kept[place] = i
        return kept


def _hashed(seed: int) -> int:
    """``XORShiftRandom.hashSeed``: MurmurHash3 of the seed's bytes, twice."""
    full = (1 << 32) - 1
    data = (seed & (1 << 64) - 1).to_bytes(8, "big")

    def turned(k: int, by: int) -> int:
        return (k << by | k >> 32 - by) & full

    def murmur(h: int) -> int:
        for i in (0, 4):
            k = turned(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & full, 15) * 0x1B873593 & full
            h = (turned(h ^ k, 13) * 5 + 0xE6546B64) & full
        h ^= 8
        h = (h ^ h >> 16) * 0x85EBCA6B & full
        h = (h ^ h >> 13) * 0xC2B2AE35 & full
        return h ^ h >> 16

    low = murmur(0x3C074A61)
    return murmur(low) << 32 | low


# --------------------------------------------------------------- on the executors


@dataclass
class _Layout:
    """How rows are binned and stored: the trees, the thresholds of each feature (None for categories), one more than
    the most bins. Categories that were not seen share the last one and go right."""

    trees: int
    thresholds: list[np.ndarray | None]
    most: int

    @property
    def kind(self) -> str:
        return "u1" if self.most <= 256 else "u4"

    def binned(self, batch: pa.RecordBatch) -> np.ndarray:
        features = np.asarray(batch.column("features").flatten()).reshape(batch.num_rows, len(self.thresholds))
        bins = np.empty(features.shape, self.kind)
        for f, found in enumerate(self.thresholds):
            values = features[:, f]
            bins[:, f] = np.minimum(values, self.most - 1) if found is None else np.searchsorted(found, values)
        return bins

    def parts(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Labels, bins row by row, and draws tree by tree."""
        drawn = rows.shape[1] - self.trees
        labels = np.ascontiguousarray(rows[:, :8]).view("f8")[:, 0]
        bins = np.ascontiguousarray(rows[:, 8:drawn]).view(self.kind).ravel()
        return labels, bins, np.ascontiguousarray(rows[:, drawn:].T)


@dataclass
class _Plan:
    """A tree's nodes for one pass: where a row goes from each, and where a row that ends in it is counted.

    ``below`` holds the next node for each node and bin, the node itself where rows end. ``asked`` and ``base`` hold,
    for each counted feature of a node, the feature and its first cell, ``cells`` a node's first cell and the one after
    its last.
    """

    tree: int
    depth: int
    feature: np.ndarray
    below: np.ndarray
    values: np.ndarray
    asked: np.ndarray
    base: np.ndarray
    size: int
    cells: dict[int, tuple[int, int]]

    def walk(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """The nodes that rows end in, given the place of each row's first bin.

        A node is known by its first place in ``below``, so that adding a bin leads to the next one.
        """
        most = self.below.shape[1]
        below, feature = (self.below * most).ravel(), np.repeat(self.feature, most)

        def ends(rows: np.ndarray, bins: np.ndarray) -> np.ndarray:
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = feature.take(node, mode="clip")
                at += rows
                node += bins.take(at, mode="clip")
                node = below.take(node, mode="clip")
            return node

        return ends

    def counter(self, features: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """Weights, labels and their squares summed by cell, for a chunk's labels, bins and draws."""
        most, walk = self.below.shape[1], self.walk()
        asked, base = np.repeat(self.asked, most, axis=1), np.repeat(self.base, most, axis=1)
        cells = self.size + most  # the last ones take rows that are counted nowhere

        def count(labels: np.ndarray, bins: np.ndarray, draws: np.ndarray) -> np.ndarray:
            rows = np.flatnonzero(draws != 0)
            weights = draws.take(rows, mode="clip").astype(np.float64)
            summed = labels.take(rows, mode="clip")
            squared = weights * summed
            summed, squared = squared, squared * summed
            rows *= features
            node = walk(rows, bins)
            found = np.zeros((3, cells))
            for f, first in zip(asked, base):
                at = f.take(node, mode="clip")
                at += rows
                cell = first.take(node, mode="clip")
                cell += bins.take(at, mode="clip")
                found[0] += np.bincount(cell, weights, cells)
                found[1] += np.bincount(cell, summed, cells)
                found[2] += np.bincount(cell, squared, cells)
            return found[:, : self.size]

        return count


def _bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a column of binary values or texts."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    kind = np.dtype("i8" if wide else "i4")
    ends = np.frombuffer(ends, kind, len(column) + 1, column.offset * kind.itemsize)
    return np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0])


def _pack(batches: Iterable[pa.RecordBatch], layout: _Layout) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        labels = np.array(batch.column("label")).reshape(n, 1)
        draws = _bytes(batch.column("draws")).reshape(n, layout.trees)
        rows = np.hstack([labels.view(np.uint8), layout.binned(batch).view(np.uint8), draws])
        ends = np.append(np.arange(0, n, STORED_ROWS), n) * rows.shape[1]
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows)]
        yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)], ["rows"])


def _count(batches: Iterable[pa.RecordBatch], layout: _Layout, plans: list[_Plan]) -> Iterator[pa.RecordBatch]:
    """A task's sums for every tree."""
    features = len(layout.thresholds)
    width = 8 + features * np.dtype(layout.kind).itemsize + layout.trees
    counters = [plan.counter(features) for plan in plans]
    totals = [np.zeros((3, plan.size)) for plan in plans]
    for batch in batches:
        rows = _bytes(batch.column(0)).reshape(-1, width) if batch.num_rows else np.empty((0, width), np.uint8)
        for start in range(0, len(rows), CHUNK_ROWS):
            labels, bins, draws = layout.parts(rows[start : start + CHUNK_ROWS])
            for plan, counter, total in zip(plans, counters, totals):
                total += counter(labels, bins, draws[plan.tree])
    yield from _sums({plan.tree: total for plan, total in zip(plans, totals)})


def _predict(batches: Iterable[pa.RecordBatch], layout: _Layout, plans: list[_Plan]) -> Iterator[pa.RecordBatch]:
    trees = [(plan.walk(), np.repeat(plan.values, plan.below.shape[1])) for plan in plans]
    for batch in batches:
        bins = layout.binned(batch)
        rows = np.arange(len(bins)) * bins.shape[1]
        total = np.zeros(len(bins))
        for walk, values in trees:
            total += values.take(walk(rows, bins.ravel()), mode="clip")
        columns = [batch.column("label"), pa.array(total / len(trees))]
        yield pa.RecordBatch.from_arrays(columns, ["label", "prediction"])


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one tree added up."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for tree, sums in zip(batch.column("tree").to_pylist(), batch.column("sums")):
            found = np.frombuffer(sums.as_buffer(), np.float64)
            totals[tree] = totals[tree] + found if tree in totals else found.copy()
    yield from _sums(totals)


def _sums(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for tree, found in totals.items():
        columns = [pa.array([tree], pa.int32()), pa.array([found.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["tree", "sums"])


def _counted(stored: DataFrame, layout: _Layout, plans: list[_Plan]) -> dict[int, np.ndarray]:
    """The sums of all rows by tree: added up by tree before they come to the driver."""
    schema = "tree int, sums binary"
    parts = stored.mapInArrow(lambda batches: _count(batches, layout, plans), schema)
    summed = parts.repartition("tree").mapInArrow(_add, schema).collect()
    return {r["tree"]: np.frombuffer(bytes(r["sums"]), np.float64).reshape(3, -1) for r in summed}
