"""Gradient boosting over packed rows, for histories that executors cannot hold as objects.

Spark's own trainer keeps every row as objects of some 230 bytes (by their fields) and goes over them once per tree and
level; rows that do not fit are written out and parsed again each time. Here a row is one byte a feature (the number of
its bin), a sign and a score, in blocks that numpy adds up. A pass streams the blocks, so a task holds one block and the
sums of one level, whatever the length of the history, and the driver gets a bounded number of such sums.

The trees are those of ``GBTClassifier`` but for rounding: Spark finds the thresholds, and gains, ties and leaves follow
its rules.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame

from tickloom.session import remove, stored_at

BLOCK = 131_072
# trees after which the scores are stored, so that a lost executor costs a few trees at most
STORED_EVERY = 10
# sums that reach the driver in a pass; those of more tasks meet in groups before
TO_DRIVER = 64
PACKED = "part int, block int, codes binary, sign binary, score binary"
# Spark takes a node of less impurity as pure
PURE = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Points:
    """Packed training rows: ``table`` has a row a block, ``path`` is where it is stored."""

    table: DataFrame
    path: str
    thresholds: list[np.ndarray]
    bits: int


@dataclass
class Node:
    """Count, sum and sum of squares of the targets; ``impurity`` is -1 where no split of a node was allowed."""

    sums: np.ndarray
    impurity: float
    gain: float = 0.0
    feature: int = -1
    cut: int = -1

    @property
    def value(self) -> float:
        return float(self.sums[1] / self.sums[0]) if self.sums[0] else 0.0


@dataclass
class Tree:
    """Nodes by number: 1 is the root, 2k and 2k + 1 are the children of k."""

    nodes: dict[int, Node] = field(default_factory=dict)
    splits: list[dict[int, tuple[int, int]]] = field(default_factory=list)

    def is_leaf(self, k: int) -> bool:
        return 2 * k not in self.nodes


def _impurity(sums: np.ndarray) -> np.ndarray:
    """Variance from (count, sum, sum of squares) along the first axis."""
    count, total, squares = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - total * total / count) / count)


def best_split(sums: np.ndarray, sizes: list[int], parent: Node | None) -> tuple[Node, Node | None, Node | None]:
    """The node with its best split, and its children; sums [3, feature, bin], sizes = thresholds per feature."""
    upto = np.cumsum(sums, axis=2)
    left = upto[:, :, :-1]
    right = upto[:, :, -1:] - left
    allowed = np.arange(left.shape[2])[None, :] < np.asarray(sizes)[:, None]
    if parent is None:
        first = next((f for f, n in enumerate(sizes) if n), 0)
        both = left[:, first, 0] + right[:, first, 0]
        parent = Node(both, float(_impurity(both)))
    with np.errstate(divide="ignore", invalid="ignore"):
        count = left[0] + right[0]
        gain = parent.impurity - left[0] / count * _impurity(left) - right[0] / count * _impurity(right)
    gain = np.where(allowed & (left[0] >= 1) & (right[0] >= 1) & (gain >= 0), gain, -np.inf)
    feature, cut = (int(i) for i in np.unravel_index(np.argmax(gain), gain.shape))
    best = float(gain[feature, cut])
    if best == -np.inf:
        return Node(parent.sums, -1.0), None, None
    if best <= 0:
        return Node(parent.sums, parent.impurity), None, None
    a, b = left[:, feature, cut].copy(), right[:, feature, cut].copy()
    node = Node(parent.sums, parent.impurity, best, feature, cut)
    return node, Node(a, float(_impurity(a))), Node(b, float(_impurity(b)))


def bin_of(codes: np.ndarray, feature: int, bits: int) -> np.ndarray:
    """The bins of a feature; codes [pair of features, row] hold an even feature in the upper bits, an odd one below."""
    return codes[feature // 2] & ((1 << bits) - 1) if feature % 2 else codes[feature // 2] >> bits


def _walk(codes: np.ndarray, splits: list[dict[int, tuple[int, int]]], bits: int) -> np.ndarray:
    """The node of every row."""
    node = np.ones(codes.shape[1], dtype=np.min_scalar_type(2 ** (len(splits) + 1)))
    for level in splits:
        moved = np.zeros_like(node)
        for k, (feature, cut) in level.items():
            # a row of node k goes on to 2k or 2k + 1
            moved += (node == k) * ((bin_of(codes, feature, bits) > cut) + node.dtype.type(k))
        node += moved
    return node


def bits_for(thresholds: list[np.ndarray]) -> int:
    """Bits of a bin number; two must fit the 16 of a code."""
    bits = max(1, *(len(t) for t in thresholds)).bit_length()
    if bits > 8:
        raise ValueError("more than 256 bins a feature")
    return bits


def pack(rows: DataFrame, names: list[str], label: str, thresholds: list[np.ndarray]) -> DataFrame:
    """Blocks of bin numbers (bin k holds values above threshold k - 1, up to threshold k), in the order of the rows."""
    bits, most = bits_for(thresholds), BLOCK

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, waiting = TaskContext.get().partitionId(), 0, 0, []

        def made() -> pa.RecordBatch:
            codes, sign = (np.concatenate(x, axis=-1) for x in zip(*waiting, strict=True))
            cells = (part, block, codes.tobytes(), sign.tobytes(), np.zeros(len(sign)).tobytes())
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array([c], k) for c, k in zip(cells, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["part", "block", "codes", "sign", "score"])

        for batch in batches:
            values = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            bins = [np.searchsorted(t, v).astype(np.uint16) for t, v in zip(thresholds, values, strict=True)]
            lower = bins[1::2] + [np.uint16(0)] * (len(bins) % 2)
            codes = np.stack([(a << bits) | b for a, b in zip(bins[::2], lower, strict=True)])
            sign = (batch.column(label).to_numpy(zero_copy_only=False) * 2 - 1).astype(np.int8)
            waiting.append((codes, sign))
            held += batch.num_rows
            if held >= most:
                yield made()
                block, held, waiting = block + 1, 0, []
        if held:
            yield made()

    return rows.select(*names, label).mapInArrow(packed, PACKED)


def with_trees(packed: DataFrame, trees: list[tuple[Tree, float]], bits: int) -> RDD:
    """The blocks as (part, block, codes, sign, score), scores increased by the weighted trees."""
    steps = []
    for tree, weight in trees:
        values = np.zeros(2 ** (len(tree.splits) + 1))
        for k, node in tree.nodes.items():
            values[k] = node.value * weight
        steps.append((tree.splits, values))

    def added(rows: Iterator) -> Iterator[tuple]:
        for row in rows:
            sign, score = np.frombuffer(row.sign, np.int8), np.frombuffer(row.score, np.float64)
            codes = np.frombuffer(row.codes, np.uint16).reshape(-1, len(sign))
            for splits, values in steps:
                score = score + values[_walk(codes, splits, bits)]
            yield row.part, row.block, codes, sign, score

    return packed.rdd.mapPartitions(added)


def blocks_table(blocks: RDD) -> DataFrame:
    return blocks.map(lambda b: (*b[:2], *(bytearray(x.tobytes()) for x in b[2:]))).toDF(PACKED)


def _total(found: Iterable[tuple], start=0.0) -> np.ndarray:
    """Sums added up in the order of the rows, so equal runs give equal trees."""
    return sum((sums for _, sums in sorted(found, key=lambda x: x[0])), start)


def level_sums(blocks: RDD, tree: Tree, open_nodes: list[int], features: int, bits: int, first: bool) -> np.ndarray:
    """Count, sum and sum of squares of the targets by [3, feature, open node, bin].

    Two features share a code, so one count of codes serves both.
    """
    splits, count = tree.splits, len(open_nodes)
    pairs, width = (features + 1) // 2, 1 << bits
    slots = np.full(2 ** (len(splits) + 1), count, dtype=np.intp)
    slots[open_nodes] = np.arange(count)
    slots <<= 2 * bits
    cells = (count + 1) << 2 * bits

    def added(rows: Iterator[tuple]) -> Iterator[tuple]:
        total, begins = np.zeros((3, pairs, cells)), None
        for part, block, codes, sign, score in rows:
            begins = begins or (part, block)
            target = sign.astype(np.float64)
            if not first:
                with np.errstate(over="ignore"):
                    target = 4.0 * target / (1.0 + np.exp(2.0 * target * score))
            squares = target * target
            base = slots[_walk(codes, splits, bits)]
            for p in range(pairs):
                at = base + codes[p]
                total[0, p] += np.bincount(at, minlength=cells)
                total[1, p] += np.bincount(at, target, cells)
                total[2, p] += np.bincount(at, squares, cells)
        if begins:
            by_pair = total.reshape(3, pairs, count + 1, width, width)[:, :, :-1]
            each = np.stack([by_pair.sum(axis=4), by_pair.sum(axis=3)], axis=2).reshape(3, 2 * pairs, count, width)
            yield begins, each[:, :features]

    found, groups = blocks.mapPartitions(added), TO_DRIVER
    if blocks.getNumPartitions() > groups:
        grouped = found.keyBy(lambda x: x[0][0] % groups).groupByKey(groups)
        found = grouped.map(lambda g: (g[0], _total(g[1])))
    return _total(found.collect(), np.zeros((3, features, count, width)))


def grow(blocks: RDD, sizes: list[int], bits: int, depth: int, first: bool) -> Tree:
    """One regression tree on the targets of the scores, a pass a level."""
    tree, known, open_nodes = Tree(), {}, [1]
    for level in range(depth):
        sums = level_sums(blocks, tree, open_nodes, len(sizes), bits, first)
        splits, following = {}, []
        for at, k in enumerate(open_nodes):
            node, *children = best_split(sums[:, :, at], sizes, known.get(k))
            tree.nodes[k] = node
            if children[0] is None:
                continue
            splits[k] = (node.feature, node.cut)
            for c, child in zip((2 * k, 2 * k + 1), children, strict=True):
                tree.nodes[c] = known[c] = child
                if level + 1 < depth and abs(child.impurity) >= PURE:
                    following.append(c)
        if splits:
            tree.splits.append(splits)
        open_nodes = following
        if not open_nodes:
            break
    return tree


def _module(jvm, package: str, name: str):
    """A Scala object."""
    found = jvm
    for step in (*package.split("."), f"{name}$", "MODULE$"):
        found = getattr(found, step)
    return found


def thresholds_of(booster: GBTClassifier, rows: DataFrame) -> list[np.ndarray]:
    """Spark's candidate thresholds of every feature. Features and labels are checked as Spark's trainer does."""
    jvm = rows.sparkSession._jvm
    booster._transfer_params_to_java()
    java = booster._java_obj
    points = _module(jvm, "org.apache.spark.ml.util", "DatasetUtils").extractInstances(java, rows._jdf, jvm.scala.Some(2))
    classes = jvm.org.apache.spark.mllib.tree.configuration.Algo.Classification()
    none = _module(jvm, "scala.collection.immutable", "Map").empty()
    strategy = java.getOldBoostingStrategy(none, classes).treeStrategy()
    build = _module(jvm, "org.apache.spark.ml.tree.impl", "DecisionTreeMetadata").buildMetadata
    metadata = build(points, strategy, 1, booster.getFeatureSubsetStrategy())
    splits = _module(jvm, "org.apache.spark.ml.tree.impl", "RandomForest").findSplits(points, metadata, booster.getSeed())
    return [np.array([s.threshold() for s in each]) for each in splits]


def doubles(jvm, values) -> object:
    """A Java array, handed over as a whole."""
    made = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Double.TYPE, len(values))
    jvm.java.nio.ByteBuffer.wrap(np.asarray(values, dtype=">f8").tobytes()).asDoubleBuffer().get(made)
    return made


def _spark_node(jvm, tree: Tree, k: int, thresholds: list[np.ndarray]):
    """(Spark's node, its prediction if it is a leaf); two leaves that predict the same become one."""
    ml, node = jvm.org.apache.spark.ml.tree, tree.nodes[k]
    stats = doubles(jvm, node.sums)
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(node.sums[0]))
    if tree.is_leaf(k):
        return ml.LeafNode(node.value, node.impurity, calculator), node.value
    (left, a), (right, b) = (_spark_node(jvm, tree, c, thresholds) for c in (2 * k, 2 * k + 1))
    if a is not None and a == b:
        return ml.LeafNode(a, node.impurity, calculator), a
    split = ml.ContinuousSplit(node.feature, float(thresholds[node.feature][node.cut]))
    return ml.InternalNode(node.value, node.impurity, node.gain, left, right, split, calculator), None


def spark_model(booster: GBTClassifier, trees: list[tuple[Tree, float]], thresholds: list[np.ndarray], spark) -> GBTClassificationModel:
    """The trees as the model that ``booster.fit`` returns."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    regression = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    made = gateway.new_array(regression, len(trees))
    for i, (tree, _) in enumerate(trees):
        made[i] = regression(_spark_node(jvm, tree, 1, thresholds)[0], len(thresholds))
    steps = doubles(jvm, [weight for _, weight in trees])
    java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(booster.uid, made, steps, len(thresholds), 2)
    return booster._copyValues(GBTClassificationModel(java))


def points_of(booster: GBTClassifier, rows: DataFrame, names: list[str]) -> Points:
    """Rows with their vector, and the columns (``names``) it was made of, as stored blocks."""
    thresholds = thresholds_of(booster, rows)
    return Points(*stored_at(pack(rows, names, booster.getLabelCol(), thresholds), "packed"), thresholds, bits_for(thresholds))


def fit(booster: GBTClassifier, points: Points) -> GBTClassificationModel:
    """As ``booster.fit`` of the rows that were packed."""
    spark, packed, bits = points.table.sparkSession, points.table, points.bits
    sizes = [len(t) for t in points.thresholds]
    trees, fresh, path = [], [], None
    for number in range(booster.getMaxIter()):
        blocks = with_trees(packed, fresh, bits).persist(StorageLevel.MEMORY_AND_DISK)
        trees.append((grow(blocks, sizes, bits, booster.getMaxDepth(), number == 0), booster.getStepSize() if number else 1.0))
        blocks.unpersist()
        fresh.append(trees[-1])
        if len(fresh) == STORED_EVERY:
            before = path
            packed, path = stored_at(blocks_table(with_trees(packed, fresh, bits)), "packed")
            fresh = []
            if before:
                remove(spark, before)
    if path:
        remove(spark, path)
    return spark_model(booster, trees, points.thresholds, spark)
