"""Random forest over the packed rows of ``boosting``, all trees a level at a time.

Spark's trainer keeps a row and its draws for 50 trees as objects of about 360 bytes. Here the draws are made again in
every pass from the tree, the partition and the block, so a row stays 25 bytes. Counts of a tree meet in one task,
which picks the splits of its nodes; the driver gets these.

Thresholds, draws with replacement (Poisson 1), features tried a node (the root of their number), Gini gains, depth
and the joining of leaves that predict the same are those of ``RandomForestClassifier``; the random numbers are not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier

from tickloom.plans.boosting import PURE, Points, bin_of, doubles

# 2^32 times the chance of at most k draws
DRAWS = np.floor(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]) * 2.0**32).astype(np.uint64)


@dataclass
class Grown:
    """A tree as lists by node, 0 the root; ``left`` is 0 at a leaf, the right child follows the left one."""

    left: list[int] = field(default_factory=lambda: [0])
    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    counts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(2)])
    impurity: list[float] = field(default_factory=lambda: [0.0])
    open: list[int] = field(default_factory=lambda: [0])

    def add(self, counts: np.ndarray) -> int:
        for column, value in zip(
            (self.left, self.feature, self.cut, self.gain, self.counts, self.impurity),
            (0, 0, 0, 0.0, counts, float(gini(counts))), strict=True,
        ):
            column.append(value)
        return len(self.left) - 1

    def steps(self) -> np.ndarray:
        """One number a node: the left child (itself at a leaf), feature and cut, 255 at a leaf so that it stays."""
        left = np.array(self.left, dtype=np.int64)
        leaf = left == 0
        nodes = np.where(leaf, np.arange(len(left)), left)
        cut = np.where(leaf, 255, np.array(self.cut))
        return nodes << 24 | np.array(self.feature, dtype=np.int64) << 8 | cut


def gini(counts: np.ndarray) -> np.ndarray:
    """Gini impurity of class counts along the last axis, 0 without rows."""
    total = counts.sum(axis=-1, keepdims=True)
    return np.where(total[..., 0] == 0, 0.0, 1.0 - ((counts / np.maximum(total, 1)) ** 2).sum(axis=-1))


def drawn(seed: int, tree: int, part: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block is drawn for a tree; the same in every pass."""
    raw = np.random.default_rng([seed, tree, part, block]).integers(0, 1 << 32, rows, dtype=np.uint32)
    times = np.zeros(rows, dtype=np.uint8)
    for k in DRAWS:
        times += raw >= np.uint32(min(int(k), (1 << 32) - 1))
    return times


def best_splits(counts: np.ndarray, tried: np.ndarray, sizes: np.ndarray) -> list[tuple]:
    """(counts, gain, feature, cut, counts left) of every node; gain is -inf where no split is allowed.

    counts [node, place, bin, class], tried [node, place] = features, sizes = thresholds per feature.
    """
    upto = counts.cumsum(axis=2)
    left = upto[:, :, :-1]
    right = upto[:, :, -1:] - left
    whole = upto[:, 0, -1]
    some, rest = left.sum(axis=-1), right.sum(axis=-1)
    both = np.maximum(some + rest, 1)
    gain = gini(whole)[:, None, None] - some / both * gini(left) - rest / both * gini(right)
    allowed = np.arange(left.shape[2]) < sizes[tried][:, :, None]
    gain = np.where(allowed & (some >= 1) & (rest >= 1) & (gain >= 0), gain, -np.inf)
    found = []
    for i, flat in enumerate(gain.reshape(len(gain), -1).argmax(axis=1)):
        place, cut = np.unravel_index(flat, gain.shape[1:])
        found.append((whole[i], float(gain[i, place, cut]), int(tried[i, place]), int(cut), left[i, place, cut]))
    return found


def level_splits(points: Points, trees: list[Grown], tried: list[np.ndarray], seed: int) -> dict[int, list[tuple]]:
    """``best_splits`` of the open nodes of every tree."""
    bits, features = points.bits, len(points.thresholds)
    sizes, width = np.array([len(t) for t in points.thresholds]), 1 << points.bits
    plan = {}
    for t, tree in enumerate(trees):
        if tree.open:
            slots = np.full(len(tree.left), len(tree.open), dtype=np.int64)
            slots[tree.open] = np.arange(len(tree.open))
            # rows of closed nodes are counted in a slot behind the others, which is left out
            plan[t] = tree.steps(), slots, np.vstack([tried[t], tried[t][:1]]).T.astype(np.int64).copy(), len(tree.open)
    levels = max(_depth(t) for t in trees)

    def counted(rows: Iterator) -> Iterator[tuple[int, np.ndarray]]:
        totals: dict[int, np.ndarray] = {}
        for row in rows:
            sign = np.frombuffer(row.sign, np.int8)
            codes = np.frombuffer(row.codes, np.uint16).reshape(-1, len(sign))
            bins = np.stack([bin_of(codes, f, bits).astype(np.uint8) for f in range(features)], axis=1).ravel()
            up = (sign > 0).astype(np.int64)
            for t, (steps, slots, subset, count) in plan.items():
                times = drawn(seed, t, row.part, row.block, len(sign))
                kept = np.flatnonzero(times)
                begin, weight, label = kept * features, times[kept].astype(np.float64), up[kept]
                node = np.zeros(len(kept), dtype=np.int64)
                for _ in range(levels):
                    step = steps[node]
                    node = (step >> 24) + (bins[begin + (step >> 8 & 0xFFFF)] > (step & 0xFF))
                slot = slots[node]
                places = len(subset)
                cells = np.empty((places, len(kept)), dtype=np.int64)
                for j in range(places):
                    cells[j] = ((slot * places + j << bits) + bins[begin + subset[j][slot]] << 1) + label
                size = (count + 1) * places * width * 2
                found = np.bincount(cells.ravel(), np.tile(weight, places), size)
                totals[t] = totals[t] + found if t in totals else found
        for t, found in totals.items():
            subset, count = plan[t][2], plan[t][3]
            yield t, found[: count * len(subset) * width * 2].astype(np.int64)

    def best(item: tuple[int, np.ndarray]) -> tuple[int, list[tuple]]:
        t, counts = item
        subset, count = plan[t][2], plan[t][3]
        return t, best_splits(counts.reshape(count, len(subset), width, 2), subset.T[:count], sizes)

    # whole numbers, so their order does not matter
    return dict(points.table.rdd.mapPartitions(counted).reduceByKey(np.add, len(plan)).map(best).collect())


def _depth(tree: Grown, k: int = 0) -> int:
    return 1 + max(_depth(tree, tree.left[k]), _depth(tree, tree.left[k] + 1)) if tree.left[k] else 0


def grow(points: Points, number: int, depth: int, seed: int) -> list[Grown]:
    trees = [Grown() for _ in range(number)]
    features = len(points.thresholds)
    places = math.ceil(math.sqrt(features)) if number > 1 else features
    for level in range(depth):
        if not any(t.open for t in trees):
            break
        rngs = [np.random.default_rng([seed, level, t]) for t in range(number)]
        tried = [np.sort(r.random((len(t.open), features)).argsort(axis=1)[:, :places], axis=1) for t, r in zip(trees, rngs, strict=True)]
        for t, found in level_splits(points, trees, tried, seed).items():
            tree, following = trees[t], []
            for k, (whole, gain, feature, cut, left) in zip(tree.open, found, strict=True):
                tree.counts[k], tree.impurity[k] = whole, float(gini(whole)) if gain > -np.inf else -1.0
                if gain <= 0:
                    continue
                tree.feature[k], tree.cut[k], tree.gain[k] = feature, cut, gain
                tree.left[k] = tree.add(left)
                tree.add(whole - left)
                if level + 1 < depth:
                    following += [c for c in (tree.left[k], tree.left[k] + 1) if tree.impurity[c] >= PURE]
            tree.open = following
    return trees


def _spark_tree(jvm, tree: Grown, thresholds: list[np.ndarray]):
    """The root as Spark's node; two leaves that predict the same become one."""
    ml, gini_of = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator
    # one array for all, as every call to the JVM takes time
    counts, part = doubles(jvm, np.concatenate(tree.counts)), jvm.java.util.Arrays.copyOfRange

    def node(k: int):
        made = gini_of(part(counts, 2 * k, 2 * k + 2), int(tree.counts[k].sum()))
        value = float(tree.counts[k].argmax())
        if not tree.left[k]:
            return lambda: ml.LeafNode(value, tree.impurity[k], made), value
        (left, a), (right, b) = node(tree.left[k]), node(tree.left[k] + 1)
        if a is not None and a == b:
            return lambda: ml.LeafNode(a, tree.impurity[k], made), a
        split = ml.ContinuousSplit(tree.feature[k], float(thresholds[tree.feature[k]][tree.cut[k]]))
        return lambda: ml.InternalNode(value, tree.impurity[k], tree.gain[k], left(), right(), split, made), None

    return node(0)[0]()


def fit(forest: RandomForestClassifier, points: Points) -> RandomForestClassificationModel:
    """As ``forest.fit`` of the rows that were packed, with other random numbers."""
    spark = points.table.sparkSession
    jvm, features = spark._jvm, len(points.thresholds)
    trees = grow(points, forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed())
    kind = jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel
    made = spark.sparkContext._gateway.new_array(kind, len(trees))
    for i, tree in enumerate(trees):
        made[i] = kind(_spark_tree(jvm, tree, points.thresholds), features, 2)
    java = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(forest.uid, made, features, 2)
    return forest._copyValues(RandomForestClassificationModel(java))
