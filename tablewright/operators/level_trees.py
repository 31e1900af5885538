"""Extremely randomised trees, grown a level at a time for the whole forest.

A level is one pass: tasks route their rows through the trees so far and count, for every
candidate split of every open node, the labels on both sides and the range of every feature
there. Spark merges the counts; the driver chooses the splits. What it holds is the size of the
model: trees x nodes of a level x candidates x features.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = 1 << 22  # numbers that a task may hold for one level


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as a matrix; null arrays and elements become NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null([math.nan] * width)
    flat = column.flatten().fill_null(math.nan)
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass
class Forest:
    """Nodes as in a heap: the children of node i are 2i + 1 (feature <= threshold) and 2i + 2."""

    classes: list[float]
    width: int
    feature: np.ndarray  # (trees, nodes), -1 at leaves
    threshold: np.ndarray
    share: np.ndarray  # (trees, nodes, classes): classes among the training rows of a node

    def route(self, x: np.ndarray, tree: int, levels: int | None = None) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        if not x.size:
            return node
        feature, threshold = self.feature[tree], self.threshold[tree]
        flat, rows = x.ravel(), np.arange(len(x)) * x.shape[1]
        for _ in range(self.depth if levels is None else levels):
            f = feature[node]
            right = ~(flat[rows + np.maximum(f, 0)] <= threshold[node])
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    @property
    def depth(self) -> int:
        return (self.feature.shape[1] + 1).bit_length() - 2

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees of the class shares in the leaf that a row reaches."""
        total = np.zeros((len(x), len(self.classes)))
        for tree in range(len(self.feature)):
            total += self.share[tree][self.route(x, tree)]
        return total / max(1, len(self.feature))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``probability`` (array, by class) and ``prediction`` (ties: least class).

        A model of no training rows has no classes: null prediction.
        """
        model, width = self, self.width

        @F.arrow_udf("array<double>")
        def probability(v: pa.Array) -> pa.Array:
            p = model.probability(matrix(v, width))
            return pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], pa.array(p.ravel()))

        if not self.classes:
            return df.withColumns({"probability": F.array().cast("array<double>"), "prediction": F.lit(None).cast("double")})
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return df.withColumn("probability", probability(as_array(df, features))).withColumn(
            "prediction", F.element_at(F.array(*[F.lit(c) for c in self.classes]), best)
        )


def as_array(df: DataFrame, features: str) -> Column:
    plain = df.schema[features].dataType.typeName() == "array"
    return F.col(features).cast("array<double>") if plain else vector_to_array(features)


@dataclass
class _Open:
    """A node to split: candidate features and their thresholds."""

    tree: int
    node: int
    features: list[int]
    thresholds: list[float]


def _candidates(seed: int, tree: int, node: int, lo: np.ndarray, hi: np.ndarray, tries: int) -> _Open | None:
    """``tries`` features that vary in the node, and a threshold within each one's own range.

    The draw is fixed by seed, tree and node, so it is the same on any partitioning.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        varying = np.flatnonzero((lo < hi) & np.isfinite(hi - lo))
    if not len(varying):
        return None
    rng = random.Random(f"{seed}/{tree}/{node}")
    chosen = rng.sample([int(f) for f in varying], min(tries, len(varying)))
    cuts = [float(min(lo[f] + rng.random() * (hi[f] - lo[f]), np.nextafter(hi[f], -np.inf))) for f in chosen]
    return _Open(tree, node, chosen, cuts)


@dataclass
class _Side:
    count: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    weight: float = field(init=False)

    def __post_init__(self):
        self.weight = float(self.count.sum())

    @property
    def impurity(self) -> float:
        """Gini impurity times the rows."""
        return self.weight - float((self.count.astype(float) ** 2).sum()) / self.weight if self.weight else 0.0


def _level(rows: DataFrame, forest: Forest, level: int, nodes: list[_Open], tries: int) -> dict:
    """(place in ``nodes``, candidate, side) -> :class:`_Side`, by one pass over the rows."""
    width, kinds = forest.width, len(forest.classes)
    span = max(width, kinds)
    by_tree: dict[int, list[int]] = {}
    for i, o in enumerate(nodes):
        by_tree.setdefault(o.tree, []).append(i)
    size = len(nodes) * tries * 2
    small = np.min_scalar_type(size)
    drawn = np.array([[o.features[k] if k < len(o.features) else -1 for o in nodes] for k in range(tries)])
    cuts = np.array([[o.thresholds[k] if k < len(o.features) else 0.0 for o in nodes] for k in range(tries)])

    def count(batches):
        n = np.zeros((size, kinds), np.int64)
        lo, hi = np.full((size, width), np.inf), np.full((size, width), -np.inf)
        for batch in batches:
            x, y = matrix(batch.column("x"), width), batch.column("y").to_numpy()
            columns = np.ascontiguousarray(x.T)
            for tree, own in by_tree.items():
                at = forest.route(x, tree, level)
                place = np.full(forest.feature.shape[1], -1)
                place[[nodes[i].node for i in own]] = own
                place = place[at]
                inside = np.flatnonzero(place >= 0)
                place = place[inside]
                for k in range(tries):
                    f, cut = drawn[k][place], cuts[k][place]
                    right = ~(columns[np.maximum(f, 0), inside] <= cut)
                    group = ((place * tries + k) * 2 + right).astype(small)
                    took = np.argsort(group, kind="stable")  # of small numbers, which takes linear time
                    if (f < 0).any():
                        took = took[f[took] >= 0]
                    if not len(took):
                        continue
                    group = group[took].astype(np.int64)
                    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                    here, took = group[start], inside[took]
                    for j in range(width):
                        column = columns[j][took]
                        lo[here, j] = np.fmin(lo[here, j], np.fmin.reduceat(column, start))
                        hi[here, j] = np.fmax(hi[here, j], np.fmax.reduceat(column, start))
                    n += np.bincount(group * kinds + y[took], minlength=size * kinds).reshape(size, kinds)
        met = np.flatnonzero(n.any(axis=1))
        wide = lambda a, fill: np.pad(a[met], ((0, 0), (0, span - a.shape[1])), constant_values=fill).ravel()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((met[:, None] * span + np.arange(span)).ravel()),
                pa.array(wide(n, 0)),
                pa.array(wide(lo, np.inf)),
                pa.array(wide(hi, -np.inf)),
            ],
            names=["at", "n", "lo", "hi"],
        )

    merged = (
        rows.mapInArrow(count, "at long, n long, lo double, hi double")
        .groupBy("at")
        .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .toArrow()
        .sort_by("at")
    )
    at, n, lo, hi = (merged[c].to_numpy().reshape(-1, span) for c in ("at", "n", "lo", "hi"))
    return {
        (int(g) // (2 * tries), int(g) // 2 % tries, int(g) % 2): _Side(n[i, :kinds], lo[i, :width], hi[i, :width])
        for i, g in enumerate(at[:, 0] // span)
    }


def grow(
    train: DataFrame,
    trees: int = 30,
    depth: int = 6,
    min_leaf: int = 1,
    tries: int | None = None,
    seed: int = 7,
    label: str = "label",
    features: str = "features",
) -> Forest:
    """Fit a forest: every tree sees all rows, every node ``tries`` features (square root of
    their number by default), each cut at a uniform draw between the least and the greatest
    value that the feature has in the node; the candidate of least Gini impurity is taken
    (ties: the one drawn first).

    Counts are whole numbers and ranges are exact, so the trees depend on rows and seed only, not
    on partitions or on tasks that ran twice. Rows without a label are left out. NaN and null
    features go right and do not widen ranges; a feature with an infinite value in a node is not
    cut there. A node without a varying feature, of one class, or whose candidates all leave a
    side under ``min_leaf`` rows is a leaf.

    Trees are grown in groups so that a task's counts stay within ``STATE`` numbers, or those of
    one tree if that is more.
    """
    known = train.filter(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
    top = known.select(F.col(label).cast("double").alias("y"), F.size(as_array(train, features)).alias("w")).groupBy("y").agg(
        F.max("w").alias("w")
    ).toArrow()  # a row a class
    classes = sorted(top["y"].to_pylist())
    width = max([w for w in top["w"].to_pylist() if w is not None], default=0)
    total = 2 ** (depth + 1) - 1
    forest = Forest(
        classes, width, np.full((trees, total), -1), np.zeros((trees, total)), np.zeros((trees, total, len(classes)))
    )
    if not classes:
        return forest
    tries = min(max(1, width), tries or max(1, round(math.sqrt(width))))
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("double")) - 1
    rows = known.select(as_array(train, features).alias("x"), index.cast("long").alias("y"))

    # Before the first cut: all rows on the left of an infinite threshold.
    root = _level(rows, forest, 0, [_Open(0, 0, [0], [math.inf])], 1)
    whole = _Side(sum(s.count for s in root.values()), np.min([s.lo for s in root.values()], axis=0), np.max([s.hi for s in root.values()], axis=0))
    together = max(1, STATE // (2 ** max(0, depth - 1) * tries * 2 * (2 * width + len(classes))))
    for low in range(0, trees, together):
        waiting = [(tree, 0, whole) for tree in range(low, min(trees, low + together))]
        for level in range(depth + 1):
            nodes, sides = [], []
            for tree, node, side in waiting:
                forest.share[tree, node] = side.count / side.weight
                if level < depth and (side.count > 0).sum() > 1:
                    found = _candidates(seed, tree, node, side.lo, side.hi, tries)
                    if found:
                        nodes.append(found)
                        sides.append(side)
            if not nodes:
                break
            counted = _level(rows, forest, level, nodes, tries)
            waiting = []
            for i, o in enumerate(nodes):
                pairs = [(counted.get((i, k, 0)), counted.get((i, k, 1))) for k in range(len(o.features))]
                fit = [
                    (a.impurity + b.impurity, k)
                    for k, (a, b) in enumerate(pairs)
                    if a and b and min(a.weight, b.weight) >= min_leaf
                ]
                if not fit:
                    continue
                k = min(fit)[1]
                forest.feature[o.tree, o.node], forest.threshold[o.tree, o.node] = o.features[k], o.thresholds[k]
                waiting += [(o.tree, 2 * o.node + 1, pairs[k][0]), (o.tree, 2 * o.node + 2, pairs[k][1])]
    return forest
