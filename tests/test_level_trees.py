"""Level-wise random trees against a tree grown row by row, and on odd inputs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.operators import level_trees as T


def frame(spark, x, y):
    rows = [(None if v is None else [None if a is None else float(a) for a in v], None if b is None else float(b)) for v, b in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double")


def plain_tree(x, y, seed, tree, depth, tries, min_leaf=1):
    """{node: (feature, threshold) or None, shares} by recursion over lists of rows."""
    out = {}

    def gini(ids):
        n = [sum(y[i] == c for i in ids) for c in (0, 1)]
        return len(ids) - sum(v * v for v in n) / len(ids)

    def visit(ids, node, level):
        ones = sum(y[i] for i in ids) / len(ids)
        out[node] = (None, ones)
        lo, hi = x[ids].min(axis=0), x[ids].max(axis=0)
        varying = [f for f in range(x.shape[1]) if lo[f] < hi[f]]
        if level == depth or ones in (0.0, 1.0) or not varying:
            return
        rng = random.Random(f"{seed}/{tree}/{node}")
        best = None
        features = rng.sample(varying, min(tries, len(varying)))
        for f in features:
            cut = lo[f] + rng.random() * (hi[f] - lo[f])
            left = [i for i in ids if x[i, f] <= cut]
            right = [i for i in ids if x[i, f] > cut]
            if min(len(left), len(right)) >= min_leaf:
                value = gini(left) + gini(right)
                if best is None or value < best[0]:
                    best = (value, f, cut, left, right)
        if best:
            out[node] = ((best[1], best[2]), ones)
            visit(best[3], 2 * node + 1, level + 1)
            visit(best[4], 2 * node + 2, level + 1)

    visit(list(range(len(y))), 0, 0)
    return out


def table(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[:, 3] = rng.integers(0, 3, n)
    return x, ((x[:, 0] + x[:, 3] + rng.normal(size=n) * 0.3) > 1).astype(int)


@pytest.mark.parametrize("min_leaf", [1, 5])
def test_trees_equal_those_grown_by_recursion(spark, min_leaf):
    x, y = table()
    model = T.grow(frame(spark, x, y).repartition(5), trees=3, depth=4, tries=2, min_leaf=min_leaf, seed=11)
    for tree in range(3):
        want = plain_tree(x, y, 11, tree, 4, 2, min_leaf)
        for node in range(model.feature.shape[1]):
            split, ones = want.get(node, (None, None))
            got = model.feature[tree, node]
            assert (got == -1) == (split is None)
            if split:
                assert got == split[0] and model.threshold[tree, node] == pytest.approx(split[1], abs=1e-12)
            if ones is not None:
                assert model.share[tree, node, 1] == pytest.approx(ones)


def test_other_partitions_and_groups_of_trees_give_the_same_forest(spark, monkeypatch):
    x, y = table()
    df = frame(spark, x, y)
    one = T.grow(df.coalesce(1), trees=4, depth=5)
    monkeypatch.setattr(T, "STATE", 1)
    other = T.grow(df.repartition(7, F.rand(1)), trees=4, depth=5)
    assert (one.feature == other.feature).all() and (one.threshold == other.threshold).all()
    assert (one.share == other.share).all()


def test_predictions_are_means_over_trees(spark):
    x, y = table()
    model = T.grow(frame(spark, x, y), trees=5, depth=6)
    got = model.transform(frame(spark, x, y)).toPandas()
    p = np.array(got["probability"].tolist())
    assert np.allclose(p, model.probability(np.array(got["features"].tolist())))
    assert np.allclose(p.sum(axis=1), 1)
    assert (got["prediction"] == (p[:, 1] > p[:, 0])).all()
    assert (got["prediction"] == got["label"]).mean() > 0.9


def test_odd_rows(spark):
    # Three classes; nulls, NaN and infinite values; unlabelled rows; repeated rows.
    x = [[1, 0], [1, 0], [None, 5], [math.nan, 5], [9, math.inf], None, [2, 2], [3, 3]]
    y = [0, 0, 2, 2, 7, 7, None, math.nan]
    model = T.grow(frame(spark, x, y), trees=8, depth=3)
    assert model.classes == [0.0, 2.0, 7.0] and model.share[0, 0].tolist() == [1 / 3] * 3
    assert set(model.feature.ravel()) <= {-1, 0}  # an infinite range is not cut at the root
    got = model.transform(frame(spark, x, y))
    assert got.filter("prediction IS NULL").count() == 0 and got.count() == 8
    none = T.grow(frame(spark, [], []), trees=2, depth=2)
    assert none.transform(frame(spark, x, y)).filter("prediction IS NOT NULL").count() == 0
    same = T.grow(frame(spark, [[1.0]] * 6, [0, 1, 0, 1, 0, 1]), trees=2, depth=3)
    assert (same.feature == -1).all() and same.share[:, 0].tolist() == [[0.5, 0.5]] * 2


def test_sides_are_sorted_as_small_numbers(monkeypatch):
    """Rows are put in order by whole numbers of two bytes, which takes linear time; ranges skip NaN."""
    x = np.array([[1.0, 5.0], [2.0, np.nan], [3.0, 7.0], [4.0, 8.0]])
    kinds, plain = [], np.argsort
    monkeypatch.setattr(T.np, "argsort", lambda a, **how: (kinds.append(a.dtype.itemsize), plain(a, **how))[1])
    found = []

    class Rows:
        def mapInArrow(self, count, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(list(x)), pa.array([0, 1, 1, 1])], names=["x", "y"])
            found.extend(count(iter([batch])))
            raise StopIteration

    forest = T.Forest([0.0, 1.0], 2, np.full((1, 3), -1), np.zeros((1, 3)), np.zeros((1, 3, 2)))
    with pytest.raises(StopIteration):
        T._level(Rows(), forest, 0, [T._Open(0, 0, [0, 1], [2.0, 7.0])], 2)
    assert kinds and max(kinds) <= 2
    rows = list(zip(*[found[0].column(i).to_pylist() for i in range(4)]))
    assert rows[0:2] == [(0, 1, 1.0, 2.0), (1, 1, 5.0, 5.0)]  # first candidate's left side: one of each class
    assert rows[4:6] == [(4, 1, 1.0, 3.0), (5, 1, 5.0, 7.0)]  # second candidate: NaN goes right
