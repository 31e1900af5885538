"""Trees on counted cells equal trees on the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import cells
from tablewright.operators import trees as M
from tablewright.plans.bindings import Tables


def lines(spark, n=6000):
    """A plain column of few values, one of many, a constant; labels that neither decides alone."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(1, 6, n).astype(float), np.round(rng.uniform(-3, 3, n), 2)
    label = (a * b + rng.normal(0, 2, n) > 1).astype(float)
    part = np.where(rng.random(n) < 0.8, "train", "test")
    rows = [*zip(a.tolist(), b.tolist(), label.tolist(), part.tolist())]
    return spark.createDataFrame(rows, "a double, b double, label double, part string").withColumn("c", F.lit(4.0)).coalesce(1)


XS = ["a", "b", "c"]


def test_cut_points_are_those_of_a_tree():
    assert cells.cut_points(np.array([3.0, 1.0, 1.0, 2.0]), 8) == [1.5, 2.5]
    assert cells.cut_points(np.zeros(5), 8) == []
    assert cells.cut_points(np.arange(12.0), 4) == [2.5, 5.5, 8.5]


def test_cells_count_every_row(spark):
    rows = lines(spark)
    got = cells.counted_cells(rows, XS, [[1.0, 2.5], [-1.0, 0.0, 2.0], []], ["label"]).collect()
    want = {}
    for r in rows.collect():
        at = (r.label, float(np.searchsorted([1.0, 2.5], r.a)), float(np.searchsorted([-1.0, 0.0, 2.0], r.b)), 0.0)
        want[at] = want.get(at, 0) + 1
    assert {(r.label, *r.features.toArray()): r.rows for r in got} == want


def test_a_null_or_nan_feature_is_refused(spark):
    for bad in (None, float("nan")):
        rows = spark.createDataFrame([(1.0, 2.0), (bad, 2.0)], "a double, b double")
        for cuts in ([[0.5], []], [[], [1.0]]):
            with pytest.raises(Exception, match="(?i)null|nan"):
                cells.counted_cells(rows, ["a", "b"], cuts, []).collect()


def test_boosting_reads_long_tables_as_cells(spark, monkeypatch):
    rows = lines(spark)
    train, test, count = M.tree_split(rows, XS)
    assert count is None
    plain = M.gradient_boosting(train, test, rounds=4).first()
    several = M.gradient_boosting_multi(train, test, rounds=2).first()
    monkeypatch.setattr(cells, "MANY", 1000)
    train, test, count = M.tree_split(rows, XS)
    assert train.count() < 400
    got = M.gradient_boosting(train, test, rounds=4, count=count).first()
    assert got.n == plain.n and tuple(got) == pytest.approx(tuple(plain), abs=1e-9)
    assert tuple(M.gradient_boosting_multi(train, test, rounds=2, count=count).first()) == pytest.approx(tuple(several), abs=1e-9)


def test_grid_search_equals_cross_validation_on_the_same_folds(spark):
    from pyspark.ml.feature import VectorAssembler

    train = lines(spark, 4000)
    # Rows in the given order, so that both draw the same folds.
    plain = M.grid_search_cv(VectorAssembler(inputCols=XS, outputCol="features").transform(train)).collect()
    got = M.grid_search_cells(train, XS).collect()
    assert [(r.depth, r.bins, r.best) for r in got] == [(r.depth, r.bins, r.best) for r in plain]
    assert [r.auc for r in got] == pytest.approx([r.auc for r in plain], abs=1e-9)


def test_grid_search_query_reads_long_tables_as_cells(spark, sf_dir, monkeypatch):
    from tablewright.plans import learning

    monkeypatch.setattr(cells, "MANY", 1000)
    monkeypatch.setattr(learning.M, "grid_search_cv", None)  # fits the rows
    got = learning.grid_search_cv(Tables(spark, sf_dir)).collect()
    assert [(r.depth, r.bins) for r in got] == [(2, 8), (2, 32), (5, 8), (5, 32)] and all(0.5 < r.auc <= 1 for r in got)
