"""Exact neighbour search against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import neighbours as N
from tablewright.operators.quality import impute_knn


def frame(spark, x, key):
    pdf = pd.DataFrame({key: np.arange(len(x)), "v": [list(map(float, r)) for r in x]})
    return spark.createDataFrame(pdf, f"{key} long, v array<double>")


def brute(q, r, k, metric="euclidean", skip_self=False):
    out = {}
    for i, x in enumerate(q):
        d = np.abs(r - x).sum(axis=1) if metric == "manhattan" else np.sqrt(((r - x) ** 2).sum(axis=1))
        order = sorted((round(dist, 9), j) for j, dist in enumerate(d) if not (skip_self and i == j))
        out[i] = [j for _, j in order[:k]]
    return out


def got(df, q="q", r="r"):
    out = {}
    for row in df.orderBy(q, "pos").collect():
        out.setdefault(row[q], []).append(row[r])
    return out


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("dim", [2, 20])
def test_knn_equals_brute_force(spark, monkeypatch, metric, dim):
    monkeypatch.setattr(N, "CHUNK_ROWS", 25)
    monkeypatch.setattr(N, "QUERY_BATCH", 10)
    rng = np.random.default_rng(3)
    r, q = rng.normal(size=(300, dim)), rng.normal(size=(60, dim))
    near = N.knn(frame(spark, q, "q"), frame(spark, r, "r"), "q", "r", "v", 4, metric)
    assert got(near) == brute(q, r, 4, metric)


def test_knn_with_a_third_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK_ROWS", 20)
    rng = np.random.default_rng(4)
    r = np.vstack([np.tile([[0.5, 0.5]], (100, 1)), rng.integers(0, 4, size=(200, 2)).astype(float)])
    near = N.knn(frame(spark, r, "q"), frame(spark, r, "r"), "q", "r", "v", 5, exclude_self=True)
    assert got(near) == brute(r, r, 5, skip_self=True)


def test_knn_fewer_references_than_k(spark):
    r = np.array([[0.0], [2.0]])
    near = N.knn(frame(spark, np.array([[0.4]]), "q"), frame(spark, r, "r"), "q", "r", "v", 5)
    assert got(near) == {0: [0, 1]}


def test_knn_no_references(spark):
    empty = spark.createDataFrame([], "r long, v array<double>")
    assert N.knn(frame(spark, np.zeros((2, 2)), "q"), empty, "q", "r", "v", 3).count() == 0


def test_knn_classify_weights(spark):
    train = spark.createDataFrame(
        [(1, "a", [0.0]), (2, "b", [1.0]), (3, "b", [1.2])], "id long, y string, v array<double>"
    )
    query = spark.createDataFrame([(9, [0.05])], "id long, v array<double>")
    uniform = N.knn_classify(query, train, "id", "y", "v", 3).first()["prediction"]
    weighted = N.knn_classify(query, train, "id", "y", "v", 3, weights="distance").first()["prediction"]
    assert (uniform, weighted) == ("b", "a")


def test_impute_knn(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 2))
    y = [None if i % 4 == 0 else float(i) for i in range(80)]
    pdf = pd.DataFrame({"id": range(80), "a": x[:, 0], "b": x[:, 1], "y": y})
    df = spark.createDataFrame(pdf, "id long, a double, b double, y double").replace(float("nan"), None)
    out = {r["id"]: r["y"] for r in impute_knn(df, "id", "y", ["a", "b"], 3).collect()}
    known = [i for i in range(80) if i % 4]
    for i in range(0, 80, 4):
        d = sorted((((x[i] - x[j]) ** 2).sum(), j) for j in known)[:3]
        assert out[i] == pytest.approx(np.mean([float(j) for _, j in d]))
    assert all(out[i] == float(i) for i in known)


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(6)
    minor = pd.DataFrame({"id": range(20), "a": rng.uniform(0, 1, 20), "b": rng.uniform(5, 6, 20), "c": ["x", "y"] * 10, "y": 1})
    major = pd.DataFrame({"id": range(100, 175), "a": rng.uniform(3, 4, 75), "b": rng.uniform(0, 1, 75), "c": "z", "y": 0})
    df = spark.createDataFrame(pd.concat([minor, major]), "id long, a double, b double, c string, y int")
    out = N.smote_nc(df, "id", "y", ["a", "b"], ["c"], k=5)
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 75, 1: 75}
    made = out.filter("synthetic = 1").toPandas()
    assert len(made) == 55 and set(made["c"]) <= {"x", "y"}
    assert made["a"].between(0, 1).all() and made["b"].between(5, 6).all()
    again = N.smote_nc(df.repartition(3), "id", "y", ["a", "b"], ["c"], k=5).filter("synthetic = 1").toPandas()
    assert sorted(made["a"].round(12)) == sorted(again["a"].round(12))


def test_few_chunks_are_met_in_three_dimensions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    r, q = rng.normal(size=(60_000, 3)), rng.normal(size=(50, 3))
    met = []
    real = N.pin

    def spy(df):
        out = real(df)
        if "chunk" in out.columns and "_qid" in out.columns:
            met.append(out.count())
        return out

    monkeypatch.setattr(N, "pin", spy)
    near = N.knn(frame(spark, q, "q"), frame(spark, r, "r"), "q", "r", "v", 5)
    assert got(near) == brute(q, r, 5)
    assert sum(met) < 0.4 * 50 * 62


def test_boxes_stay_exact_and_small(spark, monkeypatch):
    """In few dimensions a query meets a few boxes, whatever the table; copies, gaps and missing numbers included."""
    monkeypatch.setattr(N, "BOX_ROWS", 20)
    monkeypatch.setattr(N, "QUERY_BATCH", 50)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(1500, 3)), np.repeat(rng.normal(size=(1, 3)), 300, axis=0), rng.normal(9, 0.001, size=(700, 3))])
    ids = rng.permutation(len(x))
    rows = [(int(i), [float(f) for f in v]) for i, v in zip(ids, x)]
    refs = spark.createDataFrame(rows + [(9_001, [1.0, None, 2.0]), (9_002, [float("nan")] * 3)], "rid long, vec array<double>")
    queries = spark.createDataFrame(rows[::40] + [(7_000, [50.0, -3.0, 0.5]), (7_001, [None, 0.0, 0.0])], "qid long, vec array<double>")
    asked, plain = [], N._meet
    monkeypatch.setattr(N, "_meet", lambda a, *more: (asked.append(a.count()), plain(a, *more))[1])
    for metric in ("euclidean", "manhattan"):
        got = N.knn(queries, refs, "qid", "rid", "vec", 7, metric, exclude_self=True).toPandas()
        assert 7_001 not in set(got.qid)
        for i, v in rows[::40] + [(7_000, [50.0, -3.0, 0.5])]:
            gap = np.abs(x - np.array(v))
            d = gap.sum(axis=1) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=1))
            best = [j for _, j in sorted((round(a, 12), int(j)) for a, j in zip(d, ids) if j != i)[:7]]
            assert got[got.qid == i].sort_values("pos").rid.tolist() == best
    assert max(asked) < 64 * 20  # 125 boxes would make 64 * 125
    few = N.knn(queries, refs.filter("rid < 5"), "qid", "rid", "vec", 7).groupBy("qid").count().agg({"count": "min"}).first()[0]
    assert few == 5


def test_boxes_are_cut_where_one_value_is_common():
    """A column that mostly holds its greatest value is cut once, and the other columns after it."""
    rng = np.random.default_rng(6)
    x = np.column_stack([np.where(rng.random(4_000) < 0.1, 0.0, 900.0), rng.random(4_000)])
    tree = N.Boxes(x, 6, "euclidean")
    assert np.bincount(tree.place(x), minlength=64).max() < 200
