"""Invariants of the operators that SQL cannot express, and closed forms on made series."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.functions.distributions import t_quantile, t_two_sided_p
from tablewright.operators import classify as C
from tablewright.operators import cluster as K
from tablewright.operators import features as X
from tablewright.operators import linear as L
from tablewright.operators import sampling as SA
from tablewright.operators import timeseries as TS
from tablewright.operators import trees as M
from tablewright.operators.evaluate import auc_roc, residual_runs_test, two_sided_normal_p


def series(spark, values, key=1):
    pdf = pd.DataFrame({"k": key, "t": range(len(values)), "v": np.asarray(values, float)})
    return spark.createDataFrame(pdf, "k int, t long, v double")


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.3, size=(60, 4)) for c in (0.0, 3.0, 6.0)])
    pdf = pd.DataFrame({"id": range(180), "label": np.repeat([0, 1, 2], 60), "v": [list(map(float, r)) for r in x]})
    df = spark.createDataFrame(pdf, "id long, label int, v array<double>")
    return df, x


def test_t_distribution():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert t_quantile(0.975, 10) == pytest.approx(2.22813885, abs=1e-6)


def test_normal_p(spark):
    df = spark.createDataFrame([(0.0,), (1.959963985,), (-3.0,)], "z double")
    p = [r[0] for r in df.select(two_sided_normal_p(F.col("z"))).collect()]
    assert p == pytest.approx([1.0, 0.05, 0.0026998], abs=1e-6)


# -- linear models ---------------------------------------------------------


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = 2 + x @ np.array([1.0, -2.0, 0.0]) + rng.normal(0, 0.1, 400)
    pdf = pd.DataFrame(np.c_[x, y], columns=["a", "b", "c", "y"])
    return spark.createDataFrame(pdf), x, y


def test_ols_against_numpy(regression):
    df, x, y = regression
    got = {r["term"]: r for r in L.ols_inference(df, ["a", "b", "c"], "y").collect()}
    design = np.c_[np.ones(len(x)), x]
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    res = y - design @ beta
    se = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * (res @ res) / (len(y) - 4))
    for i, t in enumerate(["intercept", "a", "b", "c"]):
        assert got[t]["coef"] == pytest.approx(beta[i], abs=1e-9)
        assert got[t]["std_err"] == pytest.approx(se[i], abs=1e-9)
        assert got[t]["ci_low"] < beta[i] < got[t]["ci_high"]
    assert got["a"]["p"] < 1e-10 and got["c"]["p"] > 0.01


def test_ols_intervals_nest(regression):
    df, *_ = regression
    rows = L.ols_intervals(df, ["a", "b", "c"], "y").collect()
    assert all(r["pi_low"] < r["ci_low"] < r["fit"] < r["ci_high"] < r["pi_high"] for r in rows)
    assert 0.9 < np.mean([r["pi_low"] <= r["y"] <= r["pi_high"] for r in rows]) <= 1


def test_ridge_shrinks_and_lasso_drops(regression):
    df, *_ = regression
    path = L.ridge_lasso(df, ["a", "b", "c"], "y", [0.01, 0.5]).toPandas().set_index(["penalty", "alpha", "term"])["coef"]
    assert abs(path["ridge", 0.5, "b"]) < abs(path["ridge", 0.01, "b"])
    assert path["lasso", 0.5, "c"] == 0.0 and path["lasso", 0.5, "b"] != 0.0


def test_tls_two_predictors_has_smallest_orthogonal_error(regression):
    df, x, y = regression
    coef = {r["term"]: r["coef"] for r in L.tls_regression(df, ["a", "b"], "y").collect()}
    z = np.c_[x[:, :2], y]
    z = (z - z.mean(0)) / z.std(0)
    v = np.linalg.svd(z, full_matrices=False)[2][-1]
    sd = np.r_[x[:, :2].std(0), y.std()]
    assert coef["a"] == pytest.approx(-v[0] / v[2] * sd[2] / sd[0], rel=1e-8)
    assert coef["b"] == pytest.approx(-v[1] / v[2] * sd[2] / sd[1], rel=1e-8)


def test_poly_sweep_picks_the_true_degree(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-2, 2, 600)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": 1 - x + 0.5 * x**3 + rng.normal(0, 0.05, 600)}))
    out = L.poly_regression_sweep(df.limit(450), df, "x", "y", [1, 2, 3]).toPandas()
    assert out.loc[out["best"] == 1, "degree"].tolist() == [3]
    assert out["rmse"].is_monotonic_decreasing


# -- series ----------------------------------------------------------------


def ar1(phi, n=1500, seed=4, c=0.0):
    rng = np.random.default_rng(seed)
    v = [0.0]
    for e in rng.normal(size=n - 1):
        v.append(c + phi * v[-1] + e)
    return v


def test_ar1_is_recovered(spark):
    v = ar1(0.7)
    f = TS.forecast_ar(series(spark, v), ["k"], "t", "v", 1, 3).orderBy("t").collect()
    assert [r["t"] for r in f] == [1500, 1501, 1502]
    x, y = np.array(v[:-1]), np.array(v[1:])
    b, a = np.polyfit(x, y, 1)
    assert f[0]["forecast"] == pytest.approx(a + b * v[-1], abs=1e-9)
    assert f[1]["forecast"] == pytest.approx(a + b * f[0]["forecast"], abs=1e-9)


def test_pacf_of_ar1_cuts_off(spark):
    p = {r["lag"]: r["pacf"] for r in TS.pacf(series(spark, ar1(0.7)), ["k"], "t", "v", 4).collect()}
    assert p[1] == pytest.approx(0.7, abs=0.06)
    assert all(abs(p[j]) < 0.08 for j in (2, 3, 4))


def test_unit_root_tests_disagree_on_walk_and_noise(spark):
    both = series(spark, ar1(0.3), 1).unionByName(series(spark, ar1(1.0), 2))
    rep = {r["k"]: r["verdict"] for r in TS.stationarity_report(both, ["k"], "t", "v", 4, 24).collect()}
    assert rep == {1: "stationary", 2: "not stationary"}


def test_arima_search_finds_differencing_and_lag(spark):
    scores = TS.arima_order_search(series(spark, ar1(0.8)), ["k"], "t", "v", [0, 1, 2], [0], [0, 1])
    rows = {(r["p"], r["q"]): r["aic"] for r in scores.collect()}
    assert rows[(0, 0)] - rows[(1, 0)] > 500
    best = scores.filter("best = 1").collect()
    assert len(best) == 1 and best[0]["p"] >= 1


def test_sarima_undoes_differences(spark):
    # A trend plus an exact period is continued without error.
    v = [0.5 * i + [0, 3, -1, 4][i % 4] + 0.01 * math.sin(i * i) for i in range(200)]
    f = TS.forecast_sarima(series(spark, v), ["k"], "t", "v", (1, 0, 1), 4, 8).orderBy("t").collect()
    want = [0.5 * i + [0, 3, -1, 4][i % 4] for i in range(200, 208)]
    assert [r["forecast"] for r in f] == pytest.approx(want, abs=0.2)
    widths = [r["high"] - r["low"] for r in f]
    assert widths[0] > 0 and widths == sorted(widths)


def test_fourier_continues_a_wave(spark):
    v = [3 + 0.1 * i + 2 * math.sin(2 * math.pi * i / 12) for i in range(120)]
    f = TS.forecast_fourier(series(spark, v), ["k"], "t", "v", 12, 1, 12).orderBy("t").collect()
    want = [3 + 0.1 * i + 2 * math.sin(2 * math.pi * i / 12) for i in range(120, 132)]
    assert [r["forecast"] for r in f] == pytest.approx(want, abs=1e-8)


def test_holt_winters_continues_a_pattern(spark):
    v = [10 + i + [0, 5, -5, 2][i % 4] for i in range(60)]
    f = TS.forecast_holt_winters(series(spark, v), ["k"], "t", "v", 4, 4).orderBy("t").collect()
    assert [r["forecast"] for r in f] == pytest.approx([10 + i + [0, 5, -5, 2][i % 4] for i in range(60, 64)], abs=1.0)


def test_monthly_line_and_season(spark):
    t = np.arange(1, 37)
    sales = 50 + 0.8 * t + 9 * np.sin(t * np.pi / 6) + np.random.default_rng(4).normal(0, 2, 36)
    pdf = pd.DataFrame({"k": 1, "t": t, "v": sales})
    df = spark.createDataFrame(pdf, "k int, t long, v double")
    b, a = np.polyfit(pdf["t"], pdf["v"], 1)
    rest = pdf["v"] - (a + b * pdf["t"])
    season = rest.groupby(pdf["t"] % 12).mean()
    out = TS.decompose_additive(df, ["k"], "t", "v", 12).orderBy("t").toPandas()
    assert out["trend"].to_numpy() == pytest.approx((a + b * pdf["t"]).to_numpy())
    f = TS.forecast_trend_seasonal(df, ["k"], "t", "v", 12, 3).orderBy("t").collect()
    assert [r["forecast"] for r in f] == pytest.approx([a + b * t + season[t % 12] for t in (37, 38, 39)])


def test_arx_recovers_coefficients(spark):
    rng = np.random.default_rng(8)
    u, y = rng.normal(size=500), [0.0]
    for i in range(499):
        y.append(0.5 * y[-1] + 2.0 * u[i] + 1.0)
    pdf = pd.DataFrame({"k": 1, "t": range(500), "y": y, "u": u})
    df = spark.createDataFrame(pdf, "k int, t long, y double, u double")
    rows = TS.lagged(TS.lagged(df, ["k"], "t", "y", [1], "y_"), ["k"], "t", "u", [1], "u_")
    r = L.fit_groups(rows, ["y_1", "u_1"], "y", ["k"]).first()
    assert r["coef"] == pytest.approx([1.0, 0.5, 2.0], abs=1e-8) and r["n"] == 499


def test_runs_test_alternating(spark):
    r = residual_runs_test(series(spark, [1, -1] * 40), ["k"], "t", "v").first()
    assert r["runs"] == 80 and r["z"] > 5 and r["p"] < 1e-6


# -- classifiers and clusters ----------------------------------------------


def test_sgd_loss_falls_and_adaboost_beats_one_stump(tables):
    from tablewright.plans.learning import FEATURES, line_split, line_table

    table, best = C.sgd_logistic(line_table(tables), FEATURES, "label", [0.1, 1.0], epochs=6)
    losses = [r["log_loss"] for r in table.filter("rate = 1.0").orderBy("epoch").collect()]
    assert losses[0] == pytest.approx(math.log(2)) and losses == sorted(losses, reverse=True)
    train, test = line_split(tables)
    one, _ = C.adaboost(train, test, "features", "label", 1)
    many, log = C.adaboost(train, test, "features", "label", 6)
    acc = [C.binary_metrics(p).first()["accuracy"] for p in (one, many)]
    assert acc[1] >= acc[0] - 0.01 and acc[1] > 0.8 and all(e < 0.5 for _, e, _ in log)


def test_tree_models_beat_the_majority(tables):
    from tablewright.plans.learning import line_split

    train, test = line_split(tables)
    share = test.agg(F.avg("label")).first()[0]
    majority = max(share, 1 - share)
    for fn in (M.decision_tree, M.random_forest, M.extra_trees):
        row = fn(train, test).first()
        assert row["accuracy"] > majority and 0.5 < row["auc"] <= 1
        assert row["n"] == test.count()


def test_gaussian_within_equals_lda_direction(vectors):
    df, _ = vectors
    wide = df.select("label", *[F.col("v")[i].alias(f"x{i}") for i in range(4)])
    for cov in ("identity", "pooled", "within", "own"):
        pred = C.gaussian_discriminant(wide, wide, "label", ["x0", "x1", "x2", "x3"], cov)
        assert C.multiclass_accuracy(pred).first()["accuracy"] > 0.98
    post, classes = C.posteriors(wide, wide, "label", ["x0", "x1"], "own")
    assert classes == [0, 1, 2]
    sums = post.select(F.aggregate("posterior", F.lit(0.0), lambda a, x: a + x).alias("s")).distinct().collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in sums)


def test_min_risk_follows_the_loss(vectors):
    df, _ = vectors
    wide = df.select("label", F.col("v")[0].alias("x"))
    always2 = C.bayes_min_risk(wide, wide, "label", ["x"], [[9, 9, 0], [9, 9, 0], [9, 9, 0]])
    assert [r[0] for r in always2.select("prediction").distinct().collect()] == [2]


def test_auc_edge_values(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.8), (0, 0.1)], "y int, s double")
    assert auc_roc(df, "s", F.col("y") == 1).first()["auc"] == pytest.approx(3.5 / 4)
    one = spark.createDataFrame([(1, 0.9), (1, 0.8)], "y int, s double")
    assert auc_roc(one, "s", F.col("y") == 1).first()["auc"] is None


def test_representatives(vectors):
    df, x = vectors
    mean = C.group_representative(df, "label", "v", "mean")
    assert mean[1] == pytest.approx(x[60:120].mean(axis=0))
    g = x[60:120] - x[60:120].mean(axis=1, keepdims=True)
    u = np.linalg.svd(g)[2][0]
    want = x[60:120].mean() + u * (g.mean(axis=0) @ u)
    assert C.group_representative(df, "label", "v", "pca")[1] == pytest.approx(want, abs=1e-9)
    norm = C.group_representative(df, "label", "v", "norm")
    best = min(x[60:120], key=lambda r: ((r - x[60:120].mean(axis=0)) ** 2).sum())
    assert norm[1] == pytest.approx(best)


def test_pca_and_svd(vectors):
    df, x = vectors
    scores, share = X.pca_project(df, "v", 4)
    assert share.sum() == pytest.approx(1.0) and all(np.diff(share) <= 1e-12)
    s = np.linalg.svd(x - x.mean(0), compute_uv=False) ** 2
    assert share == pytest.approx(s / s.sum())
    got = np.array([r["approx"] for r in X.svd_low_rank(df, "v", 2).orderBy("id").collect()])
    u, d, v = np.linalg.svd(x, full_matrices=False)
    assert got == pytest.approx((u[:, :2] * d[:2]) @ v[:2], abs=1e-8)


def test_nmf_reduces_error_and_stays_positive(vectors):
    df, x = vectors
    pos = df.withColumn("p", F.transform("v", lambda a: F.abs(a)))
    h, rows = X.nmf_factors(pos, "id", "p", 2, rounds=6)
    w = np.array([r["weights"] for r in rows.orderBy("id").collect()])
    a = np.abs(x)
    assert (w >= 0).all() and (h >= 0).all()
    assert ((a - w @ h) ** 2).sum() < 0.35 * ((a - a.mean()) ** 2).sum()


def test_nystrom_is_exact_with_all_rows(vectors):
    df, x = vectors
    few = df.filter("id % 9 = 0")
    phi = np.array([r["phi"] for r in X.nystrom_features(few, "id", "v", 20, param=0.5).orderBy("id").collect()])
    sub = x[::9]
    k = np.exp(-0.5 * ((sub[:, None] - sub[None]) ** 2).sum(-1))
    assert phi @ phi.T == pytest.approx(k, abs=1e-5)


def test_kmeans_and_halves(vectors):
    df, x = vectors
    vec = df.withColumn("features", array_to_vector("v"))
    sizes = sorted(r["size"] for r in K.kmeans_clusters(vec, 3).collect())
    assert sizes == [60, 60, 60]
    ev = {r["k"]: r for r in K.kmeans_evaluate(vec, [2, 3]).collect()}
    assert ev[3]["cost"] < ev[2]["cost"] and ev[3]["silhouette"] > 0.8
    halves = K.kmeans_two_stage(df, "v", 3).groupBy("cluster").agg(
        F.max(F.when(F.col("half") == "inner", F.col("distance"))).alias("a"),
        F.min(F.when(F.col("half") == "outer", F.col("distance"))).alias("b"),
    )
    assert all(r["a"] < r["b"] for r in halves.collect())
    table, pred = K.gmm_clusters(vec, 3)
    assert table.agg(F.sum("weight")).first()[0] == pytest.approx(1.0) and pred.count() == 180


def test_bootstrap_draws(spark):
    df = spark.range(4000)
    a = SA.bootstrap_sample(df, "id", 0.8, 3)
    assert abs(a.count() - 3200) < 250
    assert a.groupBy("id").count().agg(F.max("count")).first()[0] >= 3
    b = SA.bootstrap_sample(df.repartition(5), "id", 0.8, 3)
    assert a.exceptAll(b).isEmpty()


def test_bootstrap_draws_by_the_whole_key(spark):
    period = 1 << 20
    rows = spark.range(4000).select("id", F.explode(F.array(*[F.lit(b) for b in (-1, 0, 1, 2, 1000)])).alias("block"))
    rows = rows.withColumn("key", F.col("id") + F.col("block") * period)
    n = SA.bootstrap_sample(rows, "key", 2.0, 3).groupBy("id", "block").count().toPandas()
    wide = n.pivot(index="id", columns="block", values="count").reindex(range(4000)).fillna(0).to_numpy()
    assert wide.mean(axis=0) == pytest.approx(np.full(5, 2.0), abs=0.15)
    assert abs(np.corrcoef(wide.T) - np.eye(5)).max() < 0.08


def test_bootstrap_draws_rows_without_a_key(spark):
    rows = spark.range(4000).select(F.lit(None).cast("long").alias("key"), (F.col("id") % 2).alias("x"))
    n = SA.bootstrap_sample(rows, "key", 2.0, 3).groupBy("copy").count().toPandas().set_index("copy")["count"]
    assert n.sum() == pytest.approx(8000, rel=0.1) and n[1] == pytest.approx(4000 * (1 - math.exp(-2)), rel=0.05)


def test_adf_auto_tries_all_lags(spark):
    rng = np.random.default_rng(5)
    made, want = [], {}
    for key, n, order in ((1, 400, 4), (2, 90, 3), (3, 12, 0)):
        y = np.zeros(n)
        for i in range(n):
            y[i] = 0.6 * y[i - order - 1] + rng.normal() if i > order else rng.normal()
        made += [(key, i, float(v)) for i, v in enumerate(y)]
        most, best = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)), None
        d = np.diff(y)
        dy = d[most:]
        x = np.column_stack([np.ones(len(dy)), y[most:-1], *[d[most - j : len(d) - j] for j in range(1, most + 1)]])
        for lags in range(most + 1):
            if len(dy) <= lags + 3:
                break
            z = x[:, : lags + 2]
            coef = np.linalg.lstsq(z, dy, rcond=None)[0]
            sse = float(((dy - z @ coef) ** 2).sum())
            aic = len(dy) * math.log(sse / len(dy)) + 2 * (lags + 2)
            tau = coef[1] / math.sqrt(sse / (len(dy) - lags - 2) * np.linalg.inv(z.T @ z)[1, 1])
            if best is None or aic < best[0]:
                best = (aic, lags, tau)
        want[key] = (len(dy), best[1], best[2])
    assert want[1][1] >= 2 and want[2][1] >= 2
    got = TS.adf_auto(spark.createDataFrame(made, "k int, t long, v double"), ["k"], "t", "v").collect()
    assert {r.k: (r.n, r.lags) for r in got} == {k: w[:2] for k, w in want.items()}
    for r in got:
        assert r.adf == pytest.approx(want[r.k][2], rel=1e-6) and r.p_value == pytest.approx(TS.adf_p_value(r.adf))


def test_submission_probabilities_sum_to_one(tables):
    import __spark_entry__ as entry

    df = entry.queries()["submission_table"](tables.spark, tables.sf_dir)
    cols = [c for c in df.columns if c != "vec_id"]
    assert all(abs(sum(r[c] for c in cols) - 1) < 1e-3 for r in df.collect())


def test_iterative_imputation_recovers_a_line(spark):
    from tablewright.operators.quality import impute_iterative

    pdf = pd.DataFrame({"a": np.arange(50.0)})
    pdf["b"] = 3 * pdf["a"] + 1
    pdf.loc[::6, "b"] = np.nan
    pdf.loc[2::9, "a"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    out = impute_iterative(df, ["a", "b"], rounds=25).toPandas()
    assert not out.isna().any().any()
    full = ~(pdf["a"].isna() & pdf["b"].isna())
    assert (out["b"] - 3 * out["a"] - 1)[full].abs().max() < 1.0


# -- streams and stores ----------------------------------------------------


def test_stream_equals_batch(spark, tables, tmp_path):
    from tablewright.operators.drift import psi_drift
    from tablewright.plans.process import halves
    from tablewright.streaming import jobs

    ref, new = halves(tables)
    new.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), new.schema, files_per_batch=1)
    counts = jobs.stream_psi_drift(ref, stream, ["value", "k"], str(tmp_path / "out"), str(tmp_path / "log"))
    assert counts.select("batch_id").distinct().count() == 4
    batch = {r["feature"]: r["psi"] for r in psi_drift(ref, new, ["value", "k"]).collect()}
    whole = {r["feature"]: r["psi"] for r in jobs.psi_of_batches(ref, counts, ["value", "k"]).collect()}
    assert whole == pytest.approx(batch)
    assert jobs.psi_per_batch(ref, counts, ["value", "k"]).count() == 8
    # A second run finds nothing new and changes nothing.
    stream = jobs.file_stream(spark, str(tmp_path / "in"), new.schema, files_per_batch=1)
    again = jobs.stream_psi_drift(ref, stream, ["value", "k"], str(tmp_path / "out"), str(tmp_path / "log"))
    assert again.agg(F.sum("n")).first()[0] == counts.agg(F.sum("n")).first()[0]


def test_stream_score_equals_batch(spark, tables):
    import __spark_entry__ as entry

    q = entry.queries()
    a = q["batch_score"](spark, tables.sf_dir)
    b = q["stream_score"](spark, tables.sf_dir)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_champion_is_replaced_only_by_a_better_one(tables):
    import __spark_entry__ as entry

    rows = entry.queries()["champion_challenger"](tables.spark, tables.sf_dir).orderBy("round").collect()
    assert [r["promoted"] for r in rows] == [1, 1, 0]
    assert rows[0]["champion_auc"] == -1.0 and rows[2]["champion_auc"] == rows[1]["challenger_auc"]
