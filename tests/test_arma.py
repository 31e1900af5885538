"""Likelihood fits against dense Gaussian algebra."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import arma as A


def psi_weights(ar, ma, n):
    out = np.zeros(n)
    out[0] = 1.0
    for j in range(1, n):
        out[j] = (ma[j - 1] if j <= len(ma) else 0.0) + sum(ar[i] * out[j - i - 1] for i in range(min(j, len(ar))))
    return out


def dense(data, ar, ma):
    """Negative log likelihood with regression and variance profiled, from the covariance matrix."""
    n = len(data)
    w = psi_weights(ar, ma, 6000 + n)
    cov = np.array([w[: len(w) - k] @ w[k:] for k in range(n)])
    full = cov[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    low = np.linalg.cholesky(full)
    white = np.linalg.solve(low, data)
    y, x = white[:, 0], white[:, 1:]
    beta = np.linalg.lstsq(x, y, rcond=None)[0] if x.shape[1] else np.zeros(0)
    var = ((y - x @ beta) ** 2).sum() / n
    return 0.5 * (n * (math.log(2 * math.pi * var) + 1) + 2 * np.log(np.diag(low)).sum()), beta, var


def simulate(rng, n, ar, ma, burn=300):
    e = rng.normal(size=n + burn)
    z = np.zeros(n + burn)
    for t in range(n + burn):
        z[t] = e[t] + sum(c * z[t - i - 1] for i, c in enumerate(ar) if t > i) + sum(c * e[t - i - 1] for i, c in enumerate(ma) if t > i)
    return z[burn:]


@pytest.mark.parametrize("order,season", [((1, 0, 0, 0), 0), ((0, 1, 0, 0), 0), ((2, 1, 0, 0), 0), ((1, 1, 1, 1), 4), ((0, 1, 0, 1), 12), ((0, 0, 0, 0), 0), ((2, 0, 1, 0), 3)])
def test_likelihood_is_the_dense_one(order, season):
    rng = np.random.default_rng(sum(order) + season)
    points = np.array([rng.normal(0, 0.8, sum(order)) for _ in range(4)]).reshape(4, -1)
    data = np.c_[rng.normal(size=60).cumsum() / 3, np.ones(60), rng.normal(size=60)]
    table = A.moments(data, points, order, max(season, 1))
    for x, m in zip(points, table):
        nll, beta, var = A.profile(m)
        ar, ma = A.polynomials(x, order, max(season, 1))
        want = dense(data, ar, ma)
        assert nll == pytest.approx(want[0], rel=1e-8) and beta == pytest.approx(want[1], rel=1e-6) and var == pytest.approx(want[2], rel=1e-7)


def test_polynomials_multiply():
    x = np.array([0.3, -0.2, 0.5, 0.4])
    phi, theta, sphi, stheta = (v[0] for v in A.split(x, (1, 1, 1, 1)))
    ar, ma = A.polynomials(x, (1, 1, 1, 1), 4)
    assert ar == pytest.approx([phi, 0, 0, sphi, -phi * sphi]) and ma == pytest.approx([theta, 0, 0, stheta, theta * stheta])


def test_search_ends_at_a_least_point():
    rng = np.random.default_rng(3)
    z = simulate(rng, 400, [0.6], [0.4])
    data = np.c_[z, np.ones(400)]
    order = (1, 1, 0, 0)
    s = A.fit_array(data, order, 1)
    phi, theta, *_ = A.split(np.array(s["x"]), order)
    assert phi[0] == pytest.approx(0.6, abs=0.12) and theta[0] == pytest.approx(0.4, abs=0.12)
    near = np.array(s["x"]) + rng.normal(0, 0.02, (40, 2))
    grid = np.stack(np.meshgrid(np.linspace(-2, 2, 21), np.linspace(-2, 2, 21)), -1).reshape(-1, 2)
    for points in (near, grid):
        assert min(A.profile(m)[0] for m in A.moments(data, points, order, 1)) >= s["f"] - 1e-6


def test_blocks_give_the_fit_of_the_whole(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k, n in (("a", 900), (None, 640), ("c", 90), ("d", 2)):
        x = rng.normal(size=n)
        y = 5 + 2 * x + simulate(rng, n, [0.5], [0.3])
        rows += [(k, 2 * i, float(v), float(w), "z") for i, (v, w) in enumerate(zip(y, x))]
    rows += [("a", 1, None, 1.0, "z"), ("c", None, 1.0, 1.0, "z")]
    df = spark.createDataFrame(rows, "k string, t long, v double, x double, _sid string").repartition(4)
    future = spark.createDataFrame([(k, 2 * n + j - 1, float(j)) for k, n in (("a", 900), (None, 640), ("c", 90)) for j in (0, 1, 3)], "k string, t long, x double")
    args = (df, ["k"], "t", "v", (1, 0, 1), 1, 4)
    whole = A.forecast(*args, xs=["x"], future=future).orderBy("k", "t").collect()
    cut = A.forecast(*args, xs=["x"], future=future, block=300, warm=120).orderBy("k", "t").collect()
    assert [(r.k, r.t) for r in whole] == [(r.k, r.t) for r in cut] and {r.k for r in whole} == {"a", None, "c"}
    assert sorted(r.t for r in whole if r.k == "a") == [1799, 1800, 1802]
    for a, b in zip(whole, cut):
        assert b.nll == pytest.approx(a.nll, rel=1e-7) and b.forecast == pytest.approx(a.forecast, rel=1e-4) and b.low == pytest.approx(a.low, rel=1e-3)
        assert a.low < a.forecast < a.high


def test_forecast_is_the_conditional_mean(spark):
    """Differences at given parameters: the mean and variance of what follows, from the joint covariance."""
    rng = np.random.default_rng(6)
    z = simulate(rng, 80, [0.7], [])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(z)], "t long, v double")
    got = A.forecast(df, [], "t", "v", (1, 0, 0), 1, 3).orderBy("t").collect()
    s = A.fit_array(np.c_[z, np.ones(80)], (1, 0, 0, 0), 1)
    _, beta, var = A.profile(np.array(s["m"]))
    phi = A.split(np.array(s["x"]), (1, 0, 0, 0))[0][0]
    want = [beta[0] + phi ** (j + 1) * (z[-1] - beta[0]) for j in range(3)]
    half = [1.959963984540054 * math.sqrt(var * sum(phi ** (2 * i) for i in range(j + 1))) for j in range(3)]
    assert [r.forecast for r in got] == pytest.approx(want, rel=1e-9)
    assert [r.high - r.forecast for r in got] == pytest.approx(half, rel=1e-9)


def test_seasonal_forecast_follows_trend_and_season(spark):
    rng = np.random.default_rng(8)
    i = np.arange(120)
    y = 100 + 0.8 * i + 10 * np.sin(2 * np.pi * i / 12) + rng.normal(0, 0.5, 120)
    df = spark.createDataFrame([(int(t), float(v)) for t, v in zip(i, y)], "t long, v double")
    got = A.forecast(df, [], "t", "v", (0, 1, 1), 12, 12, seasonal=(0, 1, 1)).orderBy("t").collect()
    j = np.arange(120, 132)
    assert np.abs(np.array([r.forecast for r in got]) - (100 + 0.8 * j + 10 * np.sin(2 * np.pi * j / 12))).max() < 3
    widths = [r.high - r.low for r in got]
    assert all(b >= a for a, b in zip(widths, widths[1:]))


def test_order_search_finds_the_best_of_the_grid(spark):
    rng = np.random.default_rng(12)
    data = {"a": simulate(rng, 250, [0.7], []), None: simulate(rng, 250, [], [0.8]), "c": rng.normal(size=3)}
    df = spark.createDataFrame([(k, i, float(v)) for k, y in data.items() for i, v in enumerate(y)], "k string, t long, v double")
    got = A.order_search(df, ["k"], "t", "v", 4, most=(2, 1, 1, 0)).collect()
    for k in ("a", None):
        tried = {(r.p, r.q, r.sp, r.sq): r for r in got if r.k == k}
        grid = {}
        for order in [(p, q, sp, 0) for p in range(3) for q in range(2) for sp in range(2)]:
            s = A.fit_array(np.c_[data[k], np.ones(250)], order, 4)
            grid[order] = 2 * s["f"] + 2 * (sum(order) + 2)
        for order, r in tried.items():
            assert r.aic == pytest.approx(grid[order], rel=1e-9) and r.n == 250
        best = [o for o, r in tried.items() if r.best]
        assert best == [min(grid, key=grid.get)] and 4 < len(tried) <= 12
    cut = A.order_search(df.filter("k = 'a'"), ["k"], "t", "v", 1, most=(1, 0, 0, 0), block=120, warm=60).collect()
    assert {(r.p, r.best): r.aic for r in cut}[(1, 1)] == pytest.approx(next(r.aic for r in got if (r.k, r.p, r.q, r.sp) == ("a", 1, 0, 0)), rel=1e-6)
    ahead = A.forecast_best(df, ["k"], "t", "v", spark.createDataFrame(got), 4, 2).collect()
    assert sorted((str(r.k), r.t) for r in ahead) == [("None", 250), ("None", 251), ("a", 250), ("a", 251)] or {r.k for r in ahead} >= {"a", None}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k int, t long, v double")
    assert A.forecast(empty, ["k"], "t", "v", (1, 0, 0), 1, 2).collect() == []
    assert A.order_search(empty, ["k"], "t", "v", 1).collect() == []
    assert A.prepared(empty, ["k"], "t", "v", []).withColumn("z", F.lit(1)).count() == 0
