"""Smoothing of whole and of cut series against the plain recursion."""

import numpy as np
import pytest

from tablewright.operators import smoothing as S


def plain(y, period, h, grid):
    """Step by step, one combination after another."""
    seasonal = period > 1 and len(y) >= 2 * period
    best = None
    for a in grid:
        for b in grid:
            for g in grid if seasonal else [0.0]:
                if seasonal:
                    level = sum(y[:period]) / period
                    trend = (sum(y[period : 2 * period]) / period - level) / period
                    season, start = [v - level for v in y[:period]], period
                else:
                    level, trend, season, start = y[0], y[1] - y[0] if len(y) > 1 else 0.0, [0.0], 1
                sse = 0.0
                for i in range(start, len(y)):
                    s = season[i % len(season)]
                    sse += (y[i] - level - trend - s) * (y[i] - level - trend - s)  # inf, where ** would raise
                    new = a * (y[i] - s) + (1 - a) * (level + trend)
                    trend, level = b * (new - level) + (1 - b) * trend, new
                    if seasonal:
                        season[i % period] = g * (y[i] - level) + (1 - g) * s
                if best is None or sse < best[0]:
                    best = (sse, a, b, g, [level + (j + 1) * trend + season[(len(y) + j) % len(season)] for j in range(h)])
    return best


def series(rng, n, period):
    i = np.arange(n)
    return 50 + 0.02 * i + 8 * np.sin(2 * np.pi * i / max(period, 2)) + np.cumsum(rng.normal(0, 0.3, n))


def same(got, y, period, h, grid, last):
    sse, a, b, g, ahead = plain(y, period, h, grid)
    got = sorted(got, key=lambda r: r.t)
    assert [r.t for r in got] == [last + j + 1 for j in range(h)]
    assert {(r.alpha, r.beta, r.gamma) for r in got} == {(a, b, g)}
    assert [r.forecast for r in got] == pytest.approx(ahead, rel=1e-9) and got[0].sse == pytest.approx(sse, rel=1e-9)


@pytest.mark.parametrize("period", [1, 4, 7])
def test_blocks_equal_the_recursion(spark, period, monkeypatch):
    monkeypatch.setattr(S, "MAP_CELLS", 200)  # several parts of the constants
    rng = np.random.default_rng(period)
    lengths = {"a": 700, None: 333, "c": 20, "d": 5, "e": 1, "f": 29}
    data = {k: series(rng, n, period) for k, n in lengths.items()}
    rows = [(k, 3 * i + 10, float(v), "x") for k, y in data.items() for i, v in enumerate(y)] + [("a", 4, None, "x"), (None, None, 5.0, "x")]
    df = spark.createDataFrame(rows, "k string, t long, value double, _i string").repartition(5)
    got = S.holt_winters(df, ["k"], "t", "value", period, 3, (0.2, 0.6), block=28).collect()
    for k, y in data.items():
        same([r for r in got if r.k == k], y.tolist(), period, 3, (0.2, 0.6), 10 + 3 * (len(y) - 1))
    assert len(got) == 3 * len(data)


def test_half_a_million_steps(spark):
    y = series(np.random.default_rng(9), 500_000, 12)
    df = spark.createDataFrame(np.c_[np.arange(len(y)), y].tolist(), "t double, value double").selectExpr("cast(t AS long) AS t", "value")
    got = S.holt_winters(df, [], "t", "value", 12, 4, (0.1, 0.5)).collect()
    same(got, y.tolist(), 12, 4, (0.1, 0.5), 499_999)


def test_no_rows(spark):
    assert S.holt_winters(spark.createDataFrame([], "k int, t long, value double"), ["k"], "t", "value", 4, 2).collect() == []
