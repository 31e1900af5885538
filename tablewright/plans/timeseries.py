"""Series tests, decompositions and forecasts."""

from functools import reduce

from pyspark.sql import functions as F

from tablewright.operators import arma
from tablewright.operators import timeseries as TS
from tablewright.operators.linear import fit_groups
from tablewright.operators.series import lag_features, time_split
from tablewright.plans.bindings import DAILY, LOOPS, MONTHLY
from tablewright.plans.registry import query
from tablewright.plans.relational import rounded

K = ["series_id"]


@query(
    "acf",
    f"""
    WITH {DAILY}, d AS (SELECT series_id, t, value - avg(value) OVER (PARTITION BY series_id) AS d FROM daily)
    SELECT a.series_id, CAST(k AS INTEGER) AS lag, round(sum(a.d * b.d) / any_value(s), 6) AS acf
    FROM d a JOIN (SELECT unnest(range(0, 8)) AS k) ON true JOIN d b ON a.series_id = b.series_id AND b.t = a.t - k
    JOIN (SELECT series_id, sum(d * d) AS s FROM d GROUP BY 1) v ON v.series_id = a.series_id GROUP BY ALL
    """,
)
def acf(t):
    return rounded(TS.acf(t.daily, K, "t", "value", 7), 6)


@query(
    "pacf",
    f"""
    WITH {DAILY}, d AS (SELECT series_id, t, value - avg(value) OVER (PARTITION BY series_id) AS d FROM daily),
    r AS (SELECT series_id, sum(d * d1) / sum(d * d) AS r1, sum(d * d2) / sum(d * d) AS r2 FROM (SELECT series_id, d,
      coalesce(lag(d, 1) OVER w, 0) AS d1, coalesce(lag(d, 2) OVER w, 0) AS d2 FROM d WINDOW w AS (PARTITION BY series_id ORDER BY t)) GROUP BY 1)
    SELECT series_id, 0 AS lag, 1.0::DOUBLE AS pacf FROM r UNION ALL SELECT series_id, 1, round(r1, 6) FROM r
    UNION ALL SELECT series_id, 2, round((r2 - r1 * r1) / (1 - r1 * r1), 6) FROM r
    """,
)
def pacf(t):
    return rounded(TS.pacf(t.daily, K, "t", "value", 2), 6)


@query(
    "adf_test",
    f"""
    WITH {MONTHLY}, d AS (SELECT series_id, value - lag(value) OVER w AS dy, lag(value) OVER w AS x FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY t)),
    f AS (SELECT series_id, count(*) AS n, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx,
      regr_syy(dy, x) - regr_sxy(dy, x) * regr_sxy(dy, x) / regr_sxx(dy, x) AS sse FROM d WHERE x IS NOT NULL GROUP BY 1),
    s AS (SELECT series_id, n, b / sqrt(sse / (n - 2) / sxx) AS adf FROM f)
    SELECT series_id, n, round(adf, 4) AS adf, CAST(adf < -2.86154 AS INTEGER) AS stationary FROM s
    """,
)
def adf_test(t):
    return rounded(TS.adf_test(t.monthly, K, "t", "value", 0))


@query(
    "kpss_test",
    f"""
    WITH {MONTHLY}, d AS (SELECT series_id, t, value - avg(value) OVER (PARTITION BY series_id) AS d FROM monthly),
    l AS (SELECT *, sum(d) OVER w AS s, coalesce(lag(d, 1) OVER w, 0) AS d1, coalesce(lag(d, 2) OVER w, 0) AS d2,
      coalesce(lag(d, 3) OVER w, 0) AS d3, coalesce(lag(d, 4) OVER w, 0) AS d4 FROM d WINDOW w AS (PARTITION BY series_id ORDER BY t)),
    k AS (SELECT series_id, count(*) AS n, (sum(s * s) / (count(*)::DOUBLE * count(*))) / ((sum(d * d) + 2 * (0.8 * sum(d * d1) + 0.6 * sum(d * d2)
      + 0.4 * sum(d * d3) + 0.2 * sum(d * d4))) / count(*)) AS kpss FROM l GROUP BY 1)
    SELECT series_id, n, round(kpss, 4) AS kpss, CAST(kpss < 0.463 AS INTEGER) AS stationary FROM k
    """,
)
def kpss_test(t):
    return rounded(TS.kpss_test(t.monthly, K, "t", "value", 4))


@query(
    "kpss_auto",
    f"""
    WITH {MONTHLY}, d AS (SELECT series_id, t, value - avg(value) OVER (PARTITION BY series_id) AS d, count(*) OVER (PARTITION BY series_id) AS n FROM monthly),
    g AS (SELECT a.series_id, a.n, a.t - b.t AS j, sum(a.d * b.d) AS g FROM d a JOIN d b ON a.series_id = b.series_id AND b.t <= a.t GROUP BY ALL),
    s AS (SELECT series_id, n, sum(CASE WHEN j = 0 THEN g / n ELSE 2 * g / n END) AS s0, sum(2 * j * g / n) AS s1 FROM g WHERE j <= floor(pow(n, 2 / 9.0)) GROUP BY ALL),
    a AS (SELECT series_id, n, CAST(least(floor(1.1447 * pow(pow(s1 / s0, 2), 1 / 3.0) * pow(n, 1 / 3.0)), n - 1) AS INTEGER) AS lags FROM s),
    v AS (SELECT series_id, a.n, lags, sum(CASE WHEN j = 0 THEN g ELSE 2 * (1 - j / (lags + 1.0)) * g END) / any_value(a.n) AS lr FROM g JOIN a USING (series_id) WHERE j <= lags GROUP BY ALL),
    c AS (SELECT series_id, sum(d) OVER (PARTITION BY series_id ORDER BY t) AS s FROM d),
    e AS (SELECT series_id, sum(s * s) AS eta FROM c GROUP BY 1),
    k AS (SELECT series_id, n, lags, eta / (n::DOUBLE * n) / lr AS kpss FROM v JOIN e USING (series_id))
    SELECT series_id, n, lags, round(kpss, 4) AS kpss, round(CASE WHEN kpss < 0.347 THEN 0.1 WHEN kpss < 0.463 THEN 0.1 - (kpss - 0.347) * 0.05 / 0.116
      WHEN kpss < 0.574 THEN 0.05 - (kpss - 0.463) * 0.025 / 0.111 WHEN kpss < 0.739 THEN 0.025 - (kpss - 0.574) * 0.015 / 0.165 ELSE 0.01 END, 4) AS p_value,
      CAST(kpss < 0.463 AS INTEGER) AS stationary FROM k
    """,
)
def kpss_auto(t):
    return rounded(TS.kpss_auto(t.monthly, K, "t", "value"))


@query(
    "stationarity_report",
    f"""
    WITH {MONTHLY}, d AS (SELECT series_id, t, value, value - lag(value) OVER w AS dy, lag(value) OVER w AS x,
      value - avg(value) OVER (PARTITION BY series_id) AS d FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY t)),
    f AS (SELECT series_id, count(*) AS n, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx,
      regr_syy(dy, x) - regr_sxy(dy, x) * regr_sxy(dy, x) / regr_sxx(dy, x) AS sse FROM d WHERE x IS NOT NULL GROUP BY 1),
    a AS (SELECT series_id, b / sqrt(sse / (n - 2) / sxx) AS adf FROM f),
    c AS (SELECT *, sum(d) OVER (PARTITION BY series_id ORDER BY t) AS s,
      CASE WHEN count(*) OVER r = 12 THEN avg(value) OVER r END AS rm, CASE WHEN count(*) OVER r = 12 THEN stddev_samp(value) OVER r END AS rs
      FROM d WINDOW r AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
    k AS (SELECT series_id, (sum(s * s) / (count(*)::DOUBLE * count(*))) / (sum(d * d) / count(*)) AS kpss,
      stddev_samp(rm) AS mean_spread, stddev_samp(rs) AS std_spread FROM c GROUP BY 1)
    SELECT series_id, round(adf, 4) AS adf, CAST(adf < -2.86154 AS INTEGER) AS adf_stationary, round(kpss, 4) AS kpss,
      CAST(kpss < 0.463 AS INTEGER) AS kpss_stationary, round(mean_spread, 4) AS mean_spread, round(std_spread, 4) AS std_spread,
      CASE WHEN adf < -2.86154 AND kpss < 0.463 THEN 'stationary' WHEN adf >= -2.86154 AND kpss >= 0.463 THEN 'not stationary'
        ELSE 'undecided' END AS verdict FROM a JOIN k USING (series_id)
    """,
)
def stationarity_report(t):
    return rounded(TS.stationarity_report(t.monthly, K, "t", "value", 0, 12))


@query(
    "welch_psd",
    f"""
    WITH {MONTHLY}, i AS (SELECT series_id, t - min(t) OVER (PARTITION BY series_id) AS i, value, count(*) OVER (PARTITION BY series_id) AS n FROM monthly),
    g AS (SELECT series_id, s, i - 16 * s AS j, value FROM i, (SELECT unnest(range(0, (SELECT max(i) // 16 + 1 FROM i))) AS s)
      WHERE i >= 16 * s AND i < 16 * s + 32 AND 16 * s + 32 <= n),
    w AS (SELECT series_id, s, j, (value - avg(value) OVER (PARTITION BY series_id, s)) * (0.5 - 0.5 * cos(2 * pi() * j / 32)) AS x FROM g),
    p AS (SELECT series_id, s, k, (pow(sum(x * cos(2 * pi() * k * j / 32)), 2) + pow(sum(x * sin(2 * pi() * k * j / 32)), 2)) / 12
      AS pw FROM w, (SELECT unnest(range(0, 17)) AS k) GROUP BY series_id, s, k)
    SELECT series_id, CAST(k AS INTEGER) AS bin, round(k / 32, 6) AS frequency,
      round(avg(pw * CASE WHEN k IN (0, 16) THEN 1 ELSE 2 END) / 1e9, 4) AS power FROM p GROUP BY series_id, k
    """,
)
def welch_psd(t):
    psd = TS.welch_psd(t.monthly, K, "t", "value", 32)
    return psd.select(
        "series_id", "bin", F.round("frequency", 6).alias("frequency"), F.round(F.col("power") / 1e9, 4).alias("power")
    )


_LINE = """line AS (SELECT series_id, regr_slope(value, t) AS b, regr_intercept(value, t) AS a, max(t) AS last FROM monthly GROUP BY 1),
season AS (SELECT series_id, t % 12 AS pos, avg(value - (a + b * t)) AS season FROM monthly JOIN line USING (series_id) GROUP BY ALL)"""


@query(
    "decompose_additive",
    f"""
    WITH {MONTHLY}, {_LINE}
    SELECT series_id, t, round(value, 2) AS value, round(a + b * t, 2) AS trend, round(season, 2) AS season,
      round(a + b * t + season, 2) AS fitted FROM monthly JOIN line USING (series_id)
    JOIN season ON season.series_id = monthly.series_id AND pos = t % 12
    """,
)
def decompose_additive(t):
    return rounded(TS.decompose_additive(t.monthly, K, "t", "value", 12), 2)


@query(
    "decompose_moving_average",
    f"""
    WITH {MONTHLY}, tr AS (SELECT series_id, t, value, CASE WHEN count(*) OVER (w ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13 THEN
      (avg(value) OVER (w ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING) + avg(value) OVER (w ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 END AS trend
      FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY t)),
    raw AS (SELECT series_id, t % 12 AS pos, avg(value - trend) AS r FROM tr GROUP BY ALL),
    s AS (SELECT series_id, pos, r - avg(r) OVER (PARTITION BY series_id) AS season FROM raw)
    SELECT tr.series_id, t, round(value, 5) AS value, round(trend, 5) AS trend, round(season, 5) AS season,
      round(value - trend - season, 5) AS remainder FROM tr JOIN s ON tr.series_id = s.series_id AND pos = t % 12
    """,
)
def decompose_moving_average(t):
    return rounded(TS.decompose_moving_average(t.monthly, K, "t", "value", 12), 5)


@query(
    "forecast_trend_seasonal",
    f"""
    WITH {MONTHLY}, {_LINE}, fut AS (SELECT series_id, a, b, unnest(range(last + 1, last + 7)) AS t FROM line)
    SELECT fut.series_id, t, round(a + b * t + season, 2) AS forecast FROM fut JOIN season ON fut.series_id = season.series_id AND pos = t % 12
    """,
)
def forecast_trend_seasonal(t):
    return rounded(TS.forecast_trend_seasonal(t.monthly, K, "t", "value", 12, 6), 2)


@query(
    "forecast_drift",
    f"""
    WITH {MONTHLY}, e AS (SELECT series_id, max(t) AS last, arg_max(value, t) AS v1, arg_min(value, t) AS v0, count(*) AS n FROM monthly GROUP BY 1),
    f AS (SELECT *, unnest(range(last + 1, last + 7)) AS t FROM e)
    SELECT series_id, t, round(v1 + (v1 - v0) / (n - 1) * (t - last), 2) AS forecast FROM f
    """,
)
def forecast_drift(t):
    return rounded(TS.forecast_drift(t.monthly, K, "t", "value", 6), 2)


@query(
    "forecast_holt_winters",
    f"""
    WITH RECURSIVE {MONTHLY}, y AS (SELECT series_id, list(value ORDER BY t) AS y, max(t) AS last FROM monthly GROUP BY 1),
    g(c) AS (VALUES (0.1::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE), (0.9::DOUBLE)),
    r AS (
      SELECT series_id, a.c AS a, b.c AS b, s.c AS g, 12 AS i, list_avg(y[1:12]) AS level, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS trend,
        list_transform(y[1:12], lambda v: v - list_avg(y[1:12])) AS season, 0::DOUBLE AS sse FROM y, g a, g b, g s WHERE len(y) >= 24
      UNION ALL SELECT series_id, a, b, g, i + 1, new, b * (new - level) + (1 - b) * trend,
        list_append(season[2:12], g * (v - new) + (1 - g) * season[1]), sse + pow(v - level - trend - season[1], 2)
      FROM (SELECT r.*, y[i + 1] AS v, a * (y[i + 1] - season[1]) + (1 - a) * (level + trend) AS new FROM r JOIN y USING (series_id) WHERE i < len(y))),
    e AS (SELECT r.*, last, row_number() OVER (PARTITION BY series_id ORDER BY sse, a, b, g) AS place FROM r JOIN y USING (series_id) WHERE i = len(y)),
    f AS (SELECT *, unnest(range(0, 6)) AS j FROM e WHERE place = 1)
    SELECT series_id, last + j + 1 AS t, round(level + (j + 1) * trend + season[(j % 12) + 1], 2) AS forecast, a AS alpha, b AS beta, g AS gamma,
      round(sqrt(sse), 2) AS rse FROM f
    """,
)
def forecast_holt_winters(t):
    found = TS.forecast_holt_winters(t.monthly, K, "t", "value", 12, 6)
    return rounded(found.withColumn("rse", F.sqrt("sse")).drop("sse"), 2)


@query(
    "forecast_ar",
    f"""
    WITH RECURSIVE {MONTHLY}, l AS (SELECT series_id, t, value, lag(value) OVER (PARTITION BY series_id ORDER BY t) AS x FROM monthly),
    f AS (SELECT series_id, regr_slope(value, x) AS b, regr_intercept(value, x) AS a, max(t) AS last, arg_max(value, t) AS v FROM l GROUP BY 1),
    r AS (SELECT series_id, a, b, last + 1 AS t, a + b * v AS y, 1 AS i FROM f
      UNION ALL SELECT series_id, a, b, t + 1, a + b * y, i + 1 FROM r WHERE i < 6)
    SELECT series_id, t, round(y, 2) AS forecast FROM r
    """,
)
def forecast_ar(t):
    return rounded(TS.forecast_ar(t.monthly, K, "t", "value", 1, 6), 2)


@query("arima_order_search")
def arima_order_search(t):
    return rounded(TS.arima_order_search(t.monthly, K, "t", "value", [0, 1, 2], [0, 1], [0, 1, 2]))


@query("forecast_sarima")
def forecast_sarima(t):
    return rounded(TS.forecast_sarima(t.monthly, K, "t", "value", (1, 0, 1), 12, 6), 2)


@query(
    "forecast_seasonal_drift",
    f"""
    WITH {MONTHLY}, z AS (SELECT series_id, t, value, value - lag(value, 12) OVER (PARTITION BY series_id ORDER BY t) AS z FROM monthly),
    f AS (SELECT series_id, avg(z) AS m, var_pop(z) AS v, 0.5 * count(z) * (ln(2 * pi() * var_pop(z)) + 1) AS nll, max(t) AS last FROM z GROUP BY 1)
    SELECT series_id, t + 12 AS t, round(value + m, 2) AS forecast, round(value + m - 1.959963984540054 * sqrt(v), 2) AS low,
      round(value + m + 1.959963984540054 * sqrt(v), 2) AS high, round(nll, 2) AS nll FROM z JOIN f USING (series_id) WHERE t + 12 > last AND t + 12 <= last + 6
    """,
)
def forecast_seasonal_drift(t):
    """The likelihood model without ARMA terms: a seasonal difference and its mean."""
    return rounded(arma.forecast(t.monthly, K, "t", "value", (0, 0, 0), 12, 6, seasonal=(0, 1, 0)), 2)


@query("arima_order_lattice")
def arima_order_lattice(t):
    """Stepwise search over plain and seasonal orders: every order tried, and the best of each series."""
    found = arma.order_search(t.monthly, K, "t", "value", 12, d=0, sd=1, most=(2, 2, 0, 1))
    return rounded(found, 1)


@query("forecast_best_order")
def forecast_best_order(t):
    """Forecasts by the order that the search finds for each series."""
    orders = arma.order_search(t.monthly, K, "t", "value", 12, d=0, sd=1, most=(1, 1, 0, 1))
    return rounded(arma.forecast_best(t.monthly, K, "t", "value", orders, 12, 6), 0)


@query("forecast_sarima_likelihood")
def forecast_sarima_likelihood(t):
    """Multiplicative seasonal ARMA by exact likelihood."""
    return rounded(arma.forecast(t.monthly, K, "t", "value", (1, 0, 1), 12, 6, seasonal=(0, 1, 1)), 0)


def shipped(t):
    """Monthly value with the number of orders of the month as an outside regressor."""
    months = t.orders.groupBy(
        F.col("o_orderpriority").alias("series_id"), (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("long").alias("t")
    ).agg(F.count(F.lit(1)).cast("double").alias("orders"))
    return t.monthly.join(months, ["series_id", "t"], "left").fillna(0.0, ["orders"])


@query(
    "forecast_regressor",
    f"""
    WITH {MONTHLY}, c AS (SELECT o_orderpriority AS series_id, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS t, count(*) AS orders FROM orders GROUP BY ALL),
    r AS (SELECT series_id, t, value, coalesce(orders, 0) AS x, max(t) OVER (PARTITION BY series_id) AS last FROM monthly LEFT JOIN c USING (series_id, t)),
    f AS (SELECT series_id, regr_slope(value, x) AS b, regr_intercept(value, x) AS a, regr_count(value, x) AS n,
      regr_syy(value, x) - pow(regr_sxy(value, x), 2) / regr_sxx(value, x) AS sse FROM r WHERE t <= last - 6 GROUP BY 1)
    SELECT series_id, t, round(a + b * x, 2) AS forecast, round(a + b * x - 1.959963984540054 * sqrt(sse / n), 2) AS low,
      round(a + b * x + 1.959963984540054 * sqrt(sse / n), 2) AS high, round(0.5 * n * (ln(2 * pi() * sse / n) + 1), 2) AS nll
    FROM r JOIN f USING (series_id) WHERE t > last - 6
    """,
)
def forecast_regressor(t):
    """The same model with a regressor known for the last six months, and no ARMA terms."""
    rows = shipped(t)
    ends = rows.groupBy(*K).agg(F.max("t").alias("last"))
    known = rows.join(ends, K)
    past, future = known.filter(F.col("t") <= F.col("last") - 6), known.filter(F.col("t") > F.col("last") - 6)
    found = arma.forecast(past, K, "t", "value", (0, 0, 0), 1, 6, xs=["orders"], future=future)
    return rounded(found, 2)


@query("forecast_arma_errors")
def forecast_arma_errors(t):
    """Regression on the month's orders with ARMA errors."""
    rows = shipped(t)
    ends = rows.groupBy(*K).agg(F.max("t").alias("last"))
    known = rows.join(ends, K)
    past, future = known.filter(F.col("t") <= F.col("last") - 6), known.filter(F.col("t") > F.col("last") - 6)
    return rounded(arma.forecast(past, K, "t", "value", (1, 0, 1), 1, 6, xs=["orders"], future=future), 0)


@query(
    "forecast_sarima_seasonal",
    f"""
    WITH {MONTHLY}, z AS (SELECT series_id, t, value, value - lag(value, 12) OVER (PARTITION BY series_id ORDER BY t) AS z FROM monthly),
    x AS (SELECT *, lag(z, 12) OVER (PARTITION BY series_id ORDER BY t) AS x, max(t) OVER (PARTITION BY series_id) AS last FROM z),
    f AS (SELECT series_id, regr_slope(z, x) AS b, regr_intercept(z, x) AS a, regr_count(z, x) AS n,
      regr_syy(z, x) - pow(regr_sxy(z, x), 2) / regr_sxx(z, x) AS sse FROM x GROUP BY 1),
    o AS (SELECT series_id, t + 12 AS t, value + a + b * z AS y, 1.96 * sqrt(sse / (n - 2)) AS h FROM x JOIN f USING (series_id) WHERE t + 12 > last AND t + 12 <= last + 6)
    SELECT series_id, t, round(y, 2) AS forecast, round(y - h, 2) AS low, round(y + h, 2) AS high FROM o
    """,
)
def forecast_sarima_seasonal(t):
    return rounded(TS.forecast_sarima(t.monthly, K, "t", "value", (0, 0, 0), 12, 6, seasonal=(1, 1, 0)), 2)


@query(
    "adf_auto",
    f"""
    WITH {MONTHLY}, d AS (SELECT series_id, t, value - lag(value) OVER w AS dy, lag(value) OVER w AS x0,
      lag(value) OVER w - lag(value, 2) OVER w AS x1 FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY t)),
    m AS (SELECT series_id, count(*) AS n, count(*) * var_pop(dy) AS yy, count(*) * var_pop(x0) AS aa, count(*) * var_pop(x1) AS bb,
      count(*) * covar_pop(x0, x1) AS ab, count(*) * covar_pop(x0, dy) AS ay, count(*) * covar_pop(x1, dy) AS byy FROM d WHERE x1 IS NOT NULL GROUP BY 1),
    c AS (SELECT *, yy - ay * ay / aa AS s0, aa * bb - ab * ab AS det, (bb * ay - ab * byy) / (aa * bb - ab * ab) AS g0, (aa * byy - ab * ay) / (aa * bb - ab * ab) AS g1 FROM m),
    e AS (SELECT *, yy - g0 * ay - g1 * byy AS s1 FROM c),
    f AS (SELECT series_id, n, CASE WHEN n * ln(s1 / n) + 6 < n * ln(s0 / n) + 4 THEN 1 ELSE 0 END AS lags, ay / aa / sqrt(s0 / (n - 2) / aa) AS t0,
      g0 / sqrt(s1 / (n - 3) * bb / det) AS t1 FROM e)
    SELECT series_id, n, CAST(lags AS INTEGER) AS lags, round(CASE WHEN lags = 1 THEN t1 ELSE t0 END, 4) AS adf,
      CAST(CASE WHEN lags = 1 THEN t1 ELSE t0 END < -2.86154 AS INTEGER) AS stationary FROM f
    """,
)
def adf_auto(t):
    return rounded(TS.adf_auto(t.monthly, K, "t", "value", 1).drop("p_value"))


@query("adf_auto_all_lags")
def adf_auto_all_lags(t):
    """``adf_auto`` with the usual maximum of lags for each series; its SQL is of two orders."""
    return rounded(TS.adf_auto(t.monthly, K, "t", "value"))


@query("forecast_fourier")
def forecast_fourier(t):
    return rounded(TS.forecast_fourier(t.monthly, K, "t", "value", 12, 2, 6), 2)


@query(
    "rolling_origin_backtest",
    f"""
    WITH {MONTHLY}, l AS (SELECT series_id, t, value, lag(value) OVER (PARTITION BY series_id ORDER BY t) AS x,
      max(t) OVER (PARTITION BY series_id) AS last FROM monthly),
    f AS (SELECT o.series_id, o.t, o.value AS actual, o.x, regr_slope(h.value, h.x) AS b, regr_intercept(h.value, h.x) AS a
      FROM l o JOIN l h ON h.series_id = o.series_id AND h.t < o.t AND h.x IS NOT NULL WHERE o.t > o.last - 8 GROUP BY ALL)
    SELECT series_id, t, round(actual, 2) AS actual, round(a + b * x, 2) AS forecast FROM f
    """,
)
def rolling_origin_backtest(t):
    return rounded(TS.rolling_origin_backtest(t.monthly, K, "t", "value", 1, 8), 2)


@query(
    "compare_forecasts",
    f"""
    WITH {MONTHLY}, p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY t) <= floor(count(*) OVER (PARTITION BY series_id) * 0.8) AS train FROM monthly),
    e AS (SELECT series_id, max(t) AS last, arg_max(value, t) AS v1, arg_min(value, t) AS v0, count(*) AS n,
      regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM p WHERE train GROUP BY 1),
    s AS (SELECT series_id, t % 12 AS pos, avg(value - (a + b * t)) AS season FROM p JOIN e USING (series_id) WHERE train GROUP BY ALL),
    f AS (SELECT 'drift' AS model, p.value AS y, v1 + (v1 - v0) / (n - 1) * (t - last) AS f FROM p JOIN e USING (series_id) WHERE NOT train
      UNION ALL SELECT 'trend_seasonal', p.value, a + b * t + coalesce(season, 0) FROM p JOIN e USING (series_id)
        LEFT JOIN s ON s.series_id = p.series_id AND pos = t % 12 WHERE NOT train),
    m AS (SELECT model, count(*) AS n, avg(abs(y - f)) AS mae, sqrt(avg((y - f) * (y - f))) AS rmse,
      1 - avg((y - f) * (y - f)) / var_pop(y) AS r2, avg(abs((y - f) / nullif(y, 0))) AS mape FROM f GROUP BY 1)
    SELECT model, n, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2, round(mape, 4) AS mape,
      CAST(row_number() OVER (ORDER BY mape, model) = 1 AS INTEGER) AS winner FROM m
    """,
)
def compare_forecasts(t):
    parts = time_split(t.monthly, K, "t", 0.8)
    train, test = parts.filter("part = 'train'").drop("part"), parts.filter("part = 'test'").drop("part")
    # The horizon is the longest test part; shorter series match fewer steps.
    h = test.groupBy(*K).count().agg(F.max("count")).first()[0]
    models = {
        "drift": TS.forecast_drift(train, K, "t", "value", h),
        "trend_seasonal": TS.forecast_trend_seasonal(train, K, "t", "value", 12, h),
    }
    scored = reduce(
        lambda a, b: a.unionByName(b),
        [test.join(f, [*K, "t"]).withColumn("model", F.lit(m)) for m, f in models.items()],
    )
    return rounded(TS.compare_forecasts(scored, "model", "value", "forecast"))


@query(
    "arx_fit",
    f"""
    WITH {LOOPS}, r AS (SELECT loop_id, pv AS y, lag(pv) OVER w AS p, lag(op) OVER w AS o, lag(abs(sp - pv)) OVER w AS d
      FROM loops WINDOW w AS (PARTITION BY loop_id ORDER BY t)),
    m AS (SELECT loop_id, count(*) AS n, avg(y) AS my, avg(p) AS mp, avg(o) AS mo, avg(d) AS md, var_pop(y) AS yy,
      var_pop(p) AS a, covar_pop(p, o) AS b, covar_pop(p, d) AS c, var_pop(o) AS dd, covar_pop(o, d) AS e, var_pop(d) AS f,
      covar_pop(p, y) AS v1, covar_pop(o, y) AS v2, covar_pop(d, y) AS v3 FROM r WHERE p IS NOT NULL GROUP BY 1),
    s AS (SELECT *, a * (dd * f - e * e) - b * (b * f - c * e) + c * (b * e - c * dd) AS det FROM m),
    k AS (SELECT *, (v1 * (dd * f - e * e) - b * (v2 * f - e * v3) + c * (v2 * e - dd * v3)) / det AS b1,
      (a * (v2 * f - e * v3) - v1 * (b * f - c * e) + c * (b * v3 - v2 * c)) / det AS b2,
      (a * (dd * v3 - v2 * e) - b * (b * v3 - v2 * c) + v1 * (b * e - dd * c)) / det AS b3 FROM s),
    g AS (SELECT *, yy - b1 * v1 - b2 * v2 - b3 * v3 AS mse FROM k)
    SELECT loop_id, n, round(my - b1 * mp - b2 * mo - b3 * md, 4) AS const, round(b1, 4) AS b_pv, round(b2, 4) AS b_op,
      round(b3, 4) AS b_demand, round(sqrt(mse), 4) AS rmse, round(1 - mse / yy, 4) AS r2 FROM g
    """,
)
def arx_fit(t):
    """Each loop's pv on its last value, the last op and, as demand, the last distance from sp."""
    from tablewright.operators.loops import KEY

    rows = TS.lagged(t.loops.withColumn("demand", F.abs(F.col("sp") - F.col("pv"))), KEY, "t", "pv", [1], "pv_")
    rows = TS.lagged(rows, KEY, "t", "op", [1], "op_")
    rows = TS.lagged(rows, KEY, "t", "demand", [1], "demand_")
    fits = fit_groups(rows, ["pv_1", "op_1", "demand_1"], "pv", KEY)
    return rounded(
        fits.select(
            "loop_id",
            "n",
            *[F.col("coef")[i].alias(n) for i, n in enumerate(["const", "b_pv", "b_op", "b_demand"])],
            F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
            "r2",
        )
    )
