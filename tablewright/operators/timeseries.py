"""Tests, spectra, decompositions and forecasts for many series at once.

Input: long ``(keys..., t, value)`` with a dense integer step ``t``. Lags come
from block windows, fits from moment aggregates per series; Python sees moment
rows, or the last few steps of a series.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.distributions import normal_cdf
from tablewright.operators.evaluate import mape, regression_metrics
from tablewright.operators.joins import null_safe_join
from tablewright.operators.linear import fit_groups, moments, solve_row
from tablewright.operators.ordering import block_scan, step_window
from tablewright.operators.series import fourier_terms, lag_diff, rolling_mean_std
from tablewright.operators.skew import attach
from tablewright.operators.smoothing import holt_winters as forecast_holt_winters  # noqa: F401
from tablewright.session import pin_small

# Published asymptotic critical values, constant case, at 1, 5 and 10 percent.
ADF_CRITICAL = {"1%": -3.43035, "5%": -2.86154, "10%": -2.56677}
# MacKinnon (1994), constant case.
ADF_TAU_STAR, ADF_TAU_MIN, ADF_TAU_MAX = -1.61, -18.83, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
KPSS_CRITICAL = {"10%": 0.347, "5%": 0.463, "2.5%": 0.574, "1%": 0.739}


def _schema(df: DataFrame, keys: Sequence[str], extra: str) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + T._parse_datatype_string(extra).fields)


def centred(df: DataFrame, keys, value: str, out: str = "_d") -> DataFrame:
    means = df.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    return attach(df, means, keys).withColumn(out, F.col(value) - F.col("_mean")).drop("_mean")


def lagged(df: DataFrame, keys, t: str, column: str, lags: Sequence[int], prefix: str) -> DataFrame:
    """Columns prefix1.. with the value ``lag`` steps earlier (later if negative)."""
    c = F.col(column)
    before, after = max([0, *lags]), max([0, *[-x for x in lags]])
    return step_window(
        df, keys, t, lambda w: {f"{prefix}{x}": F.lag(c, x).over(w) for x in lags}, before=before, after=after
    )


def acf(df: DataFrame, keys, t: str, value: str, k: int) -> DataFrame:
    """(keys, lag, acf) for lags 0..k: all lags in one pass and one aggregate."""
    d = lagged(centred(df, keys, value), keys, t, "_d", range(1, k + 1), "_l")
    sums = d.groupBy(*keys).agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_s0"),
        *[F.coalesce(F.sum(F.col("_d") * F.col(f"_l{j}")), F.lit(0.0)).alias(f"_s{j}") for j in range(1, k + 1)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(j).alias("lag"), F.try_divide(F.col(f"_s{j}"), F.col("_s0")).alias("acf"))
            for j in range(k + 1)
        ]
    )
    return sums.select(*keys, F.inline(rows))


def pacf(df: DataFrame, keys, t: str, value: str, k: int) -> DataFrame:
    """(keys, lag, pacf): Durbin-Levinson on the k + 1 autocorrelations of each series."""
    table = acf(df, keys, t, value, k)
    lists = table.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lag", "acf"))).alias("r"))
    schema = _schema(df, keys, "lag int, pacf double")

    def recursion(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                r = [x["acf"] for x in row.r]
                head = [getattr(row, c) for c in keys]
                out.append([*head, 0, 1.0])
                if any(x is None for x in r):
                    continue
                phi, var = np.zeros(0), 1.0
                for j in range(1, len(r)):
                    back = phi @ np.array(r[j - 1 : 0 : -1]) if j > 1 else 0.0
                    a = (r[j] - back) / var if abs(var) > 1e-14 else 0.0
                    phi = np.append(phi - a * phi[::-1], a)
                    var *= 1 - a * a
                    out.append([*head, j, float(a)])
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return lists.mapInPandas(recursion, schema)


def adf_test(df: DataFrame, keys, t: str, value: str, lags: int = 0) -> DataFrame:
    """(keys, n, adf, stationary): t statistic of y(t-1) in the regression of the difference on
    it, ``lags`` lagged differences and a constant; stationary at 5 percent."""
    v = F.col(value)

    def build(w):
        diff = {f"_x{j}": F.lag(v, j).over(w) - F.lag(v, j + 1).over(w) for j in range(1, lags + 1)}
        return {"_dy": v - F.lag(v).over(w), "_x0": F.lag(v).over(w), **diff}

    rows = step_window(df, keys, t, build, before=lags + 1)
    fits = fit_groups(rows, [f"_x{j}" for j in range(lags + 1)], "_dy", keys)
    stat = F.try_divide(F.col("coef")[1], F.col("se")[1])
    return fits.select(
        *keys, "n", stat.alias("adf"), (stat < ADF_CRITICAL["5%"]).cast("int").alias("stationary")
    )


def adf_p_value(tau: float) -> float:
    """Approximate p-value of the statistic with a constant, by MacKinnon's response surface."""
    if not math.isfinite(tau):
        return float("nan")
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    coef = ADF_SMALL_P if tau <= ADF_TAU_STAR else ADF_LARGE_P
    return normal_cdf(sum(c * tau**i for i, c in enumerate(coef)))


def adf_auto(df: DataFrame, keys, t: str, value: str, max_lags: int | None = None) -> DataFrame:
    """(keys, n, lags, adf, p_value, stationary): the test with the number of lagged differences,
    0 to ``max_lags``, of the least AIC; by default 12 (n / 100)^(1/4), rounded up, for the length
    n of each series, and n / 2 - 2 at most.

    All orders are fitted on the same steps, so one row of moments per series serves them all.
    """
    v = F.col(value)
    if max_lags is None:
        size = F.count(F.lit(1))
        most = F.least(F.ceil(12 * F.pow(size / 100, F.lit(0.25))), F.floor(size / 2) - 2)
        bounds = pin_small(df.groupBy(*keys).agg(F.greatest(most, F.lit(0)).cast("int").alias("_most")))
        max_lags = bounds.agg(F.max("_most")).first()[0] or 0
        df = attach(df, bounds, keys)
    else:
        df = df.withColumn("_most", F.lit(max_lags))

    def build(w):
        # A series of fewer orders has zeros in the others, so they drop none of its steps.
        diff = {
            f"_x{j}": F.when(F.col("_most") >= j, F.lag(v, j).over(w) - F.lag(v, j + 1).over(w)).otherwise(0.0)
            for j in range(1, max_lags + 1)
        }
        return {"_dy": v - F.lag(v).over(w), "_x0": F.lag(v).over(w), **diff}

    rows = step_window(df, keys, t, build, before=max_lags + 1)
    xs = [f"_x{j}" for j in range(max_lags + 1)]
    table = moments(rows, xs, "_dy", [*keys, "_most"])
    schema = _schema(df, keys, "n long, lags int, adf double, p_value double, stationary int")

    def choose(batches):
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                best = None
                for lags in range(row.most + 1):
                    if row.n <= lags + 3:
                        break
                    coef, se, sse, _ = sub_fit(row, max_lags + 1, lags + 1, 0)
                    aic = row.n * math.log(max(sse, 1e-300) / row.n) + 2 * (lags + 2)
                    if best is None or aic < best[0] - 1e-12:
                        best = (aic, lags, float(coef[1] / se[1]) if se[1] > 0 else float("nan"))
                if best:
                    tau = best[2]
                    out.append([*[getattr(row, c) for c in keys], int(row.n), best[1], tau, adf_p_value(tau), int(tau < ADF_CRITICAL["5%"])])
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return table.withColumnRenamed("_most", "most").mapInPandas(choose, schema)


def lag_products(d: DataFrame, keys, t: str, column: str, lags: int) -> DataFrame:
    """(keys, _n, _g): sums of the products of a column with itself 0 to ``lags`` steps earlier, as an array."""
    rows = lagged(d, keys, t, column, range(1, lags + 1), "_l")
    c = F.col(column)
    sums = [F.sum(c * c), *[F.coalesce(F.sum(c * F.col(f"_l{j}")), F.lit(0.0)) for j in range(1, lags + 1)]]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.array(*sums).alias("_g"))


def kpss_auto(df: DataFrame, keys, t: str, value: str) -> DataFrame:
    """(keys, n, lags, kpss, p_value, stationary): the test with lags chosen from the data (Hobijn, Franses and Ooms).

    The p-value is interpolated between the published points and stays within 0.01 and 0.10. A series without
    spread has no statistic.
    """
    d = centred(df, keys, value)
    sizes = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    first = F.floor(F.pow("_n", F.lit(2 / 9))).cast("int")
    most = sizes.agg(F.max(first)).first()[0] or 0
    g = lag_products(d, keys, t, "_d", most)
    n = F.col("_n").cast("double")
    near = F.slice("_g", 2, first)
    zero = F.lit(0.0)
    s0 = F.col("_g")[0] / n + F.aggregate(near, zero, lambda a, x: a + x) * 2 / n
    s1 = F.aggregate(F.transform(near, lambda x, i: x * (i + 1)), zero, lambda a, x: a + x) * 2 / n
    width = F.lit(1.1447) * F.pow(F.pow(F.try_divide(s1, s0), F.lit(2.0)), F.lit(1 / 3)) * F.pow(n, F.lit(1 / 3))
    lags = F.least(F.floor(F.coalesce(width, zero)), F.col("_n") - 1).cast("int")
    chosen = pin_small(g.select(*keys, lags.alias("lags")))
    top = chosen.agg(F.max("lags")).first()[0] or 0
    table = null_safe_join(lag_products(d, keys, t, "_d", top), chosen, keys)
    weigh = F.transform(F.slice("_g", 2, F.col("lags")), lambda x, i: x * 2 * (1 - (i + 1) / (F.col("lags") + 1)))
    longrun = (F.col("_g")[0] + F.aggregate(weigh, zero, lambda a, x: a + x)) / n
    partial = block_scan(d, keys, t, "_d", "_sum", "sum").groupBy(*keys).agg(F.sum(F.col("_sum") * F.col("_sum")).alias("_eta"))
    stat = F.when(F.col("_g")[0] > 0, F.try_divide(F.col("_eta") / (n * n), longrun))
    out = null_safe_join(table, partial, keys).select(*keys, F.col("_n").alias("n"), "lags", stat.alias("kpss"))
    points = [(c, float(level.rstrip("%")) / 100) for level, c in KPSS_CRITICAL.items()]
    p = F.when(F.col("kpss") >= points[-1][0], points[-1][1])
    for (c0, p0), (c1, p1) in zip(points, points[1:]):
        p = p.when((F.col("kpss") >= c0) & (F.col("kpss") < c1), p0 + (F.col("kpss") - c0) * ((p1 - p0) / (c1 - c0)))
    p = p.when(F.col("kpss") < points[0][0], points[0][1])
    return out.select("*", p.alias("p_value"), (F.col("kpss") < KPSS_CRITICAL["5%"]).cast("int").alias("stationary"))


def kpss_test(df: DataFrame, keys, t: str, value: str, lags: int) -> DataFrame:
    """(keys, n, kpss, stationary): partial sums over the Bartlett long-run variance, constant case."""
    d = centred(df, keys, value)
    d = lagged(d, keys, t, "_d", range(1, lags + 1), "_l")
    d = block_scan(d, keys, t, "_d", "_sum", "sum")
    sums = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_sum") * F.col("_sum")).alias("_eta"),
        F.sum(F.col("_d") * F.col("_d")).alias("_g0"),
        *[F.coalesce(F.sum(F.col("_d") * F.col(f"_l{j}")), F.lit(0.0)).alias(f"_g{j}") for j in range(1, lags + 1)],
    )
    n = F.col("n").cast("double")
    longrun = F.col("_g0")
    for j in range(1, lags + 1):
        longrun = longrun + F.lit(2 * (1 - j / (lags + 1))) * F.col(f"_g{j}")
    stat = F.try_divide(F.col("_eta") / (n * n), longrun / n)
    return sums.select(
        *keys, "n", stat.alias("kpss"), (stat < KPSS_CRITICAL["5%"]).cast("int").alias("stationary")
    )


def stationarity_report(df: DataFrame, keys, t: str, value: str, lags: int, width: int) -> DataFrame:
    """Both tests, the spread of the rolling mean and deviation, and one verdict per series."""
    a = adf_test(df, keys, t, value, lags).select(*keys, "adf", F.col("stationary").alias("adf_stationary"))
    k = kpss_test(df, keys, t, value, lags).select(*keys, "kpss", F.col("stationary").alias("kpss_stationary"))
    r = (
        rolling_mean_std(df, keys, t, value, width)
        .groupBy(*keys)
        .agg(F.stddev_samp("rolling_mean").alias("mean_spread"), F.stddev_samp("rolling_std").alias("std_spread"))
    )
    both = null_safe_join(null_safe_join(a, k, keys), r, keys)
    verdict = (
        F.when((F.col("adf_stationary") == 1) & (F.col("kpss_stationary") == 1), "stationary")
        .when((F.col("adf_stationary") == 0) & (F.col("kpss_stationary") == 0), "not stationary")
        .otherwise("undecided")
    )
    return both.withColumn("verdict", verdict)


def welch_psd(df: DataFrame, keys, t: str, value: str, nperseg: int, window: str = "hann") -> DataFrame:
    """(keys, bin, frequency, power): averaged periodogram, unit sampling rate.

    Segments overlap by half and lose their mean; a series shorter than ``nperseg``
    is one segment. A row joins the segments it belongs to (two at most), a segment
    is one array of ``nperseg`` values, and batches of segments go through one FFT.
    """
    span = df.groupBy(*keys).agg(F.min(t).alias("_lo"), F.count(F.lit(1)).alias("_n"))
    size = F.least(F.col("_n"), F.lit(nperseg)).cast("long")
    step = F.col("_size") - F.floor(F.col("_size") / 2)
    rows = attach(df, span, keys).withColumn("_size", size).withColumn("_step", step)
    at = F.col(t) - F.col("_lo")
    last = F.floor((F.col("_n") - F.col("_size")) / F.col("_step"))
    first = F.greatest(F.lit(0), F.ceil((at - F.col("_size") + 1) / F.col("_step")))
    upto = F.least(last, F.floor(at / F.col("_step")))
    segs = (
        rows.withColumn("_first", first.cast("long"))
        .withColumn("_upto", upto.cast("long"))
        .filter(F.col("_first") <= F.col("_upto"))
        .withColumn("_seg", F.explode(F.sequence("_first", "_upto")))
        .groupBy(*keys, "_seg", "_size")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(t).alias("t"), F.col(value).cast("double").alias("v")))).alias("_s"))
        .select(*keys, F.transform("_s", lambda s: s["v"]).alias("_x"))
    )
    taper = {"hann": (0.5, 0.5), "hamming": (0.54, 0.46)}[window]

    @F.pandas_udf("array<double>")
    def periodogram(xs: pd.Series) -> pd.Series:
        out = np.empty(len(xs), object)
        sizes = xs.map(len).to_numpy()
        for n in np.unique(sizes):  # segments of one length go through one transform
            at = np.flatnonzero(sizes == n)
            x = np.stack(xs.iloc[at].to_list())
            w = taper[0] - taper[1] * np.cos(2 * np.pi * np.arange(n) / n)
            p = np.abs(np.fft.rfft((x - x.mean(axis=1, keepdims=True)) * w, axis=1)) ** 2 / np.sum(w * w)
            p[:, 1 : (n + 1) // 2] *= 2
            for i, row in zip(at, p):
                out[i] = row
        return pd.Series(out, index=xs.index, dtype=object)

    spectra = segs.select(*keys, F.size("_x").alias("_m"), periodogram("_x").alias("_p"))
    return (
        spectra.select(*keys, "_m", F.posexplode("_p").alias("bin", "_v"))
        .groupBy(*keys, "bin", "_m")
        .agg(F.avg("_v").alias("power"))
        .select(*keys, "bin", (F.col("bin") / F.col("_m")).alias("frequency"), "power")
    )


# -- decomposition ---------------------------------------------------------


def trend_season(df: DataFrame, keys, t: str, value: str, period: int):
    """Line per series (keys, slope, intercept, first, last) and seasonal index (keys, pos, season)."""
    lines = pin_small(
        df.groupBy(*keys).agg(
            F.regr_slope(value, t).alias("slope"),
            F.regr_intercept(value, t).alias("intercept"),
            F.max(t).alias("_last"),
        )
    )
    rest = attach(df, lines, keys).withColumn(
        "_rest", F.col(value) - (F.col("intercept") + F.col("slope") * F.col(t))
    )
    season = rest.groupBy(*keys, (F.col(t) % period).alias("pos")).agg(F.avg("_rest").alias("season"))
    return lines, season


def decompose_additive(df: DataFrame, keys, t: str, value: str, period: int) -> DataFrame:
    """Rows with trend, season and fitted value: a straight line plus mean detrended value per position."""
    lines, season = trend_season(df, keys, t, value, period)
    return (
        attach(attach(df, lines.drop("_last"), keys).withColumn("pos", F.col(t) % period), season, [*keys, "pos"])
        .withColumn("trend", F.col("intercept") + F.col("slope") * F.col(t))
        .withColumn("fitted", F.col("trend") + F.col("season"))
        .drop("pos", "slope", "intercept")
    )


def decompose_moving_average(df: DataFrame, keys, t: str, value: str, period: int) -> DataFrame:
    """Centred moving-average trend, seasonal means that add up to zero, remainder."""
    half = period // 2

    def build(w):
        if period % 2:
            wide = w.rowsBetween(-half, half)
            full = F.count(value).over(wide) == period
            mean = F.avg(value).over(wide)
        else:
            left, right = w.rowsBetween(-half, half - 1), w.rowsBetween(1 - half, half)
            full = F.count(value).over(w.rowsBetween(-half, half)) == period + 1
            mean = (F.avg(value).over(left) + F.avg(value).over(right)) / 2
        return {"trend": F.when(full, mean)}

    rows = step_window(df, keys, t, build, before=half, after=half).withColumn("pos", F.col(t) % period)
    raw = rows.groupBy(*keys, "pos").agg(F.avg(F.col(value) - F.col("trend")).alias("_raw"))
    centre = raw.groupBy(*keys).agg(F.avg("_raw").alias("_centre"))
    season = null_safe_join(raw, centre, keys).select(*keys, "pos", (F.col("_raw") - F.col("_centre")).alias("season"))
    return (
        attach(rows, season, [*keys, "pos"], "left")
        .withColumn("remainder", F.col(value) - F.col("trend") - F.col("season"))
        .drop("pos")
    )


# -- forecasts -------------------------------------------------------------


def forecast_trend_seasonal(df: DataFrame, keys, t: str, value: str, period: int, h: int) -> DataFrame:
    """(keys, t, forecast) for the h steps after the end."""
    lines, season = trend_season(df, keys, t, value, period)
    future = lines.withColumn(t, F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + h)))
    return null_safe_join(future.withColumn("pos", F.col(t) % period), season, [*keys, "pos"], "left").select(
        *keys,
        t,
        (F.col("intercept") + F.col("slope") * F.col(t) + F.coalesce("season", F.lit(0.0))).alias("forecast"),
    )


def forecast_drift(df: DataFrame, keys, t: str, value: str, h: int) -> DataFrame:
    """Random walk with drift: last value plus the mean difference per step ahead."""
    ends = df.groupBy(*keys).agg(
        F.max(t).alias("_last"),
        F.max_by(value, t).alias("_v1"),
        F.min_by(value, t).alias("_v0"),
        F.count(F.lit(1)).alias("_n"),
    )
    drift = F.coalesce(F.try_divide(F.col("_v1") - F.col("_v0"), F.col("_n") - 1), F.lit(0.0))
    return ends.withColumn(t, F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + h))).select(
        *keys, t, (F.col("_v1") + drift * (F.col(t) - F.col("_last"))).alias("forecast")
    )


def tail_steps(df: DataFrame, keys, t: str, columns: Sequence[str], n: int) -> DataFrame:
    """(keys, last, tail): the last n steps of each series as one sorted array."""
    ends = df.groupBy(*keys).agg(F.max(t).alias("last"))
    recent = attach(df, ends, keys).filter(F.col(t) > F.col("last") - n)
    return recent.groupBy(*keys, "last").agg(
        F.array_sort(F.collect_list(F.struct(t, *columns))).alias("tail")
    )


def forecast_ar(df: DataFrame, keys, t: str, value: str, p: int, h: int) -> DataFrame:
    """(keys, t, forecast): AR(p) with constant by least squares, iterated h steps."""
    rows = lagged(df, keys, t, value, range(1, p + 1), "_l")
    fits = fit_groups(rows, [f"_l{j}" for j in range(1, p + 1)], value, keys)
    start = null_safe_join(tail_steps(df, keys, t, [value], p), fits, keys)
    schema = _schema(df, keys, f"{t} long, forecast double")

    def roll(batches):
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                hist = [x[value] for x in row.tail]
                for j in range(1, h + 1):
                    nxt = row.coef[0] + sum(row.coef[i] * hist[-i] for i in range(1, p + 1))
                    hist.append(nxt)
                    out.append([*[getattr(row, c) for c in keys], int(row.last) + j, float(nxt)])
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return start.mapInPandas(roll, schema)


def difference(df: DataFrame, keys, t: str, value: str, d: int, season: int = 0, out: str = "_z") -> DataFrame:
    """Seasonal difference (if any), then d first differences; leading steps dropped."""
    rows = df.withColumn(out, F.col(value).cast("double"))
    if season:
        rows = lag_diff(rows, keys, t, out, "_tmp", season).drop(out).withColumnRenamed("_tmp", out).dropna(subset=[out])
    for _ in range(d):
        rows = lag_diff(rows, keys, t, out, "_tmp").drop(out).withColumnRenamed("_tmp", out).dropna(subset=[out])
    return rows


def long_ar_residuals(rows: DataFrame, keys, t: str, z: str, order: int, out: str = "_e") -> DataFrame:
    """First stage: residuals of a long autoregression fitted per series."""
    names = [f"_a{j}" for j in range(1, order + 1)]
    lags = lagged(rows, keys, t, z, range(1, order + 1), "_a").dropna(subset=names)
    fits = fit_groups(lags, names, z, keys).select(*keys, F.col("coef").alias("_c"))
    fitted = F.col("_c")[0]
    for i, nme in enumerate(names, 1):
        fitted = fitted + F.col("_c")[i] * F.col(nme)
    return attach(lags, fits, keys).withColumn(out, F.col(z) - fitted).drop("_c", *names)


def arma_rows(df: DataFrame, keys, t: str, value: str, d: int, plags: Sequence[int], qlags: Sequence[int], season: int, order: int):
    """Differenced rows with their lagged values and, from a long autoregression, lagged residuals."""
    staged = difference(df, keys, t, value, d, season)
    if qlags:
        staged = long_ar_residuals(staged, keys, t, "_z", order)
    xs = []
    if plags:
        staged = lagged(staged, keys, t, "_z", plags, "_p")
        xs += [f"_p{j}" for j in plags]
    if qlags:
        staged = lagged(staged, keys, t, "_e", qlags, "_q")
        xs += [f"_q{j}" for j in qlags]
    return staged, xs


def sub_fit(row, pmax: int, p: int, q: int):
    """Fit ARMA(p, q) from the moments of the largest order."""
    width = len(row.mx)
    full = np.zeros((width, width))
    full[np.triu_indices(width)] = row.sxx
    full = full + np.triu(full, 1).T
    pick = [*range(p), *range(pmax, pmax + q)]
    sub = full[np.ix_(pick, pick)]
    mx, sxy = np.asarray(row.mx)[pick], np.asarray(row.sxy)[pick]
    return solve_row(row.n, mx, row.my, sub[np.triu_indices(len(pick))], sxy, row.syy)


def arima_order_search(
    df: DataFrame, keys, t: str, value: str, ps: Sequence[int], ds: Sequence[int], qs: Sequence[int], order: int = 6
) -> DataFrame:
    """(keys, p, d, q, aic, best): two-stage least squares for every order.

    For each d a long autoregression gives residuals, and one moment aggregate per
    series with all lags of values and residuals serves every (p, q).
    """
    schema = _schema(df, keys, "p int, d int, q int, aic double")
    pmax, qmax = max(ps), max(qs)
    tables = []
    for d in ds:
        rows, xs = arma_rows(df, keys, t, value, d, range(1, pmax + 1), range(1, qmax + 1), 0, order)

        def score(batches, d=d):
            for b in batches:
                out = []
                for row in b.itertuples(index=False):
                    head = [getattr(row, c) for c in keys]
                    for p in ps:
                        for q in qs:
                            if row.n <= p + q + 2:
                                continue
                            _, _, sse, _ = sub_fit(row, pmax, p, q)
                            aic = row.n * math.log(max(sse, 1e-300) / row.n) + 2 * (p + q + 1)
                            out.append([*head, p, d, q, aic])
                yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

        tables.append(moments(rows, xs, "_z", keys).mapInPandas(score, schema))
    scores = tables[0]
    for x in tables[1:]:
        scores = scores.unionByName(x)
    w = Window.partitionBy(*keys).orderBy("aic", "p", "d", "q")  # one row per order
    return scores.withColumn("best", (F.row_number().over(w) == 1).cast("int"))


def forecast_sarima(
    df: DataFrame,
    keys,
    t: str,
    value: str,
    order: tuple[int, int, int],
    season: int,
    h: int,
    long_order: int = 6,
    seasonal: tuple[int, int, int] = (0, 1, 0),
) -> DataFrame:
    """(keys, t, forecast, low, high): ARMA on the (seasonally) differenced series, undone step by step.

    ``order`` is (p, d, q); ``seasonal`` (P, D, Q) adds values and residuals at multiples of
    ``season`` as terms of their own and takes D seasonal differences (0 or 1). Python
    receives the moments and the last few steps of each series.
    """
    p, d, q = order
    sp, sd, sq = seasonal if season else (0, 0, 0)
    plags = sorted({*range(1, p + 1), *(season * j for j in range(1, sp + 1))})
    qlags = sorted({*range(1, q + 1), *(season * j for j in range(1, sq + 1))})
    rows, xs = arma_rows(df, keys, t, value, d, plags, qlags, season if sd else 0, long_order)
    if not xs:
        raise ValueError("no autoregressive or moving-average term")
    fits = fit_groups(rows, xs, "_z", keys)
    # Lag polynomial of the differencing: (1 - B^season) (1 - B)^d.
    poly = np.array([1.0])
    if season and sd:
        poly = np.convolve(poly, np.r_[1.0, np.zeros(season - 1), -1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    start = null_safe_join(tail_steps(df, keys, t, [value], max([1, *plags]) + len(poly)), fits, keys)
    if qlags:
        last_e = tail_steps(rows, keys, t, ["_e"], max(qlags)).select(*keys, F.col("tail").alias("etail"))
        start = null_safe_join(start, last_e, keys)
    schema = _schema(df, keys, f"{t} long, forecast double, low double, high double")

    def roll(batches):
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                y = [float(x[value]) for x in row.tail]
                k = len(poly) - 1
                z = [float(poly @ np.array(y[i - k : i + 1][::-1])) for i in range(k, len(y))]
                e = [float(x["_e"]) for x in row.etail] if qlags else []
                phi = dict(zip(plags, row.coef[1 : 1 + len(plags)]))
                theta = dict(zip(qlags, row.coef[1 + len(plags) :]))
                sigma = math.sqrt(max(row.sse, 0) / max(row.n - len(xs) - 1, 1))
                # psi weights of the undifferenced process
                own = np.zeros(max([0, *plags]) + 1)
                own[0] = 1.0
                for lag, v in phi.items():
                    own[lag] = -v
                ar = np.convolve(own, poly)
                psi = [1.0]
                for j in range(1, h):
                    psi.append(theta.get(j, 0.0) - sum(ar[i] * psi[j - i] for i in range(1, min(j, len(ar) - 1) + 1)))
                for j in range(1, h + 1):
                    nz = row.coef[0] + sum(v * z[-lag] for lag, v in phi.items()) + sum(v * e[-lag] for lag, v in theta.items())
                    ny = nz - sum(poly[i] * y[-i] for i in range(1, len(poly)))
                    z.append(nz)
                    e.append(0.0)
                    y.append(ny)
                    half = 1.96 * sigma * math.sqrt(sum(v * v for v in psi[:j]))
                    out.append([*[getattr(row, c) for c in keys], int(row.last) + j, ny, ny - half, ny + half])
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return start.mapInPandas(roll, schema)


def forecast_fourier(df: DataFrame, keys, t: str, value: str, period: float, k: int, h: int) -> DataFrame:
    """(keys, t, forecast): line plus k seasonal waves by least squares, per series."""
    ends = df.groupBy(*keys).agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    terms = ["_rel", *[f"{f}_{j}" for j in range(1, k + 1) for f in ("sin", "cos")]]
    rows = fourier_terms(attach(df, ends, keys), t, period, k).withColumn("_rel", F.col(t) - F.col("_lo"))
    fits = fit_groups(rows, terms, value, keys).select(*keys, "coef")
    future = ends.withColumn(t, F.explode(F.sequence(F.col("_hi") + 1, F.col("_hi") + h)))
    wide = fourier_terms(future, t, period, k).withColumn("_rel", F.col(t) - F.col("_lo"))
    wide = null_safe_join(wide, fits, keys)
    out: Column = F.col("coef")[0]
    for i, name in enumerate(terms, 1):
        out = out + F.col("coef")[i] * F.col(name)
    return wide.select(*keys, t, out.alias("forecast"))


def rolling_origin_backtest(df: DataFrame, keys, t: str, value: str, p: int, origins: int) -> DataFrame:
    """(keys, t, actual, forecast): AR(p) refitted on all steps before t, for the last ``origins`` steps.

    Steps before the first origin are one segment, each later step its own; raw
    moment sums per segment are added up over the segments, so no step is read
    once per origin.
    """
    d = centred(df, keys, value)
    means = df.groupBy(*keys).agg(F.avg(value).alias("_mu"), F.max(t).alias("_last"))
    rows = lagged(d, keys, t, "_d", range(1, p + 1), "_l")
    rows = attach(rows, means, keys)
    xs = [f"_l{j}" for j in range(1, p + 1)]
    rows = rows.dropna(subset=xs).withColumn(
        "_seg", F.greatest(F.lit(0), F.col(t) - (F.col("_last") - origins)).cast("int")
    )
    prods = {"s_n": F.count(F.lit(1)).cast("double"), "s_y": F.sum("_d"), "s_yy": F.sum(F.col("_d") * F.col("_d"))}
    for i, a in enumerate(xs):
        prods[f"s_x{i}"] = F.sum(a)
        prods[f"s_xy{i}"] = F.sum(F.col(a) * F.col("_d"))
        for j in range(i, p):
            prods[f"s_xx{i}_{j}"] = F.sum(F.col(a) * F.col(xs[j]))
    point = F.max_by(F.struct(F.col(t).alias("t"), F.col(value).alias("v"), F.array(*xs).alias("x"), "_mu"), t)
    segs = rows.groupBy(*keys, "_seg").agg(*[c.alias(n) for n, c in prods.items()], point.alias("pt"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    run = segs.select(*keys, "_seg", "pt", *[F.sum(n).over(before).alias(n) for n in prods]).filter("_seg > 0")
    schema = _schema(df, keys, f"{t} long, actual double, forecast double")

    def predict(batches):
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                n = r["s_n"]
                if not n or n <= p + 1:
                    continue
                m = np.array([r[f"s_x{i}"] for i in range(p)]) / n
                my = r["s_y"] / n
                s = np.zeros((p, p))
                for i in range(p):
                    for j in range(i, p):
                        s[i, j] = s[j, i] = r[f"s_xx{i}_{j}"] / n - m[i] * m[j]
                sxy = np.array([r[f"s_xy{i}"] for i in range(p)]) / n - m * my
                coef, *_ = solve_row(n, m, my, s[np.triu_indices(p)], sxy, r["s_yy"] / n - my * my)
                pt = r["pt"]
                f = coef[0] + coef[1:] @ np.array(pt["x"]) + pt["_mu"]
                out.append([*[r[c] for c in keys], pt["t"], pt["v"], float(f)])
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return run.mapInPandas(predict, schema)


def compare_forecasts(df: DataFrame, model: str, actual: str, predicted: str) -> DataFrame:
    """(model, n, mae, rmse, r2, mape, winner): one aggregate per model, winner by MAPE."""
    m = regression_metrics(df, actual, predicted, keys=[model]).select(model, "n", "mae", "rmse", "r2")
    table = m.join(mape(df, actual, predicted, keys=[model]).select(model, "mape"), model)
    w = Window.orderBy("mape", model)  # one row per model
    return table.withColumn("winner", (F.row_number().over(w) == 1).cast("int"))
