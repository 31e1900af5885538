"""Seasonal ARMA by exact Gaussian likelihood, with regressors, for series of any length.

The polynomials multiply: (1 - phi B)(1 - Phi B^s) z = (1 + theta B)(1 + Theta B^s) e, z being the differenced
series less its regression. A Kalman filter in innovations form takes the series and the regressors
through the same gains, so regression coefficients and variance drop out in closed form and the
search is over bounded partial autocorrelations only. Many candidates run in one pass as arrays.

A series of up to ``BLOCK`` steps is fitted whole in a task. Longer ones are cut into blocks: the first has the filter's
exact start, the others begin ``WARM`` steps early from nothing. Each round every block evaluates the
candidates of its series and the moments are added up; the search of all series goes on from
there. No partial autocorrelation exceeds ``EDGE``, so what a start can weigh after the warm-up is
below ``EDGE ** (WARM / season)`` of itself.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordering import dense_index
from tablewright.operators.skew import attach
from tablewright.session import pin, pin_small

BLOCK, WARM = 100_000, 30_000  # steps
EDGE = 0.985
ROUNDS = 80
STEPS = (4.0, 2.0, 1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001)
STENCIL = 1e-4


# -- the model ----------------------------------------------------------------


def coefficients(x: np.ndarray) -> np.ndarray:
    """Autoregressive coefficients of a stationary process from free numbers, by partial autocorrelations."""
    out = np.zeros(0)
    for r in EDGE * np.tanh(x):
        out = np.r_[out - r * out[::-1], r]
    return out


def lag_polynomial(own: np.ndarray, seasonal: np.ndarray, season: int) -> np.ndarray:
    """Product of 1 + own B + ... and 1 + seasonal B^s + ..., without the leading 1."""
    wide = np.zeros(len(seasonal) * season + 1)
    wide[0] = 1.0
    if len(seasonal):
        wide[season::season] = seasonal
    return np.convolve(np.r_[1.0, own], wide)[1:]


def split(x: np.ndarray, order: Sequence[int]) -> list[np.ndarray]:
    """phi, theta, Phi, Theta of the free numbers; ``order`` is (p, q, P, Q)."""
    parts = np.split(x, np.cumsum(order)[:-1])
    return [coefficients(v) if i % 2 == 0 else -coefficients(v) for i, v in enumerate(parts)]


def polynomials(x: np.ndarray, order: Sequence[int], season: int) -> tuple[np.ndarray, np.ndarray]:
    """Full autoregressive (z = ar z + ...) and moving-average coefficients."""
    phi, theta, sphi, stheta = split(x, order)
    return -lag_polynomial(-phi, -sphi, season), lag_polynomial(theta, stheta, season)


def start_covariance(trans: np.ndarray, load: np.ndarray) -> np.ndarray:
    """P = T P T' + R R', by doubling."""
    p, a = load[:, :, None] * load[:, None, :], trans.copy()
    for _ in range(60):
        more = a @ p @ a.transpose(0, 2, 1)
        p = p + more
        if np.abs(more).max() <= 1e-15 * np.abs(p).max():
            break
        a = a @ a
    return p


def moments(data: np.ndarray, points: np.ndarray, order: Sequence[int], season: int, warm: int | None = None) -> np.ndarray:
    """For each point: n, the sum of log F, and the scaled innovations' products of all columns.

    ``data``: (steps, columns). ``warm``: None begins with the exact covariance; a number of steps begins from
    nothing with the filter's final gain and counts what follows them.
    """
    n, width = data.shape
    polys = [polynomials(x, order, season) for x in points]
    r = max(len(polys[0][0]), len(polys[0][1]) + 1, 1)
    c = len(points)
    ar, load = np.zeros((c, r)), np.zeros((c, r))
    load[:, 0] = 1.0
    for i, (a, m) in enumerate(polys):
        ar[i, : len(a)] = a
        load[i, 1 : 1 + len(m)] = m
    state, total, logs = np.zeros((c, r, width)), np.zeros((c, width, width)), np.zeros(c)
    steady = warm is not None
    if not steady:
        trans = np.zeros((c, r, r))
        trans[:, :, 0] = ar
        trans[:, np.arange(r - 1), np.arange(1, r)] = 1.0
        noise = load[:, :, None] * load[:, None, :]
        cov = start_covariance(trans, load)
    gain, scale = load, np.ones(c)
    for t in range(n):
        v = data[t] - state[:, 0]
        if not steady:
            scale = cov[:, 0, 0]
            gain = cov[:, :, 0] / scale[:, None]
        if warm is None or t >= warm:
            total += (v / scale[:, None])[:, :, None] * v[:, None, :]
            logs += np.log(scale)
        seen = state + gain[:, :, None] * v[:, None, :]
        state = ar[:, :, None] * seen[:, :1]
        state[:, :-1] += seen[:, 1:]
        if not steady:
            cov = trans @ (cov - gain[:, :, None] * cov[:, None, :, 0]) @ trans.transpose(0, 2, 1) + noise
            if np.abs(cov[:, :, 0] - load).max() < 1e-13:
                steady, gain, scale = True, load, np.ones(c)
    counted = n if warm is None else n - warm
    return np.concatenate([np.full((c, 1), float(counted)), logs[:, None], total.reshape(c, -1)], axis=1)


def profile(m: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Negative log likelihood, regression coefficients and variance from a point's moments."""
    n, logs = m[0], m[1]
    s = m[2:].reshape(int(math.isqrt(len(m) - 2)), -1)
    beta = np.linalg.lstsq(s[1:, 1:], s[1:, 0], rcond=1e-12)[0] if len(s) > 1 else np.zeros(0)
    var = max((s[0, 0] - s[0, 1:] @ beta) / n, 1e-300)
    return 0.5 * (n * (math.log(2 * math.pi * var) + 1) + logs), beta, var


# -- the search: a quasi-Newton method that asks for points and is told their moments --


def begin(k: int) -> dict:
    return {"x": [0.0] * k, "phase": "start", "f": math.inf, "g": [], "h": [], "round": 0}


def ask(s: dict) -> np.ndarray:
    x = np.array(s["x"], float)
    k = len(x)
    if s["phase"] == "start":
        return np.concatenate([np.zeros((1, k)), *(v * np.eye(k) for v in (-0.7, 0.7))]) if k else np.zeros((1, 0))
    if s["phase"] == "slope":
        return np.concatenate([x[None], x + STENCIL * np.eye(k), x - STENCIL * np.eye(k)])
    return x + np.outer(STEPS, s["d"])


def tell(s: dict, table: np.ndarray) -> dict:
    """The next state of the search; phase "done" ends it, with the moments of its point in ``m``."""
    points, values = ask(s), np.array([profile(m)[0] for m in table])
    k = points.shape[1]
    best = int(np.argmin(values))
    s = dict(s, round=s["round"] + 1)
    if s["phase"] == "start":
        s |= {"x": points[best].tolist(), "f": float(values[best]), "m": table[best].tolist(), "phase": "slope" if k else "done"}
    elif s["phase"] == "slope":
        g = (values[1 : 1 + k] - values[1 + k :]) / (2 * STENCIL)
        h = np.array(s["h"]).reshape(k, k) if s["h"] else np.eye(k) / max(1.0, float(np.abs(g).max()))
        if s["g"] and s["h"]:
            dx, dg = np.array(s["x"]) - np.array(s["x0"]), g - np.array(s["g"])
            if dx @ dg > 1e-12:
                a = np.eye(k) - np.outer(dx, dg) / (dx @ dg)
                h = a @ h @ a.T + np.outer(dx, dx) / (dx @ dg)
        s |= {"g": g.tolist(), "h": h.ravel().tolist(), "d": (-h @ g).clip(-2, 2).tolist(), "phase": "line", "m": table[0].tolist(), "f": float(values[0])}
        if np.abs(g).max() < 1e-5:
            s["phase"] = "done"
    else:
        gain = s["f"] - values[best]
        if gain > 1e-9 * (1 + abs(s["f"])):
            s |= {"x0": s["x"], "x": points[best].tolist(), "f": float(values[best]), "m": table[best].tolist(), "phase": "slope"}
        elif s.get("fresh"):
            s["phase"] = "done"
        else:  # once more from the plain gradient
            s |= {"h": [], "g": [], "phase": "slope", "fresh": True}
            return s
        s["fresh"] = False
    if s["round"] >= ROUNDS:
        s["phase"] = "done"
    return s


def fit_array(data: np.ndarray, order: Sequence[int], season: int) -> dict:
    """The search over one series held as an array."""
    s = begin(sum(order))
    while s["phase"] != "done":
        s = tell(s, moments(data, ask(s), order, season))
    return s


# -- tables -------------------------------------------------------------------


def differencing(d: int, sd: int, season: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^season)^D, the leading 1 first."""
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(sd):
        poly = np.convolve(poly, np.r_[1.0, np.zeros(season - 1), -1.0])
    return poly


def _differenced(raw: np.ndarray, poly: np.ndarray, constant: bool) -> np.ndarray:
    """Columns after differencing, and a column of ones behind the value."""
    k = len(poly) - 1
    out = sum(c * raw[k - i : len(raw) - i] for i, c in enumerate(poly)) if len(raw) > k else raw[:0]
    return np.concatenate([out[:, :1], np.ones((len(out), 1)), out[:, 1:]], axis=1) if constant else out


FIT = "x array<double>, n long, nll double, sigma2 double, beta array<double>"


def _row(s: dict) -> list:
    nll, beta, var = profile(np.array(s["m"]))
    return [s["x"], int(s["m"][0]), nll, var, beta.tolist()]


def _fitted_long(rows: DataFrame, cols: Sequence[str], order, season: int, poly: np.ndarray, constant: bool, block: int, warm: int) -> DataFrame:
    """Fits of series over several blocks: every round one pass over all of them."""
    k = len(poly) - 1
    own = F.floor(F.col("_i") / block)
    # A block also holds the steps that its warm-up and differences reach back to.
    last = F.floor((F.col("_i") + warm + k) / block)
    top = F.floor((F.col("_n") - 1) / block)
    blocks = pin(
        rows.select("_sid", "_i", *cols, F.explode(F.sequence(own, F.least(last, top))).alias("_block")).repartition("_sid", "_block")
    )
    search = "_sid string, state string"
    ids = rows.select("_sid").distinct()
    states = pin_small(ids.withColumn("state", F.lit(json.dumps(begin(sum(order))))))

    def measure(key, own_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        s = json.loads(asked["state"].iloc[0])
        own_rows = own_rows.sort_values("_i")
        data = _differenced(own_rows[list(cols)].to_numpy(float), poly, constant)
        first = int(own_rows["_i"].iloc[0]) + k  # step of the first difference
        before = int(key[1]) * block - first
        got = moments(data, ask(s), order, season, None if first == k and before <= 0 else max(before, 0))
        if first == k and before > 0:  # the warm-up reaches the series' start: exact, less what belongs to earlier blocks
            got = moments(data, ask(s), order, season) - moments(data[:before], ask(s), order, season)
        return pd.DataFrame({"_sid": key[0], "point": np.arange(len(got)), "m": list(got)})

    def advance(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("point")
        s = tell(json.loads(pdf["state"].iloc[0]), np.array(pdf["m"].tolist()))
        return pd.DataFrame({"_sid": [pdf["_sid"].iloc[0]], "state": [json.dumps(s)]})

    done = states.filter("false")
    while True:
        active = blocks.join(states.select("_sid"), "_sid", "left_semi")
        asked = active.select("_sid", "_block").distinct().join(states, "_sid").select(F.col("_sid").alias("_of"), F.col("_block").alias("_at"), "state")
        parts = active.groupBy("_sid", "_block").cogroup(asked.groupBy("_of", "_at")).applyInPandas(measure, "_sid string, point int, m array<double>")
        summed = parts.select("_sid", "point", F.posexplode("m").alias("at", "v")).groupBy("_sid", "point", "at").agg(F.sum("v").alias("v"))
        table = summed.groupBy("_sid", "point").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("m"))
        moved = pin(table.join(states, "_sid").groupBy("_sid").applyInPandas(advance, search))
        ended = F.col("state").contains('"phase": "done"')
        done = done.unionByName(moved.filter(ended))
        states = moved.filter(~ended)
        if states.isEmpty():
            break

    def read(batches):
        for b in batches:
            out = [[sid, *_row(json.loads(state))] for sid, state in zip(b["_sid"], b["state"])]
            yield pd.DataFrame(out, columns=["_sid", "x", "n", "nll", "sigma2", "beta"])

    return done.mapInPandas(read, f"_sid string, {FIT}")


def prepared(df: DataFrame, keys: Sequence[str], t: str, value: str, xs: Sequence[str]) -> DataFrame:
    """``_sid``, keys, ``_t``, ``_i`` (0, 1, ...), ``_n``, ``_y`` and regressors ``_x0`` ...; rows with a null among them are left out."""
    cols = ["_y", *[f"_x{j}" for j in range(len(xs))]]
    plain = df.select(*keys, F.col(t).alias("_t"), *[F.col(c).cast("double").alias(n) for c, n in zip((value, *xs), cols)])
    placed = dense_index(plain.dropna(subset=["_t", *cols]), keys, ["_t"], "_i")
    sid = F.to_json(F.struct(*keys)) if keys else F.lit("{}")
    rows = placed.withColumn("_sid", sid)
    return pin(attach(rows, rows.groupBy("_sid").agg(F.count(F.lit(1)).alias("_n")), ["_sid"]))


def fit(rows: DataFrame, k: int, order: tuple[int, int, int], seasonal: tuple[int, int, int], season: int, block: int = BLOCK, warm: int = WARM) -> DataFrame:
    """``_sid, x, n, nll, sigma2, beta`` of ``prepared`` rows with k regressors.

    beta has the constant of the differenced series first (there is none after two differences or
    more), then the regressors'. Series too short for the model give no row.
    """
    (p, d, q), (sp, sd, sq) = order, seasonal if season > 1 else (0, 0, 0)
    free, poly, constant = (p, q, sp, sq), differencing(d, sd, season), d + sd < 2
    cols = ["_y", *[f"_x{j}" for j in range(k)]]
    least = len(poly) + sum(free) + k + constant + 1

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        data = _differenced(pdf.sort_values("_i")[cols].to_numpy(float), poly, constant)
        return pd.DataFrame([[pdf["_sid"].iloc[0], *_row(fit_array(data, free, season))]], columns=["_sid", "x", "n", "nll", "sigma2", "beta"])

    enough = rows.filter(F.col("_n") > least).select("_sid", "_i", "_n", *cols)
    out = enough.filter(F.col("_n") <= block).groupBy("_sid").applyInPandas(run, f"_sid string, {FIT}")
    long = enough.filter(F.col("_n") > block)
    if long.isEmpty():
        return out
    return out.unionByName(_fitted_long(long, cols, free, season, poly, constant, block, warm))


def forecast(
    df: DataFrame, keys: Sequence[str], t: str, value: str, order: tuple[int, int, int], season: int, h: int,
    seasonal: tuple[int, int, int] = (0, 0, 0), xs: Sequence[str] = (), future: DataFrame | None = None,
    block: int = BLOCK, warm: int = WARM,
) -> DataFrame:
    """(keys, t, forecast, low, high, nll): the next h steps with 95 % intervals.

    ``order`` (p, d, q) and ``seasonal`` (P, D, Q). ``xs``: regressor columns, whose values of the steps to
    come ``future`` holds (keys, t, xs); without one of them a step has no forecast. Steps are taken in order
    of ``t``; those to come are numbered on from the last. Rows with a null are left out, null keys are a
    series, series too short for the model and tables without rows give no rows.
    """
    rows = prepared(df, keys, t, value, xs)
    fits = pin_small(fit(rows, len(xs), order, seasonal, season, block, warm))
    (p, d, q), (sp, sd, sq) = order, seasonal if season > 1 else (0, 0, 0)
    free, poly, constant = (p, q, sp, sq), differencing(d, sd, season), d + sd < 2
    cols = ["_y", *[f"_x{j}" for j in range(len(xs))]]
    back = len(poly) + warm
    tail = rows.filter(F.col("_i") >= F.col("_n") - back).join(fits, "_sid")
    ends = rows.groupBy("_sid", *keys).agg(F.max("_t").alias("_last"))
    if xs:
        ahead = future.select(F.to_json(F.struct(*keys)).alias("_sid") if keys else F.lit("{}").alias("_sid"), F.col(t).alias("_t"), *[F.col(c).cast("double").alias(n) for c, n in zip(xs, cols[1:])])
        ahead = ahead.join(ends.select("_sid", "_last"), "_sid").filter((F.col("_t") > F.col("_last")) & (F.col("_t") <= F.col("_last") + h))
        coming = ahead.groupBy("_sid").agg(F.collect_list(F.struct((F.col("_t") - F.col("_last")).cast("int").alias("j"), F.array(*cols[1:]).alias("v"))).alias("_ahead"))
        tail = tail.join(coming, "_sid", "left")
    else:
        tail = tail.withColumn("_ahead", F.lit(None).cast("array<struct<j:int,v:array<double>>>"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        one = pdf.iloc[0]
        raw = pdf[cols].to_numpy(float)
        beta = np.asarray(one["beta"], float)
        ar, ma = polynomials(np.asarray(one["x"], float), free, season)
        # The series less its regression, whose differences have the constant as mean.
        u = raw[:, 0] - raw[:, 1:] @ beta[constant:]
        z = _differenced(u[:, None], poly, False)[:, 0] - (beta[0] if constant else 0.0)
        state, step = _last_state(z, ar, ma, int(one["_i"]) == 0)
        u = list(u)
        coming = np.full((h, len(cols) - 1), 0.0 if len(cols) == 1 else np.nan)
        for item in one["_ahead"] if one["_ahead"] is not None else []:
            coming[item["j"] - 1] = item["v"]
        full = np.convolve(np.r_[1.0, -ar], poly)
        psi, out = [1.0], []
        for j in range(h):
            if j:
                psi.append((ma[j - 1] if j <= len(ma) else 0.0) - sum(full[i] * psi[j - i] for i in range(1, min(j, len(full) - 1) + 1)))
            nu = state[0] + (beta[0] if constant else 0.0) - sum(poly[i] * u[-i] for i in range(1, len(poly)))
            state = step @ state
            u.append(nu)
            mean = nu + float(coming[j] @ beta[constant:])
            half = 1.959963984540054 * math.sqrt(one["sigma2"] * sum(v * v for v in psi))
            out.append([one["_sid"], j + 1, mean, mean - half, mean + half, one["nll"]])
        return pd.DataFrame(out, columns=["_sid", "_j", "forecast", "low", "high", "nll"])

    found = tail.select("_sid", "_i", *cols, "x", "sigma2", "beta", "nll", "_ahead").groupBy("_sid").applyInPandas(
        run, "_sid string, _j int, forecast double, low double, high double, nll double"
    )
    wide = ends.join(found, "_sid").select(*keys, (F.col("_last") + F.col("_j")).cast("long").alias(t), "forecast", "low", "high", "nll")
    return wide.dropna(subset=["forecast"])


ORDER = ["p", "q", "sp", "sq"]
#: Steps from an order to its neighbours: one of p, q, P, Q; p and q together; P and Q together.
MOVES = [tuple(s * (i == j) for j in range(4)) for i in range(4) for s in (1, -1)] + [(1, 1, 0, 0), (-1, -1, 0, 0), (0, 0, 1, 1), (0, 0, -1, -1)]
STARTS = ((2, 2, 1, 1), (0, 0, 0, 0), (1, 0, 1, 0), (0, 1, 0, 1))


def _scored(rows: DataFrame, frontier: DataFrame, d: int, sd: int, season: int, block: int, warm: int) -> DataFrame:
    """``frontier`` (``_sid`` and an order) with ``n, nll, aic``; every series with every order of its own is a task."""
    poly, constant = differencing(d, sd, season), d + sd < 2
    need = F.lit(len(poly) + constant + 1) + F.col("p") + F.col("q") + F.col("sp") + F.col("sq")
    asked = attach(rows.select("_sid", "_i", "_n", "_y"), frontier, ["_sid"]).filter(F.col("_n") > need)
    kind = "_sid string, p int, q int, sp int, sq int, n long, nll double"

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        order = tuple(int(v) for v in key[1:])
        data = _differenced(pdf.sort_values("_i")[["_y"]].to_numpy(float), poly, constant)
        _, n, nll, _, _ = _row(fit_array(data, order, season))
        return pd.DataFrame([[key[0], *order, n, nll]], columns=["_sid", *ORDER, "n", "nll"])

    found = asked.filter(F.col("_n") <= block).groupBy("_sid", *ORDER).applyInPandas(run, kind)
    long = rows.filter(F.col("_n") > block)
    if not long.isEmpty():
        # The orders are those of the lattice, so their number does not depend on the data.
        for r in frontier.select(*ORDER).distinct().collect():
            ids = frontier.filter(" AND ".join(f"{c} = {r[c]}" for c in ORDER)).select("_sid")
            fits = _fitted_long(long.join(ids, "_sid", "left_semi"), ["_y"], tuple(r), season, poly, constant, block, warm)
            found = found.unionByName(fits.select("_sid", *[F.lit(r[c]).alias(c) for c in ORDER], "n", "nll"))
    free = F.col("p") + F.col("q") + F.col("sp") + F.col("sq") + int(constant) + 1
    return found.withColumn("aic", 2 * F.col("nll") + 2 * free)


def order_search(
    df: DataFrame, keys: Sequence[str], t: str, value: str, season: int, d: int = 0, sd: int = 0,
    most: tuple[int, int, int, int] = (3, 3, 1, 1), block: int = BLOCK, warm: int = WARM,
) -> DataFrame:
    """(keys, p, d, q, sp, sd, sq, n, nll, aic, best): every order tried for each series, the best marked 1.

    ``most``: the greatest p, q, P, Q. Each series begins with a few orders; each round those next to its best
    one that were not tried yet are fitted, all series together, until a series' best stays. Of equal AIC
    the lesser order counts. Series too short for any order give no row.
    """
    rows = prepared(df, keys, t, value, [])
    names = pin_small(rows.select("_sid", *keys).distinct())
    top = most if season > 1 else (*most[:2], 0, 0)
    starts = sorted({tuple(min(a, b) for a, b in zip(s, top)) for s in STARTS})
    frontier = names.select("_sid", F.inline(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(ORDER, s)]) for s in starts])))
    tried = None
    while True:
        new = pin_small(_scored(rows, pin_small(frontier), d, sd, season, block, warm))
        before, tried = tried, new if tried is None else pin_small(tried.unionByName(new))
        least = F.min(F.struct("aic", *ORDER)).alias("b")
        best = tried.groupBy("_sid").agg(least).select("_sid", "b.*")
        if before is not None:  # a series whose best stays has ended
            old = before.groupBy("_sid").agg(least).select("_sid", F.col("b.aic").alias("old"))
            best = best.join(old, "_sid", "left").filter("old IS NULL OR aic < old").drop("old")
        moves = F.array(*[F.struct(*[(F.col(c) + m).alias(c) for c, m in zip(ORDER, move)]) for move in MOVES])
        near = best.select("_sid", F.inline(moves))
        for c, v in zip(ORDER, top):
            near = near.filter(F.col(c).between(0, v))
        frontier = pin_small(near.join(tried.select("_sid", *ORDER), ["_sid", *ORDER], "left_anti"))
        if frontier.isEmpty():
            break
    place = F.row_number().over(Window.partitionBy("_sid").orderBy("aic", *ORDER))  # one row an order of the lattice
    found = tried.withColumn("best", (place == 1).cast("int")).join(names, "_sid")
    return found.select(*keys, "p", F.lit(d).alias("d"), "q", "sp", F.lit(sd).alias("sd"), "sq", "n", "nll", "aic", "best")


def forecast_best(df: DataFrame, keys: Sequence[str], t: str, value: str, orders: DataFrame, season: int, h: int) -> DataFrame:
    """(keys, p, q, sp, sq, t, forecast, low, high, nll): each series by the order that ``order_search`` marked best."""
    best = pin_small(orders.filter("best = 1").select(*keys, "p", "d", "q", "sp", "sd", "sq"))
    out = None
    for r in best.select("p", "d", "q", "sp", "sd", "sq").distinct().orderBy("p", "q", "sp", "sq").collect():
        own = best.filter(" AND ".join(f"{c} = {r[c]}" for c in r.asDict())).select(*keys, F.lit(True).alias("_own"))
        part = attach(df, own, keys).drop("_own")
        found = forecast(part, keys, t, value, (r.p, r.d, r.q), season, h, seasonal=(r.sp, r.sd, r.sq))
        found = found.select(*keys, *[F.lit(r[c]).alias(c) for c in ORDER], t, "forecast", "low", "high", "nll")
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = forecast(df.limit(0), keys, t, value, (0, 0, 0), season, h)
        return empty.select(*keys, *[F.lit(0).alias(c) for c in ORDER], t, "forecast", "low", "high", "nll")
    return out


def _last_state(z: np.ndarray, ar: np.ndarray, ma: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """The filter's state ahead of the step after the last, and what moves it a step on; with ``exact``
    from its exact start, else from nothing."""
    r = max(len(ar), len(ma) + 1, 1)
    load, trans = np.zeros(r), np.zeros((r, r))
    load[0] = 1.0
    load[1 : 1 + len(ma)] = ma
    trans[: len(ar), 0] = ar
    trans[np.arange(r - 1), np.arange(1, r)] = 1.0
    cov = start_covariance(trans[None], load[None])[0] if exact else None
    state = np.zeros(r)
    for v in z:
        gain = load if cov is None else cov[:, 0] / cov[0, 0]
        state = trans @ (state + gain * (v - state[0]))
        if cov is not None:
            cov = trans @ (cov - np.outer(gain, cov[0])) @ trans.T + np.outer(load, load)
            if np.abs(cov[:, 0] - load).max() < 1e-13:
                cov = None
    return state, trans
