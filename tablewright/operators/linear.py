"""Least squares from moments.

Each fit is one aggregate of means and covariances per group (map-side combined,
so a hot group costs no more than any other) and a solve of p-by-p size on the
moment rows. Raw rows never reach Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.distributions import t_quantile, t_two_sided_p
from tablewright.session import small_table


def moments(df: DataFrame, xs: Sequence[str], y: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, mx, my, sxx, sxy, syy): centred moments of the complete rows."""
    cols = [*xs, y]
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    pairs = [(a, b) for i, a in enumerate(xs) for b in xs[i:]]

    def listed(parts: list[Column]) -> Column:
        return F.array(*parts) if parts else F.array().cast("array<double>")

    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        listed([F.avg(x) for x in xs]).alias("mx"),
        F.avg(y).alias("my"),
        listed([F.covar_pop(a, b) for a, b in pairs]).alias("sxx"),
        listed([F.covar_pop(x, y) for x in xs]).alias("sxy"),
        F.covar_pop(y, y).alias("syy"),
    )


def solve_row(n, mx, my, sxx, sxy, syy, ridge: float = 0.0):
    """Coefficients (intercept first), standard errors, residual sum of squares, R2 of one moment row."""
    mx, sxy = np.asarray(mx, float), np.asarray(sxy, float)
    p = len(mx)
    s = np.zeros((p, p))
    s[np.triu_indices(p)] = sxx
    s = s + np.triu(s, 1).T
    inv = np.linalg.pinv(s + ridge * np.eye(p), hermitian=True) if p else s
    beta = inv @ sxy
    sse = max(n * (syy - 2 * beta @ sxy + beta @ s @ beta), 0.0)
    dof = n - p - 1
    sigma2 = sse / dof if dof > 0 else float("nan")
    var = sigma2 * inv / n
    se0 = sigma2 * (1 / n + mx @ inv @ mx / n)
    coef = np.concatenate([[my - beta @ mx], beta])
    se = np.sqrt(np.maximum(np.concatenate([[se0], np.diag(var)]), 0))
    r2 = 1 - sse / (n * syy) if syy and syy > 0 else float("nan")
    return coef, se, sse, r2


FIT_FIELDS = "n long, coef array<double>, se array<double>, sse double, r2 double"


def fit_groups(df: DataFrame, xs: Sequence[str], y: str, keys: Sequence[str]) -> DataFrame:
    """(keys, n, coef, se, sse, r2) per group; the solves run where the moment rows are."""
    schema = T.StructType([df.schema[k] for k in keys] + T._parse_datatype_string(FIT_FIELDS).fields)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                if r.n == 0:
                    continue
                coef, se, sse, r2 = solve_row(r.n, r.mx, r.my, r.sxx, r.sxy, r.syy)
                out.append([*[getattr(r, k) for k in keys], r.n, coef, se, sse, r2])
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return moments(df, xs, y, keys).mapInPandas(solve, schema)


def ols_coefficients(df: DataFrame, xs: Sequence[str], y: str, ridge: float = 0.0) -> dict[str, float]:
    """One fit over the whole table; p + 1 numbers on the driver."""
    r = moments(df, xs, y).first()
    coef, *_ = solve_row(r["n"], r["mx"], r["my"], r["sxx"], r["sxy"], r["syy"], ridge)
    return dict(zip(["intercept", *xs], map(float, coef)))


def predict(coef: dict[str, float]) -> Column:
    out = F.lit(coef["intercept"])
    for name, b in coef.items():
        if name != "intercept":
            out = out + F.lit(b) * F.col(name).cast("double")
    return out


def ols_simple(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, slope, intercept, r2) of one predictor, all by built-in aggregates."""
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def ols_inference(df: DataFrame, xs: Sequence[str], y: str, level: float = 0.95) -> DataFrame:
    """(term, coef, std_err, t, p, ci_low, ci_high) of a multiple regression."""
    r = moments(df, xs, y).first()
    coef, se, sse, _ = solve_row(r["n"], r["mx"], r["my"], r["sxx"], r["sxy"], r["syy"])
    dof = r["n"] - len(xs) - 1
    q = t_quantile(0.5 + level / 2, dof)
    rows = []
    for name, b, s in zip(["intercept", *xs], coef, se):
        t = b / s if s > 0 else float("nan")
        rows.append((name, float(b), float(s), float(t), t_two_sided_p(t, dof), float(b - q * s), float(b + q * s)))
    return small_table(
        df.sparkSession, rows, "term string, coef double, std_err double, t double, p double, ci_low double, ci_high double"
    )


def ols_intervals(df: DataFrame, xs: Sequence[str], y: str, level: float = 0.95) -> DataFrame:
    """Rows with fit, confidence and prediction interval; the quadratic form is a column expression."""
    r = moments(df, xs, y).first()
    n, p = r["n"], len(xs)
    coef, _, sse, _ = solve_row(n, r["mx"], r["my"], r["sxx"], r["sxy"], r["syy"])
    s = np.zeros((p, p))
    s[np.triu_indices(p)] = r["sxx"]
    s = s + np.triu(s, 1).T
    inv = np.linalg.pinv(s, hermitian=True) / n
    sigma2 = sse / (n - p - 1)
    q = t_quantile(0.5 + level / 2, n - p - 1)
    lever = F.lit(1.0 / n)
    for i, a in enumerate(xs):
        for j, b in enumerate(xs):
            lever = lever + F.lit(float(inv[i, j])) * (F.col(a) - r["mx"][i]) * (F.col(b) - r["mx"][j])
    fit = predict(dict(zip(["intercept", *xs], map(float, coef))))
    conf, pred = F.lit(q) * F.sqrt(sigma2 * lever), F.lit(q) * F.sqrt(sigma2 * (1 + lever))
    return df.withColumns(
        {
            "fit": fit,
            "ci_low": fit - conf,
            "ci_high": fit + conf,
            "pi_low": fit - pred,
            "pi_high": fit + pred,
        }
    )


def poly_regression_sweep(train: DataFrame, test: DataFrame, x: str, y: str, degrees: Sequence[int]) -> DataFrame:
    """(degree, mae, rmse, r2, best): one moment aggregate for the highest degree serves all degrees.

    The predictor is scaled to deviations first, which keeps high powers solvable.
    """
    base = train.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).first()
    z = (F.col(x) - base["m"]) / (base["s"] or 1.0)

    def powers(df):
        return df.select(F.col(y).cast("double").alias("_y"), *[F.pow(z, d).alias(f"z{d}") for d in range(1, max(degrees) + 1)])

    r = moments(powers(train), [f"z{d}" for d in range(1, max(degrees) + 1)], "_y").first()
    top = max(degrees)
    full = np.zeros((top, top))
    full[np.triu_indices(top)] = r["sxx"]
    full = full + np.triu(full, 1).T
    aggs = {}
    rows = powers(test)
    for d in degrees:
        sub = full[:d, :d]
        coef, *_ = solve_row(r["n"], r["mx"][:d], r["my"], sub[np.triu_indices(d)], r["sxy"][:d], r["syy"])
        e = F.col("_y") - predict(dict(zip(["intercept", *[f"z{i}" for i in range(1, d + 1)]], map(float, coef))))
        aggs[d] = (F.avg(F.abs(e)), F.sqrt(F.avg(e * e)), 1 - F.try_divide(F.avg(e * e), F.var_pop("_y")))
    out = rows.agg(*[F.struct(F.lit(d).alias("degree"), a.alias("mae"), b.alias("rmse"), c.alias("r2")).alias(f"d{d}") for d, (a, b, c) in aggs.items()])
    report = out.select(F.inline(F.array(*[F.col(f"d{d}") for d in degrees])))
    best = report.agg(F.min_by("degree", "rmse")).scalar()
    return report.withColumn("best", (F.col("degree") == best).cast("int"))


def ridge_lasso(df: DataFrame, xs: Sequence[str], y: str, alphas: Sequence[float]) -> DataFrame:
    """(penalty, alpha, term, coef, rmse): coefficient paths on standardised predictors.

    Both penalties are solved from one correlation-size moment row: ridge directly,
    lasso by coordinate descent on the p-by-p matrix.
    """
    r = moments(df, xs, y).first()
    p, n = len(xs), r["n"]
    s = np.zeros((p, p))
    s[np.triu_indices(p)] = r["sxx"]
    s = s + np.triu(s, 1).T
    sd = np.sqrt(np.maximum(np.diag(s), 1e-300))
    corr, cxy = s / np.outer(sd, sd), np.asarray(r["sxy"]) / sd
    rows = []
    for alpha in alphas:
        ridge = np.linalg.solve(corr + alpha * np.eye(p), cxy)
        lasso = np.zeros(p)
        for _ in range(1000):
            old = lasso.copy()
            for j in range(p):
                rho = cxy[j] - corr[j] @ lasso + corr[j, j] * lasso[j]
                lasso[j] = math.copysign(max(abs(rho) - alpha, 0.0), rho) / corr[j, j]
            if np.abs(lasso - old).max() < 1e-12:
                break
        for name, b in (("ridge", ridge), ("lasso", lasso)):
            mse = r["syy"] - 2 * b @ cxy + b @ corr @ b
            for term, v in zip(xs, b / sd):
                rows.append((name, float(alpha), term, float(v), float(math.sqrt(max(mse, 0)))))
    return small_table(
        df.sparkSession, rows, "penalty string, alpha double, term string, coef double, rmse double"
    )


def tls_regression(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """(term, coef): total least squares on standardised columns, given in the original units.

    The smallest eigenvector of the correlation matrix is the normal of the plane.
    """
    r = moments(df, xs, y).first()
    p = len(xs)
    s = np.zeros((p + 1, p + 1))
    inner = np.zeros((p, p))
    inner[np.triu_indices(p)] = r["sxx"]
    s[:p, :p] = inner + np.triu(inner, 1).T
    s[:p, p] = s[p, :p] = r["sxy"]
    s[p, p] = r["syy"]
    sd = np.sqrt(np.diag(s))
    values, vectors = np.linalg.eigh(s / np.outer(sd, sd))
    v = vectors[:, values.argmin()]
    beta = -v[:p] / v[p] * sd[p] / sd[:p]
    intercept = r["my"] - beta @ np.asarray(r["mx"])
    rows = [("intercept", float(intercept)), *[(x, float(b)) for x, b in zip(xs, beta)]]
    return small_table(df.sparkSession, rows, "term string, coef double")


def kernel_regression(
    df: DataFrame, key: str, vec: str, y: str, m: int = 24, kernel: str = "rbf", param: float = 1.0,
    ridge: float = 1e-3, components: int | None = None,
) -> DataFrame:
    """Rows with a prediction: ridge on a landmark kernel map, or on its principal components."""
    from tablewright.operators import features as X

    lifted = X.nystrom_features(df, key, vec, m, kernel, param, "_phi")
    source, width = "_phi", m
    if components:
        lifted, _ = X.pca_project(lifted, "_phi", components, "_pc")
        source, width = "_pc", components
    names = [f"_k{i}" for i in range(width)]
    wide = lifted.select("*", *[F.col(source)[i].alias(n) for i, n in enumerate(names)])
    coef = ols_coefficients(wide, names, y, ridge)
    return wide.withColumn("prediction", predict(coef)).drop("_phi", "_pc", *names)
