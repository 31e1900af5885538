"""Encoders, scalers, expansions and matrix features."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordering import dense_index
from tablewright.operators.skew import attach
from tablewright.session import pin_small


def levels_of(df: DataFrame, col: str) -> list:
    """Sorted distinct values; as many as the result will have columns."""
    return sorted(r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().collect())


def label_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """(col, out): 0 for the most frequent value, ties by value. Any number of levels."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg((-F.count(F.lit(1))).alias("_neg"))
    return dense_index(counts, [], ["_neg", col], out).drop("_neg")


def encode_label(train: DataFrame, rows: DataFrame, col: str, out: str) -> DataFrame:
    """Frequency index fitted on ``train``; values not seen there get the next index."""
    index = label_index(train, col, out)
    index = pin_small(index)
    unseen = index.agg(F.count(F.lit(1))).scalar()
    return attach(rows, index, [col], "left").withColumn(out, F.coalesce(out, unseen))


def encode_ordinal(value: Column, order: Sequence) -> Column:
    """0, 1, 2, ... in the given order; -1 for anything else."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), value)
    return (F.coalesce(place, F.lit(0)) - 1).cast("int")


def encode_onehot(df: DataFrame, col: str, levels: Sequence | None = None) -> DataFrame:
    """One 0/1 column per level."""
    levels = levels_of(df, col) if levels is None else levels
    return df.withColumns({f"{col}_{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in levels})


def encode_onehot_vector(df: DataFrame, col: str, out: str) -> DataFrame:
    """The same as one sparse vector column, for a column of any number of levels: an index by
    frequency (``encode_label``), then a vector with a 1 at its place; NULL is all zeros."""
    from pyspark.ml.feature import OneHotEncoder

    index = f"_{out}_index"
    coded = encode_label(df, df, col, index).withColumn(index, F.col(index).cast("double"))  # NULL: one past the last
    levels = df.select(F.count_distinct(col)).first()[0]
    ends = df.sparkSession.range(levels + 1).select(F.col("id").cast("double").alias(index))
    encoder = OneHotEncoder(inputCol=index, outputCol=out, dropLast=True)
    return encoder.fit(ends).transform(coded).drop(index)


def encode_dummies(df: DataFrame, col: str, levels: Sequence | None = None) -> DataFrame:
    """The same without the first level, and without the source column."""
    levels = levels_of(df, col) if levels is None else sorted(levels)
    return encode_onehot(df, col, levels[1:]).drop(col)


def encode_target(df: DataFrame, col: str, y: str, leave_one_out: bool = False) -> DataFrame:
    """Mean target per category beside each row; optionally without the row itself.

    NULL is a category like any other.
    """
    stats = df.groupBy(col).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    joined = attach(df, stats, [col])
    if leave_one_out:
        enc = F.try_divide(F.col("_s") - F.col(y), F.col("_n") - 1)
    else:
        enc = F.try_divide("_s", "_n")
    return joined.withColumn(f"{col}_target", enc).drop("_s", "_n")


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "keep") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def scale_standard(train: DataFrame, rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation, both from ``train``."""
    return rows.withColumns(
        {
            c: F.try_divide(
                F.col(c) - train.agg(F.avg(c)).scalar(), train.agg(F.stddev_pop(c)).scalar()
            )
            for c in cols
        }
    )


def scale_minmax(train: DataFrame, rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rescaled so that the range of ``train`` is [0, 1]."""
    out = {}
    for c in cols:
        lo, hi = train.agg(F.min(c)).scalar(), train.agg(F.max(c)).scalar()
        out[c] = F.try_divide((F.col(c) - lo).cast("double"), (hi - lo).cast("double"))
    return rows.withColumns(out)


def poly_features(df: DataFrame, cols: Sequence[str], degree: int) -> DataFrame:
    """All monomials of degree 1..d, named by their factors: ``a*a*b``."""
    out = {}
    for d in range(1, degree + 1):
        for combo in itertools.combinations_with_replacement(cols, d):
            term = F.col(combo[0]).cast("double")
            for c in combo[1:]:
                term = term * F.col(c)
            out["*".join(combo)] = term
    kept = [c for c in df.columns if c not in out]
    return df.select(*kept, *[v.alias(k) for k, v in out.items()])


def radial_feature(x: str, y: str) -> Column:
    return F.col(x) * F.col(x) + F.col(y) * F.col(y)


def category_scale(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """Levels per category column, and the median of the numbers' deviations."""
    row = df.agg(*[F.stddev_pop(c).alias(c) for c in numeric]).first()
    return {c: levels_of(df, c) for c in categorical}, float(np.median([row[c] or 0.0 for c in numeric]))


# -- matrix features over an array column ----------------------------------


def _matrix(v: pd.Series) -> np.ndarray:
    return np.vstack(v.to_numpy()).astype(float)


def gram_matrix(df: DataFrame, vec: str, dim: int, center: Sequence[float] | None = None) -> np.ndarray:
    """Sum of x x' over all rows: one d*d partial per task, added up by a JVM vector aggregate."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    mu = np.zeros(dim) if center is None else np.asarray(center)

    def partial(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            if len(b):
                x = _matrix(b[vec]) - mu
                total += x.T @ x
        yield pd.DataFrame({"g": [total.ravel()]})

    parts = df.select(vec).mapInPandas(partial, "g array<double>")
    row = parts.select(array_to_vector("g").alias("g")).agg(Summarizer.sum(F.col("g")).alias("g")).first()
    return row["g"].toArray().reshape(dim, dim)


def vector_dim(df: DataFrame, vec: str) -> int:
    return df.agg(F.max(F.size(vec))).first()[0]


def _project(columns: np.ndarray, center: np.ndarray | None = None):
    @F.pandas_udf("array<double>")
    def apply(v: pd.Series) -> pd.Series:
        if len(v) == 0:
            return pd.Series([], dtype=object)
        x = _matrix(v) if center is None else _matrix(v) - center
        return pd.Series(list(x @ columns), index=v.index)

    return apply


def pca_model(df: DataFrame, vec: str, k: int):
    """(mean, components d*k, share of variance per component), d-sized results only."""
    from tablewright.operators.vectors import mean_vectors

    dim = vector_dim(df, vec)
    mean = np.array(mean_vectors(df.withColumn("_all", F.lit(1)), "_all", vec).first()["mean"])
    values, vectors = np.linalg.eigh(gram_matrix(df, vec, dim, mean))
    order = np.argsort(values)[::-1]
    share = values[order] / values.sum()
    comp = vectors[:, order[:k]]
    comp = comp * np.sign(comp[np.abs(comp).argmax(axis=0), np.arange(k)])  # fixed signs
    return mean, comp, share[:k]


def pca_project(df: DataFrame, vec: str, k: int, out: str = "scores"):
    """Rows with their k principal scores, and the variance shares."""
    mean, comp, share = pca_model(df, vec, k)
    return df.withColumn(out, _project(comp, mean)(vec)), share


def svd_low_rank(df: DataFrame, vec: str, k: int, out: str = "approx") -> DataFrame:
    """Best rank-k reconstruction of the rows (right singular vectors from the Gram matrix)."""
    values, vectors = np.linalg.eigh(gram_matrix(df, vec, vector_dim(df, vec)))
    top = vectors[:, np.argsort(values)[::-1][:k]]
    return df.withColumn(out, _project(top @ top.T)(vec))


def landmark_rows(df: DataFrame, key: str, vec: str, m: int) -> np.ndarray:
    """m rows in hash order; each task keeps m, so the choice needs no sort of the table."""
    rows = df.orderBy(F.xxhash64(key), key).select(vec).limit(m).collect()
    return np.array([r[0] for r in rows], dtype=float)


def kernel_matrix(x: np.ndarray, y: np.ndarray, kernel: str, param: float) -> np.ndarray:
    if kernel == "rbf":
        d2 = ((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2) if len(x) * len(y) * x.shape[1] < 4e6 else (
            (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T
        )
        return np.exp(-param * np.maximum(d2, 0.0))
    if kernel == "poly":
        return (x @ y.T + 1.0) ** param
    raise ValueError(kernel)


def nystrom_features(
    df: DataFrame, key: str, vec: str, m: int = 32, kernel: str = "rbf", param: float = 1.0, out: str = "phi"
) -> DataFrame:
    """Kernel map by m landmark rows: similarities times K_mm^(-1/2).

    Only the m landmarks travel; rows stay where they are.
    """
    return df.withColumn(out, nystrom_map(df, key, vec, m, kernel, param)(vec))


def nystrom_map(df: DataFrame, key: str, vec: str, m: int, kernel: str, param: float):
    """The map as a function of a column, with landmarks taken from ``df``."""
    marks = landmark_rows(df, key, vec, m)
    values, vectors = np.linalg.eigh(kernel_matrix(marks, marks, kernel, param))
    keep = values > values.max() * 1e-10
    root = vectors[:, keep] @ np.diag(values[keep] ** -0.5) @ vectors[:, keep].T

    @F.pandas_udf("array<double>")
    def lift(v: pd.Series) -> pd.Series:
        if len(v) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(kernel_matrix(_matrix(v), marks, kernel, param) @ root), index=v.index)

    return lift


def _weights(x: np.ndarray, h: np.ndarray, steps: int) -> np.ndarray:
    """Non-negative row weights for fixed factors, by multiplicative steps from a flat start."""
    w = np.full((len(x), len(h)), max(x.mean(), 1e-9))
    xh, hh = x @ h.T, h @ h.T
    for _ in range(steps):
        w *= xh / np.maximum(w @ hh, 1e-12)
    return w


def nmf_factors(df: DataFrame, key: str, vec: str, k: int, rounds: int = 8, steps: int = 20):
    """(factors k*d, rows with their weights): alternating non-negative factorisation.

    Each round is one pass: weights are recomputed row by row from the factors, and
    only the k*d and k*k sums leave a task.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    h = np.maximum(landmark_rows(df, key, vec, k), 1e-3)
    d = h.shape[1]

    def sums(h_now):
        def partial(batches):
            wx, ww = np.zeros((k, d)), np.zeros((k, k))
            for b in batches:
                if len(b):
                    x = _matrix(b[vec])
                    w = _weights(x, h_now, steps)
                    wx += w.T @ x
                    ww += w.T @ w
            yield pd.DataFrame({"s": [np.concatenate([wx.ravel(), ww.ravel()])]})

        return partial

    for _ in range(rounds):
        parts = df.select(vec).mapInPandas(sums(h), "s array<double>")
        row = parts.select(array_to_vector("s").alias("s")).agg(Summarizer.sum(F.col("s")).alias("s")).first()
        flat = row["s"].toArray()
        wx, ww = flat[: k * d].reshape(k, d), flat[k * d :].reshape(k, k)
        for _ in range(steps):
            h = h * wx / np.maximum(ww @ h, 1e-12)
    final = h

    @F.pandas_udf("array<double>")
    def weigh(v: pd.Series) -> pd.Series:
        if len(v) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(_weights(_matrix(v), final, steps)), index=v.index)

    return final, df.withColumn("weights", weigh(vec))


def select_by_importance(importances: Mapping[str, float], threshold: float | None = None) -> list[str]:
    """Names whose importance reaches the threshold (default: the mean)."""
    bar = float(np.mean(list(importances.values()))) if threshold is None else threshold
    return [c for c, v in importances.items() if v >= bar]
