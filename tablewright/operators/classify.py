"""Classifiers with their own Spark formulation: gradient logistic, Gaussian Bayes,
boosted stumps by reweighting, class representatives, weighted ensembles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.evaluate import auc_roc
from tablewright.operators.skew import held, spread_out
from tablewright.session import pin, small_table


def binary_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", count: str | None = None
) -> DataFrame:
    """(n, accuracy, precision, recall, f1) of 0/1 columns in one aggregate.

    ``count`` names a column with the number of rows that each row stands for.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    times = F.lit(1) if count is None else F.col(count)

    def rows(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, times)), F.lit(0))

    tp = rows((y == 1) & (p == 1))
    s = pred.agg(
        F.coalesce(F.sum(times), F.lit(0)).alias("n"),
        F.try_divide(rows(y == p), F.sum(times)).alias("accuracy"),
        F.coalesce(F.try_divide(tp, rows(p == 1)), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, rows(y == 1)), F.lit(0.0)).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    return s.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0)))


def with_auc(pred: DataFrame, score: str, label: str = "label", count: str | None = None) -> DataFrame:
    """Both from one pass over the predictions, which is reduced to counts per distinct score."""
    times = F.sum(count) if count else F.count(F.lit(1))
    counts = pin(pred.groupBy(label, "prediction", score).agg(times.alias("rows")))
    area = auc_roc(counts, score, F.col(label) == 1, count="rows").select("auc").scalar()
    return binary_metrics(counts, label, count="rows").withColumn("auc", area)


def multiclass_accuracy(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", count: str | None = None
) -> DataFrame:
    same = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    if count:
        n = F.coalesce(F.sum(count), F.lit(0))
        return pred.agg(n.alias("n"), F.try_divide(F.sum(same * F.col(count)), F.sum(count)).alias("accuracy"))
    return pred.agg(F.count(F.lit(1)).alias("n"), F.avg(same).alias("accuracy"))


def sgd_logistic(
    train: DataFrame, xs: Sequence[str], label: str, rates: Sequence[float], epochs: int = 15
) -> tuple[DataFrame, dict]:
    """(rate, epoch, log_loss) and the best weights, on standardised predictors.

    Full-batch gradient steps for all learning rates at once: one aggregate per
    epoch holds the loss and the gradient of every rate.
    """
    base = train.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(x).alias(f"m_{x}") for x in xs],
        *[F.stddev_pop(x).alias(f"s_{x}") for x in xs],
    ).first()
    z = [F.lit(1.0), *[(F.col(x) - base[f"m_{x}"]) / (base[f"s_{x}"] or 1.0) for x in xs]]
    rows = spread_out(train.select(F.col(label).cast("double").alias("y"), *[c.alias(f"z{i}") for i, c in enumerate(z)]))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # read once per epoch
    w = {r: np.zeros(len(z)) for r in rates}
    log, best = [], (math.inf, None, None)
    for epoch in range(epochs):
        aggs = []
        for i, r in enumerate(rates):
            lin = sum((F.lit(float(b)) * F.col(f"z{j}") for j, b in enumerate(w[r])), F.lit(0.0))
            p = 1 / (1 + F.exp(-lin))
            # log(1 + exp(lin)) - y * lin, in the form that cannot overflow
            loss = F.greatest(lin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(lin))) - F.col("y") * lin
            aggs.append(F.avg(loss).alias(f"l{i}"))
            aggs += [F.avg((p - F.col("y")) * F.col(f"z{j}")).alias(f"g{i}_{j}") for j in range(len(z))]
        row = rows.agg(*aggs).first()
        for i, r in enumerate(rates):
            log.append((float(r), epoch, float(row[f"l{i}"])))
            if row[f"l{i}"] < best[0]:
                best = (row[f"l{i}"], r, w[r].copy())
            w[r] = w[r] - r * np.array([row[f"g{i}_{j}"] for j in range(len(z))])
    table = small_table(train.sparkSession, log, "rate double, epoch int, log_loss double")
    rows.unpersist()
    scale = {x: (base[f"m_{x}"], base[f"s_{x}"] or 1.0) for x in xs}
    return table, {"rate": best[1], "weights": best[2], "scale": scale}


# -- Gaussian Bayes --------------------------------------------------------


def gaussian_parameters(train: DataFrame, label: str, xs: Sequence[str], cov: str) -> list[dict]:
    """Prior, mean, inverse covariance and log determinant per class (class-sized result).

    ``cov``: ``identity``; ``pooled``, the sample covariance of all rows; ``within``,
    the average of the class covariances; ``own``, one per class.
    """
    pairs = [(i, j) for i in range(len(xs)) for j in range(i, len(xs))]

    def aggs():
        return [
            F.count(F.lit(1)).alias("n"),
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
            *[F.covar_samp(xs[i], xs[j]).alias(f"c{i}_{j}") for i, j in pairs],
        ]

    def matrix(row):
        s = np.zeros((len(xs), len(xs)))
        for i, j in pairs:
            s[i, j] = s[j, i] = row[f"c{i}_{j}"] or 0.0
        return s

    # One row a class, as many as the result's parameters.
    rows = sorted(train.filter(F.col(label).isNotNull()).groupBy(label).agg(*aggs()).collect(), key=lambda r: r[label])
    total = sum(r["n"] for r in rows)
    if cov == "pooled":
        shared = matrix(train.agg(*aggs()).first())
    elif cov == "within":
        shared = sum((r["n"] - 1) * matrix(r) for r in rows if r["n"] > 1) / max(total - len(rows), 1)
    elif cov == "own":
        shared = matrix(train.agg(*aggs()).first())  # for classes of a single row
    else:
        shared = np.eye(len(xs))
    shared = _regular(np.zeros((len(xs), len(xs))) + shared)
    out = []
    for r in rows:
        s = _regular(matrix(r)) if cov == "own" and r["n"] > 1 else shared
        out.append(
            {
                "label": r[label],
                "prior": r["n"] / total,
                "mean": [r[f"m{i}"] for i in range(len(xs))],
                "inv": np.linalg.inv(s),
                "logdet": float(np.linalg.slogdet(s)[1]),
            }
        )
    return out


def _regular(s: np.ndarray) -> np.ndarray:
    """The matrix, or with a little on its diagonal if it cannot be inverted safely."""
    if np.isfinite(s).all() and np.linalg.cond(s) <= 1e10:
        return s
    return np.nan_to_num(s) + 1e-6 * max(float(np.trace(np.nan_to_num(s))) / len(s), 1.0) * np.eye(len(s))


def log_joint(params: Mapping, xs: Sequence[str]) -> Column:
    """Log density plus log prior of one class, up to a constant shared by all classes."""
    d = [F.col(x) - F.lit(float(m)) for x, m in zip(xs, params["mean"])]
    quad = F.lit(0.0)
    for i in range(len(xs)):
        for j in range(len(xs)):
            quad = quad + F.lit(float(params["inv"][i, j])) * d[i] * d[j]
    return F.lit(math.log(params["prior"]) - 0.5 * params["logdet"]) - 0.5 * quad


def gaussian_discriminant(train: DataFrame, rows: DataFrame, label: str, xs: Sequence[str], cov: str) -> DataFrame:
    """Rows with the most probable class; ties go to the class that sorts last, as 'at least' does."""
    params = gaussian_parameters(train, label, xs, cov)
    best = F.array_max(F.array(*[F.struct(log_joint(p, xs).alias("s"), F.lit(p["label"]).alias("c")) for p in params]))
    return rows.withColumn("prediction", best["c"])


def posteriors(train: DataFrame, rows: DataFrame, label: str, xs: Sequence[str], cov: str):
    """Rows with an array of class probabilities, and the class order."""
    params = gaussian_parameters(train, label, xs, cov)
    scored = rows.withColumns({f"_j{i}": log_joint(p, xs) for i, p in enumerate(params)})
    names = [f"_j{i}" for i in range(len(params))]
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    scored = scored.withColumn("_top", top)
    parts = [F.exp(F.col(n) - F.col("_top")) for n in names]
    total = sum(parts[1:], parts[0])
    post = F.array(*[p / total for p in parts])
    return scored.withColumn("posterior", post).drop("_top", *names), [p["label"] for p in params]


def bayes_min_risk(
    train: DataFrame, rows: DataFrame, label: str, xs: Sequence[str], loss: Sequence[Sequence[float]], cov: str = "own"
) -> DataFrame:
    """Rows with the decision of least expected loss; ``loss[true][decided]``, classes in sorted order."""
    scored, classes = posteriors(train, rows, label, xs, cov)
    risks = []
    for j, c in enumerate(classes):
        risk = F.lit(0.0)
        for i in range(len(classes)):
            risk = risk + F.col("posterior")[i] * F.lit(float(loss[i][j]))
        risks.append(F.struct(risk.alias("r"), F.lit(j).alias("j"), F.lit(c).alias("c")))
    return scored.withColumn("prediction", F.array_min(F.array(*risks))["c"])


# -- boosting by reweighting -----------------------------------------------


def adaboost(train: DataFrame, rows: DataFrame, features: str, label: str, rounds: int, depth: int = 1, seed: int = 7):
    """(rows with margin and prediction, [(round, error, alpha)]).

    Each round fits a shallow tree under the current weights. The weights are an
    expression over the earlier trees, evaluated while the rows are read; every
    tenth round they are written out, so the plan stays short.
    """
    from pyspark.ml.classification import DecisionTreeClassifier

    work = train.withColumn("_w", F.lit(1.0))
    out = rows.withColumn("margin", F.lit(0.0))
    log = []
    for r in range(rounds):
        wrong = (F.col("_p") != F.col(label)).cast("double")
        with held(work) as data:
            model = DecisionTreeClassifier(
                featuresCol=features, labelCol=label, weightCol="_w", maxDepth=depth, seed=seed,
                predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob",
            ).fit(data)
            err = model.transform(data).agg(F.sum(F.col("_w") * wrong) / F.sum("_w")).first()[0]
        scored = model.transform(work)
        if err >= 0.5:
            break
        alpha = 0.5 * math.log((1 - err + 1e-12) / (err + 1e-12))
        log.append((r, float(err), float(alpha)))
        sign = 2 * F.col("_p") - 1
        out = model.transform(out).withColumn("margin", F.col("margin") + F.lit(alpha) * sign).drop(
            "_p", "_raw", "_prob"
        )
        if err < 1e-9:
            break
        moved = scored.withColumn("_w", F.col("_w") * F.exp(F.lit(alpha) * (2 * wrong - 1)))
        work = moved.drop("_p", "_raw", "_prob")
        if r % 10 == 9:
            work = pin(work)
    return out.withColumn("prediction", (F.col("margin") >= 0).cast("double")), log


# -- class representatives -------------------------------------------------


def class_scatter(df: DataFrame, label: str, vec: str, dim: int) -> dict:
    """{class: (n, sum, sum of x x')}: partial sums per task and class, added by a JVM vector aggregate."""
    schema_label = df.schema[label].dataType.simpleString()

    def partial(batches):
        sums: dict = {}
        for b in batches:
            for key, g in b.groupby(label):
                x = np.vstack(g[vec].to_numpy()).astype(float)
                flat = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                sums[key] = sums.get(key, 0) + flat
        for key, flat in sums.items():
            yield pd.DataFrame({"label": [key], "s": [flat]})

    parts = df.select(label, vec).mapInPandas(partial, f"label {schema_label}, s array<double>")
    total = parts.groupBy("label").agg(Summarizer.sum(array_to_vector("s")).alias("s"))
    out = {}
    for r in total.collect():  # one row a class, as many as the result has
        s = r["s"].toArray()
        out[r["label"]] = (s[0], s[1 : dim + 1], s[dim + 1 :].reshape(dim, dim))
    return out


def group_representative(df: DataFrame, label: str, vec: str, how: str = "mean") -> dict:
    """{class: vector}: the class mean; the mean of its rank-1 reconstruction by principal
    component (``pca``, each row less its own mean) or by non-negative factor (``nmf``);
    or the member nearest to the mean (``norm``)."""
    from tablewright.operators.vectors import class_means

    if how == "mean":
        return class_means(df, label, vec)
    if how == "norm":
        from tablewright.functions.arrays import squared_distance
        from tablewright.operators.vectors import mean_vectors

        means = mean_vectors(df, label, vec)
        near = df.join(means, label).groupBy(label).agg(
            F.min_by(vec, F.struct(squared_distance(F.col(vec), F.col("mean")), F.col(vec))).alias("v")
        )
        return {r[label]: [float(x) for x in r["v"]] for r in near.collect()}
    doubles = F.transform(vec, lambda x: x.cast("double"))
    dim = df.agg(F.max(F.size(vec))).first()[0]
    rows = df.select(label, doubles.alias("v"))
    out = {}
    for key, (n, total, gram) in class_scatter(rows, label, "v", dim).items():
        mean = total / n
        if how == "pca":
            # Every row is centred on its own mean: x - m 1, so the scatter is P G P.
            p = np.eye(dim) - np.ones((dim, dim)) / dim
            u = np.linalg.eigh(p @ gram @ p)[1][:, -1]
            out[key] = list(mean.mean() + u * (u @ (p @ mean)))
        elif how == "nmf":
            u = np.abs(np.linalg.eigh(gram)[1][:, -1])
            out[key] = list(u * (u @ mean))
        else:
            raise ValueError(how)
    return out


# -- ensembles -------------------------------------------------------------


def _times(w: float):
    return lambda x: x * F.lit(w)


def ensemble_inverse_loss(models: Mapping[str, object], valid: DataFrame, rows: DataFrame, label: str):
    """(rows with averaged probabilities and prediction, {model: weight}): weight = 1 / log loss.

    All models score the same row, so no join brings their probabilities together.
    """

    def add_probabilities(df):
        for name, m in models.items():
            kept = df.columns
            df = m.transform(df).withColumn(f"p_{name}", vector_to_array("probability")).select(*kept, f"p_{name}")
        return df

    at = F.col(label).cast("int")
    losses = add_probabilities(valid).agg(
        *[
            F.avg(-F.log(F.least(F.greatest(F.get(f"p_{n}", at), F.lit(1e-15)), F.lit(1 - 1e-15)))).alias(n)
            for n in models
        ]
    ).first()
    weights = {n: 1.0 / losses[n] for n in models}
    total = sum(weights.values())
    weights = {n: w / total for n, w in weights.items()}
    scored = add_probabilities(rows)
    weighted = [F.transform(f"p_{n}", _times(w)) for n, w in weights.items()]
    avg = weighted[0]
    for more in weighted[1:]:
        avg = F.zip_with(avg, more, lambda a, b: a + b)
    scored = scored.withColumn("probability", avg).drop(*[f"p_{n}" for n in models])
    best = F.array_position("probability", F.array_max("probability")) - 1
    return scored.withColumn("prediction", best.cast("double")), weights
