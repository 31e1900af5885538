"""Metrics over prediction tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.aggs import histogram
from tablewright.operators.features import levels_of
from tablewright.operators.ordering import running_totals, step_window
from tablewright.operators.skew import attach
from tablewright.session import pin_small


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n) on the full grid of the classes seen on either side."""
    counts = pin_small(
        df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    seen = counts.select(F.explode(F.array("label", "prediction")).alias("c"))
    classes = levels_of(seen, "c")
    cells = F.array(*[F.lit(c) for c in classes])
    grid = df.sparkSession.range(1).select(F.explode(cells).alias("label")).select(
        "label", F.explode(cells).alias("prediction")
    )
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then macro, weighted and accuracy rows."""
    counts = df.groupBy(F.col(label).cast("string").alias("l"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("l").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                         F.lit(0).cast("long").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    zero = F.lit(0.0)
    per = per.withColumn("precision", F.coalesce(F.try_divide("hit", "predicted"), zero)).withColumn(
        "recall", F.coalesce(F.try_divide("hit", "support"), zero)
    )
    p, r = F.col("precision"), F.col("recall")
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), zero))
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / total

    summary = per.agg(
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
        (F.sum("hit") / total).alias("acc"),
        total.alias("n"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("class"),
                        F.col(a).alias("precision"),
                        F.col(b).alias("recall"),
                        F.col(c).alias("f1"),
                        F.col("n").alias("support"),
                    )
                    for name, a, b, c in (
                        ("macro", "m_precision", "m_recall", "m_f1"),
                        ("weighted", "w_precision", "w_recall", "w_f1"),
                        ("accuracy", "acc", "acc", "acc"),
                    )
                ]
            )
        )
    )
    return per.select("class", "precision", "recall", "f1", "support").unionByName(summary)


def score_counts(
    df: DataFrame, score: str, positive: Column, keys: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score, and running totals from the highest score down.

    ``count`` names a column with the number of rows that each row stands for.
    """
    times = F.lit(1).cast("long") if count is None else F.col(count)
    zero = F.lit(0).cast("long")
    grouped = df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.sum(F.when(positive, times).otherwise(zero)).alias("pos"),
        F.sum(F.when(positive, zero).otherwise(times)).alias("neg"),
    )
    down = grouped.withColumn("_down", -F.col("score"))
    return running_totals(down, list(keys), ["_down"], {"tp": "pos", "fp": "neg"}).drop("_down")


def roc_points(df: DataFrame, score: str, positive: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, threshold, fpr, tpr): one point per distinct score."""
    run = score_counts(df, score, positive, keys)
    return run.select(
        *keys,
        F.col("score").alias("threshold"),
        F.try_divide("fp", "fp_total").alias("fpr"),
        F.try_divide("tp", "tp_total").alias("tpr"),
    )


def auc_roc(
    df: DataFrame, score: str, positive: Column, keys: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    """Area under the curve; equal scores count half (rank-sum form)."""
    run = score_counts(df, score, positive, keys, count)
    # Positives above each negative, plus half of those at the same score.
    above = F.col("tp") - F.col("pos")
    wins = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    pairs = F.max("tp_total").cast("double") * F.max("fp_total")
    return run.groupBy(*keys).agg(F.try_divide(wins, pairs).alias("auc"))


def log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    loss = F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.agg(F.avg(loss).alias("log_loss"))


def log_loss_multi(df: DataFrame, true_prob: Column, eps: float = 1e-15) -> DataFrame:
    """``true_prob`` is the probability given to the true class."""
    return df.agg(F.avg(-F.log(F.least(F.greatest(true_prob, F.lit(eps)), F.lit(1 - eps)))).alias("log_loss"))


def hinge_loss(df: DataFrame, signed_label: Column, score: Column) -> DataFrame:
    per_row = F.greatest(F.lit(0.0), 1 - signed_label * score)
    return df.agg(F.sum(per_row).alias("hinge_sum"), F.avg(per_row).alias("hinge_mean"))


def zero_one_error(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) != F.col(prediction)).cast("double")).alias("error"))


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, n_features: int = 1, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys, n, mae, mse, rmse, r2, adj_r2) in one aggregate."""
    e = F.col(actual) - F.col(predicted)
    out = df.groupBy(*keys).agg(
        F.count(e).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(actual))).alias("r2"),
    )
    adj = 1 - (1 - F.col("r2")) * F.try_divide(F.col("n") - 1, F.col("n") - n_features - 1)
    return out.withColumn("adj_r2", adj)


def mape(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Two readings: rows with zero actuals left out (``mape``), or counted with actual 0 over 1
    (``mape_masked``); both as fractions."""
    a, p = F.col(actual), F.col(predicted)
    plain = F.abs(F.try_divide(a - p, a))
    masked = F.abs(a - p) / F.when(a == 0, F.lit(1.0)).otherwise(a)
    return df.groupBy(*keys).agg(F.avg(plain).alias("mape"), F.avg(masked).alias("mape_masked"))


def residual_runs_test(df: DataFrame, keys: Sequence[str], t: str, resid: str) -> DataFrame:
    """(keys, n, runs, z, p): Wald-Wolfowitz runs about the mean.

    Up to 50 values the distance to the expected count is cut by one half.
    """
    means = df.groupBy(*keys).agg(F.avg(resid).alias("_mean"))
    side = attach(df, means, keys).withColumn("_up", (F.col(resid) >= F.col("_mean")).cast("int"))
    marked = step_window(
        side, keys, t, lambda w: {"_turn": (F.col("_up") != F.lag("_up").over(w)).cast("int")}, before=1
    )
    s = marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (1 + F.coalesce(F.sum("_turn"), F.lit(0))).alias("runs"),
        F.sum("_up").alias("_a"),
    )
    a, n = F.col("_a").cast("double"), F.col("n").cast("double")
    ab = 2 * a * (n - a)
    mean = 1 + ab / n
    var = F.try_divide(ab * (ab - n), n * n * (n - 1))
    gap = F.col("runs") - mean
    cut = (
        F.when(F.col("n") > 50, gap)
        .when(gap > 0.5, gap - 0.5)
        .when(gap < -0.5, gap + 0.5)
        .otherwise(F.lit(0.0))
    )
    return s.withColumn("z", F.try_divide(cut, F.sqrt(var))).select(
        *keys, "n", "runs", "z", two_sided_normal_p(F.col("z")).alias("p")
    )


def two_sided_normal_p(z: Column) -> Column:
    """P(|Z| > |z|); meant for a column of test statistics, one row per series."""

    @F.pandas_udf("double")
    def tail(v: pd.Series) -> pd.Series:
        return v.map(lambda x: math.erfc(abs(x) / math.sqrt(2)) if pd.notna(x) else None).astype(float)

    return tail(z)


def residual_table(df: DataFrame, actual: str, predicted: str, out: str = "residual") -> DataFrame:
    return df.withColumn(out, F.col(actual) - F.col(predicted))


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int) -> DataFrame:
    return histogram(residual_table(df, actual, predicted), "residual", bins)

