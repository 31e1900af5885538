"""Series operators over long tables ``(keys..., t, value)`` with an integer step ``t``.

``t`` is dense: one row per step between a key's first and last step, as
``fill_steps`` makes it. Windows run block by block (see ``ordering``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import null_safe_join
from tablewright.operators.ordering import block_scan, step_window
from tablewright.operators.skew import attach


def fill_steps(df: DataFrame, keys: Sequence[str], t: str, chunk: int = 10_000) -> DataFrame:
    """Calendar left join: every step between a key's first and last one, gaps as NULL.

    The calendar is exploded in two levels, so a long span is not one array.
    """
    lo, hi = F.col("_lo"), F.col("_hi")
    span = df.groupBy(*keys).agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    starts = span.withColumn("_from", F.explode(F.sequence(lo, hi, F.lit(chunk).cast("long"))))
    starts = starts.repartition(*keys, "_from")
    steps = starts.select(
        *keys, F.explode(F.sequence("_from", F.least(hi, F.col("_from") + (chunk - 1)))).alias(t)
    )
    return null_safe_join(steps, df, [*keys, t], "left")


def lag_diff(df: DataFrame, keys, t: str, value: str, out: str = "diff", m: int = 1) -> DataFrame:
    """v(t) - v(t-m); m > 1 gives the seasonal difference."""
    v = F.col(value)
    return step_window(df, keys, t, lambda w: {out: v - F.lag(v, m).over(w)}, before=m)


def log_diff(df: DataFrame, keys, t: str, value: str, out: str = "log_diff") -> DataFrame:
    """ln v(t) - ln v(t-1); NULL where either value is not positive."""
    ln = F.when(F.col(value) > 0, F.log(value))
    return step_window(df, keys, t, lambda w: {out: ln - F.lag(ln).over(w)}, before=1)


def rolling_mean_std(df: DataFrame, keys, t: str, value: str, width: int) -> DataFrame:
    """Trailing mean and sample deviation, NULL until ``width`` values are there."""

    def build(w):
        frame = w.rowsBetween(1 - width, 0)
        full = F.count(value).over(frame) == width
        return {
            "rolling_mean": F.when(full, F.avg(value).over(frame)),
            "rolling_std": F.when(full, F.stddev_samp(value).over(frame)),
        }

    return step_window(df, keys, t, build, before=width - 1)


def forward_fill(df: DataFrame, keys, t: str, value: str, out: str = "filled") -> DataFrame:
    return block_scan(df, keys, t, value, out, "last")


def linear_interpolate(df: DataFrame, keys, t: str, value: str, out: str = "filled") -> DataFrame:
    """Straight line between the nearest known neighbours; ends stay NULL."""
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(t).alias("t"), F.col(value).alias("v")))
    rows = df.withColumn("_pt", point)
    rows = block_scan(rows, keys, t, "_pt", "_left", "last")
    rows = block_scan(rows, keys, t, "_pt", "_right", "next")
    left, right = F.col("_left"), F.col("_right")
    share = (F.col(t) - left["t"]) / F.nullif(right["t"] - left["t"], F.lit(0))
    line = left["v"] + (right["v"] - left["v"]) * share
    return rows.select(*df.columns, F.coalesce(F.col(value), line).alias(out))


def cumulative_sum(df: DataFrame, keys, t: str, value: str, out: str = "running") -> DataFrame:
    return block_scan(df, keys, t, value, out, "sum")


def lag_features(df: DataFrame, keys, t: str, value: str, k: int, prefix: str = "lag") -> DataFrame:
    """Columns lag_1..lag_k beside the target; steps without a full history are left out."""
    v = F.col(value)
    rows = step_window(
        df, keys, t, lambda w: {f"{prefix}_{i}": F.lag(v, i).over(w) for i in range(1, k + 1)}, before=k
    )
    return rows.dropna(subset=[f"{prefix}_{i}" for i in range(1, k + 1)])


def time_split(df: DataFrame, keys, t: str, frac: float = 0.8, out: str = "part") -> DataFrame:
    """First ``frac`` of each series is train, the rest test; needs no sort as t is dense."""
    span = df.groupBy(*keys).agg(F.min(t).alias("_lo"), F.count(F.lit(1)).alias("_n"))
    head = F.col(t) - F.col("_lo") < F.floor(F.col("_n") * F.lit(frac))
    return (
        attach(df, span, keys)
        .withColumn(out, F.when(head, "train").otherwise("test"))
        .drop("_lo", "_n")
    )


def fourier_terms(df: DataFrame, t: str, period: float, order: int) -> DataFrame:
    """sin_j, cos_j of 2*pi*j*t/period for j = 1..order."""
    cols = {}
    for j in range(1, order + 1):
        angle = F.lit(2 * math.pi * j / period) * F.col(t)
        cols[f"sin_{j}"] = F.sin(angle)
        cols[f"cos_{j}"] = F.cos(angle)
    return df.withColumns(cols)


def business_days(days: DataFrame, day: str) -> DataFrame:
    """Keep Monday to Friday."""
    return days.filter(F.weekday(day) < 5)


def series_stats(df: DataFrame, keys, value: str, **more: Column) -> DataFrame:
    """Per-series count and mean beside the rows, from a map-side combined aggregate."""
    stats = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), *[
        c.alias(k) for k, c in more.items()
    ])
    return attach(df, stats, keys)
