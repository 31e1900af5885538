"""Ranking, outliers and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.aggs import long_values
from tablewright.operators.ordering import exact_quantiles


def rank_topk(df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Rank <= k per partition, ties kept. The rank filter lets Spark cut each task's
    share of a partition before the shuffle."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= k)


def rownum_topk(df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Exactly k rows per partition; the order must break all ties."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def zscore_outliers(df: DataFrame, col: str, n: float = 3.0) -> DataFrame:
    """Rows above mean + n sample deviations; the bound is a scalar subquery."""
    bound = df.agg(F.avg(col) + F.lit(n) * F.stddev_samp(col)).scalar()
    return df.filter(F.col(col) > bound)


def iqr_fences(df: DataFrame, col: str) -> DataFrame:
    """Box-plot numbers of a column: quartiles, fences and the count outside them."""
    q = exact_quantiles(
        long_values(df, [col]), ["column_name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    spread = (F.col("q75") - F.col("q25")) * 1.5
    return q.withColumn("lower", F.col("q25") - spread).withColumn("upper", F.col("q75") + spread)


def iqr_outliers(df: DataFrame, col: str, fences: DataFrame | None = None) -> DataFrame:
    """Rows beyond 1.5 interquartile ranges from the quartiles; ``fences`` if they are known already."""
    fences = iqr_fences(df, col) if fences is None else fences
    lower = fences.select("lower").scalar()
    upper = fences.select("upper").scalar()
    return df.filter((F.col(col) < lower) | (F.col(col) > upper))


def sort_multi(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def top_n_global(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top n rows; each task keeps n, so no full sort takes place."""
    return df.orderBy(*order).limit(n)


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value; ties go to the smallest value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(1)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def union_rows(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
