"""Aggregates over array columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_vectors(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, mean): elementwise mean per key by a map-side combined vector aggregate."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    dense = array_to_vector(F.transform(vec, lambda x: x.cast("double")))
    return (
        df.select(key, dense.alias("_v"))
        .groupBy(key)
        .agg(Summarizer.mean(F.col("_v")).alias("_m"))
        .select(key, vector_to_array("_m").alias("mean"))
    )


def class_means(df: DataFrame, key: str, vec: str) -> dict:
    """The mean vectors on the driver, one row per class; ``mean_vectors`` keeps them as a table."""
    rows = mean_vectors(df, key, vec).collect()
    return {r[key]: list(r["mean"]) for r in rows}
