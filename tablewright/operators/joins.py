"""Joins. The strategy is left to the optimizer and adaptive execution; a side is
broadcast by hint only after its row count was checked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most ``rows`` rows and ``size`` bytes; reads no more than it needs to know."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.UserDefinedType)]
    width = reduce(
        lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in plain], F.lit(16)
    )
    seen = df.select(width.alias("_w")).limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("_w").alias("w")).first()
    return seen["n"] <= rows and (seen["w"] or 0) <= size


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which NULL keys meet NULL keys, as they do in a grouping."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    extra = [F.col(f"r.`{c}`") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), cond, how).select("l.*", *extra)


def join_inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "inner")


def join_left(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left")


def join_right(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "right")


def join_outer(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "full_outer")


def join_suffix(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str], how: str = "inner"
) -> DataFrame:
    """Join; names on both sides that are not keys get a suffix each."""
    both = (set(left.columns) & set(right.columns)) - set(on)
    l = left.withColumnsRenamed({c: c + suffixes[0] for c in both})
    r = right.withColumnsRenamed({c: c + suffixes[1] for c in both})
    return l.join(r, list(on), how)


def mapping_join(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a small mapping; broadcast only if its row count allows."""
    side = F.broadcast(dim) if small_enough(dim) else dim
    return df.join(side, list(on), "left")


def nearest_assign(
    df: DataFrame, vec: str, centres: Mapping[object, Sequence[float]], out: str = "nearest"
) -> DataFrame:
    """Label and squared distance of the nearest of k centres (k is model-sized).

    The centres travel inside the function; every batch of rows is one matrix
    product. Ties go to the label that sorts first. For many reference rows use
    ``neighbours.knn`` with k = 1.
    """
    labels = sorted(centres)
    grid = np.array([centres[k] for k in labels], dtype=float)

    @F.pandas_udf("pos int, dist double")
    def assign(v: pd.Series) -> pd.DataFrame:
        if len(v) == 0:
            return pd.DataFrame({"pos": pd.Series(dtype="int32"), "dist": pd.Series(dtype=float)})
        x = np.vstack(v.to_numpy()).astype(float)
        d = np.stack([((x - g) ** 2).sum(axis=1) for g in grid], axis=1)
        pos = d.argmin(axis=1)
        return pd.DataFrame({"pos": pos.astype("int32"), "dist": d[np.arange(len(x)), pos]})

    names = F.array(*[F.lit(k) for k in labels])
    return (
        df.withColumn("_near", assign(vec))
        .withColumn(out, F.element_at(names, F.col("_near.pos") + 1))
        .withColumn(f"{out}_dist", F.col("_near.dist"))
        .drop("_near")
    )
