"""Long tables for trees that cut features into ranges anyway: rows between the same cuts become one counted row."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANY = 1_000_000  # shorter tables are fitted row by row
COUNT = "rows"  # column with the rows of a cell


def cut_points(values: np.ndarray, bins: int) -> list[float]:
    """Thresholds that part values into at most ``bins`` ranges, as Spark's trees place them: in the middle between
    neighbouring values, between all of them if they are few, else where the ranges hold about as many rows."""
    distinct, held = np.unique(values, return_counts=True)
    middle = distinct[:-1] + (distinct[1:] - distinct[:-1]) / 2
    if len(middle) < bins:
        return np.unique(middle).tolist()
    stride = len(values) / bins
    reached = np.cumsum(held)
    cuts, goal = [], stride
    for i in range(1, len(distinct)):
        if abs(reached[i - 1] - goal) < abs(reached[i] - goal):
            cuts.append(float(middle[i - 1]))
            goal += stride
    return cuts


def sampled(df: DataFrame, xs: Sequence[str], bins: int, seed: int) -> np.ndarray:
    """The rows that thresholds are placed by, one column a feature: some max(10,000, bins * bins), as in Spark's trees."""
    n, wanted = df.count(), max(10_000, bins * bins)
    rows = df.select(*[F.col(x).cast("double") for x in xs])
    return (rows.sample(False, wanted / n, seed) if n > wanted else rows).toPandas().to_numpy(float)


def counted_cells(df: DataFrame, xs: Sequence[str], cuts: Sequence[Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """``keep``, a feature vector and ``rows``: a row for all rows with equal ``keep`` that lie between the same cuts.

    A feature becomes the number of its cuts below the value, so a tree of at most ``len(cuts) + 1`` ranges
    a feature finds the splits it would find in the rows. There are no more cells than products of ranges, or than rows.
    """
    cut = [i for i, c in enumerate(cuts) if len(c)]
    # A value equal to a cut lies below it, as in a tree.
    edges = [[-math.inf, *[math.nextafter(c, math.inf) for c in cuts[i]], math.inf] for i in cut]
    places = Bucketizer(splitsArray=edges, inputCols=[f"_x{i}" for i in cut], outputCols=[f"_c{i}" for i in cut])
    rows = df.select(*keep, *[F.col(x).cast("double").alias(f"_x{i}") for i, x in enumerate(xs)])
    for i in sorted(set(range(len(xs))) - set(cut)):
        rows = rows.withColumn(f"_c{i}", F.col(f"_x{i}") * 0)  # a constant; a null stays one
    names = [f"_c{i}" for i in range(len(xs))]
    counts = (places.transform(rows) if cut else rows).groupBy(*keep, *names).agg(F.count(F.lit(1)).alias(COUNT))
    ordered = counts.select(*keep, COUNT, *[F.col(c).alias(c, metadata={}) for c in names])  # marked as categories so far
    return VectorAssembler(inputCols=names, outputCol="features").transform(ordered).select(*keep, "features", COUNT)


def all_seen(cells: DataFrame, bins: int = 32) -> int:
    """``maxBins`` at which Spark's trees look at every cell before they place thresholds; the ranges remain as they are."""
    return max(bins, math.isqrt(cells.count()) + 2)
