"""Clustering."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import nearest_assign
from tablewright.operators.skew import spread_out
from tablewright.session import pin, small_table


def as_vector(df: DataFrame, vec: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.transform(vec, lambda x: x.cast("double"))))


def kmeans_fit(df: DataFrame, k: int, seed: int = 7):
    return KMeans(k=k, seed=seed, maxIter=20).fit(spread_out(df))


def kmeans_clusters(df: DataFrame, k: int, seed: int = 7) -> DataFrame:
    """(cluster, size, centre)."""
    model = kmeans_fit(df, k, seed)
    sizes = model.transform(df).groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centres = small_table(df.sparkSession, rows, "cluster int, centre array<double>")
    return centres.join(sizes, "cluster", "left").select(
        "cluster", F.coalesce("size", F.lit(0)).alias("size"), "centre"
    )


def kmeans_evaluate(df: DataFrame, ks: Sequence[int], seed: int = 7) -> DataFrame:
    """(k, cost, silhouette) for several k."""
    rows = []
    for k in ks:
        model = kmeans_fit(df, k, seed)
        sil = ClusteringEvaluator().evaluate(model.transform(df)) if k > 1 else float("nan")
        rows.append((k, float(model.summary.trainingCost), float(sil)))
    return small_table(df.sparkSession, rows, "k int, cost double, silhouette double")


def kmeans_two_stage(df: DataFrame, vec: str, k: int, rounds: int = 12, seed: int = 7) -> DataFrame:
    """Rows with cluster, distance to its centre, and inner or outer half.

    The split of each cluster is 1-d two-means over the distances, run for all
    clusters at once: one small aggregate per round moves each cluster's threshold.
    """
    model = kmeans_fit(as_vector(df, vec), k, seed)
    centres = {i: [float(x) for x in c] for i, c in enumerate(model.clusterCenters())}
    rows = nearest_assign(df, vec, centres, "cluster").withColumn("distance", F.sqrt("cluster_dist")).drop("cluster_dist")
    slim = rows.select("cluster", "distance")
    cut = {
        r["cluster"]: (r["lo"] + r["hi"]) / 2
        for r in slim.groupBy("cluster").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi")).collect()
    }

    def threshold():
        pairs = [F.lit(x) for kv in cut.items() for x in kv]
        return F.element_at(F.create_map(*pairs), F.col("cluster"))

    for _ in range(rounds):
        inner = F.col("distance") < threshold()
        means = slim.groupBy("cluster").agg(
            F.avg(F.when(inner, F.col("distance"))).alias("a"), F.avg(F.when(~inner, F.col("distance"))).alias("b")
        )
        moved = {
            r["cluster"]: (r["a"] + r["b"]) / 2 if r["a"] is not None and r["b"] is not None else cut[r["cluster"]]
            for r in means.collect()  # one row per cluster
        }
        done = all(abs(moved[c] - cut[c]) < 1e-12 for c in cut)
        cut = moved
        if done:
            break
    return rows.withColumn("half", F.when(F.col("distance") < threshold(), "inner").otherwise("outer"))


def gmm_clusters(df: DataFrame, k: int, seed: int = 7):
    """((component, weight, mean, size) table, rows with assignment)."""
    model = GaussianMixture(k=k, seed=seed, maxIter=30).fit(spread_out(df))
    pred = model.transform(df)
    sizes = pred.groupBy(F.col("prediction").alias("component")).agg(F.count(F.lit(1)).alias("size"))
    rows = [
        (i, float(w), [float(x) for x in g.mean], float(np.linalg.det(g.cov.toArray())))
        for i, (w, g) in enumerate(zip(model.weights, _gaussians(model)))
    ]
    table = small_table(df.sparkSession, rows, "component int, weight double, mean array<double>, cov_det double")
    return table.join(sizes, "component", "left").na.fill(0, ["size"]), pred


class _Gaussian:
    def __init__(self, mean, cov):
        self.mean, self.cov = mean, cov


def _gaussians(model):
    return [_Gaussian(r["mean"], r["cov"]) for r in model.gaussiansDF.collect()]


def facility_location(
    df: DataFrame, x: str, y: str, w: str, start: Sequence[tuple[float, float]], max_iter: int = 9
):
    """(facility, cx, cy, demand, cost) after alternating nearest assignment and weighted centroids.

    Each round is one aggregate; the places of the facilities are all the driver
    holds. Stops when the places do not move. Ties go to the first facility.
    """
    places = [tuple(map(float, p)) for p in start]
    df = pin(df.select(x, y, w))  # read once a round

    def assigned(ps):
        options = F.array(
            *[
                F.struct(
                    F.sqrt((F.col(x) - F.lit(a)) * (F.col(x) - F.lit(a)) + (F.col(y) - F.lit(b)) * (F.col(y) - F.lit(b))).alias("d"),
                    F.lit(i).alias("i"),
                )
                for i, (a, b) in enumerate(ps)
            ]
        )
        return df.withColumn("_best", F.array_min(options))

    for _ in range(max_iter):
        means = {
            r["i"]: (r["cx"], r["cy"])
            for r in assigned(places)
            .groupBy(F.col("_best.i").alias("i"))
            .agg((F.sum(F.col(x) * F.col(w)) / F.sum(w)).alias("cx"), (F.sum(F.col(y) * F.col(w)) / F.sum(w)).alias("cy"))
            .collect()
        }
        moved = [means.get(i, p) for i, p in enumerate(places)]
        if all(math.dist(a, b) < 1e-12 for a, b in zip(moved, places)):
            break
        places = moved
    final = assigned(places).groupBy(F.col("_best.i").alias("facility")).agg(
        F.sum(w).alias("demand"), F.sum(F.col(w) * F.col("_best.d")).alias("cost"), F.count(F.lit(1)).alias("n")
    )
    rows = [(i, a, b) for i, (a, b) in enumerate(places)]
    spots = small_table(df.sparkSession, rows, "facility int, cx double, cy double")
    return spots.join(final, "facility", "left")


def cluster_then_classify(df: DataFrame, k: int, seed: int = 7):
    """Accuracy of a forest that learns the cluster labels, on rows it did not see (column ``part``)."""
    from pyspark.ml.classification import RandomForestClassifier

    from tablewright.operators.classify import multiclass_accuracy

    labelled = kmeans_fit(df, k, seed).transform(df).withColumn("label", F.col("prediction").cast("double")).drop("prediction")
    model = RandomForestClassifier(numTrees=15, maxDepth=6, seed=seed).fit(labelled.filter("part = 'train'"))
    return multiclass_accuracy(model.transform(labelled.filter("part = 'test'")))
