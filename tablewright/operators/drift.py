"""Drift between a reference table and an incoming one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.aggs import long_values, stack_columns
from tablewright.operators.ordering import exact_quantiles, running_totals

EPS = 1e-6


def reference_edges(ref: DataFrame, cols: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct quantile edges per feature; equal-width edges where fewer than three remain.

    bins + 1 numbers per feature come to the driver. A feature without values has no edges.
    """
    probs = {f"q{i}": i / bins for i in range(bins + 1)}
    rows = exact_quantiles(long_values(ref, cols), ["column_name"], "value", probs).collect()
    out: dict[str, list[float]] = {c: [] for c in cols}
    for r in rows:
        edges = sorted({r[p] for p in probs})
        if len(edges) < 3:
            lo, hi = edges[0], edges[-1] + 1e-9
            edges = [lo + (hi - lo) * i / bins for i in range(bins + 1)]
        out[r["column_name"]] = edges
    return out


def _bin_tests(col: str, edges: Sequence[float], overflow: bool) -> list[Column]:
    x = F.col(col).cast("double")
    if not edges:
        return [F.lit(False)]
    tests = [(x >= lo) & (x < hi) for lo, hi in zip(edges[:-2], edges[1:-1])]
    tests.append((x >= edges[-2]) & (x <= edges[-1]))
    if overflow:
        tests += [x < edges[0], x > edges[-1]]
    return tests


def bin_counts(df: DataFrame, edges: dict[str, list[float]], overflow: bool = False) -> DataFrame:
    """(feature, bin, n): all features and bins in one pass, no row is shuffled."""
    aggs, labels = [], []
    for c, e in edges.items():
        for i, test in enumerate(_bin_tests(c, e, overflow)):
            aggs.append(F.count_if(test).alias(f"_{len(aggs)}"))
            labels.append([c, i])
    return stack_columns(
        df.agg(*aggs), labels, [[f"_{i}"] for i in range(len(aggs))], ["feature", "bin", "n"]
    )


def psi_from_counts(ref: DataFrame, new: DataFrame, threshold: float = 0.2) -> DataFrame:
    """(feature, psi, drift, overall_drift) from two bin-count tables (features x bins rows).

    A feature without reference values has a NULL psi and no drift flag.
    """
    totals = lambda d: d.groupBy("feature").agg(F.sum("n").alias("_t"))
    e = ref.join(totals(ref), "feature").select("feature", "bin", (F.col("n") / (F.col("_t") + EPS)).alias("e"))
    a = new.join(totals(new), "feature").select("feature", "bin", (F.col("n") / (F.col("_t") + EPS)).alias("a"))
    term = (F.col("a") - F.col("e")) * F.log((F.col("a") + EPS) / (F.col("e") + EPS))
    both = e.join(a, ["feature", "bin"]).join(totals(ref).withColumnRenamed("_t", "_seen"), "feature")
    psi = both.groupBy("feature").agg(F.sum(F.when(F.col("_seen") > 0, term)).alias("psi"))
    flagged = psi.withColumn("drift", (F.col("psi") > threshold).cast("int"))
    overall = flagged.agg(F.max("drift")).scalar()
    return flagged.withColumn("overall_drift", overall)


def psi_drift(
    ref: DataFrame, new: DataFrame, cols: Sequence[str], bins: int = 10, threshold: float = 0.2, overflow: bool = False
) -> DataFrame:
    """Population stability index per feature over the reference's quantile bins.

    Incoming values beyond the reference's range fall out of the bins, or into two
    extra bins with ``overflow``.
    """
    edges = reference_edges(ref, cols, bins)
    return psi_from_counts(bin_counts(ref, edges, overflow), bin_counts(new, edges, overflow), threshold)


def ks_drift(ref: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, ks): largest distance of the two distribution functions.

    Values are counted per side before the shuffle; the cumulative counts run over
    range partitions.
    """
    sides = (
        long_values(ref, cols)
        .withColumn("_new", F.lit(0))
        .unionByName(long_values(new, cols).withColumn("_new", F.lit(1)))
        .filter(F.col("value").isNotNull())
    )
    counts = sides.groupBy(F.col("column_name").alias("feature"), "value").agg(
        F.count_if(F.col("_new") == 0).alias("_r"), F.count_if(F.col("_new") == 1).alias("_i")
    )
    run = running_totals(counts, ["feature"], ["value"], {"cr": "_r", "ci": "_i"})
    gap = F.abs(F.try_divide("cr", "cr_total") - F.try_divide("ci", "ci_total"))
    return run.groupBy("feature").agg(F.max(gap).alias("ks"))
