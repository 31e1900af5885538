"""Splits, folds, class balance, bootstrap. All draws are hashes of the row key, so a
recomputed task draws the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordering import dense_index
from tablewright.operators.skew import attach
from tablewright.session import pin_small


POISSON_MEAN = 8.0
PERIOD = 1048576  # of the uniforms that SQL makes too


def hash_percent(key: Column) -> Column:
    """0..99 by multiplicative hashing of an integer key."""
    return F.floor(((key % 2147483648) * F.lit(2654435761) % 4294967296) * 100 / 4294967296)


def split_random(df: DataFrame, key: str, train_pct: int = 80, out: str = "part") -> DataFrame:
    return df.withColumn(out, F.when(hash_percent(F.col(key)) < train_pct, "train").otherwise("test"))


def split_stratified(df: DataFrame, key: str, label: str, frac: float = 0.8, out: str = "part") -> DataFrame:
    """The same exact share of every class in train; rows of a class in hash order."""
    hashed = df.withColumn("_h", (F.col(key) % 2147483648) * F.lit(2654435761) % 4294967296)
    ranked = dense_index(hashed, [label], ["_h", key], "_i")
    sizes = df.groupBy(label).agg(F.floor(F.count(F.lit(1)) * F.lit(frac)).alias("_cut"))
    return (
        attach(ranked, sizes, [label])
        .withColumn(out, F.when(F.col("_i") < F.col("_cut"), "train").otherwise("test"))
        .drop("_h", "_i", "_cut")
    )


def kfold_assign(df: DataFrame, key: str, k: int, label: str | None = None, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row; with ``label`` the folds hold equal numbers of each class."""
    hashed = (F.col(key) % 2147483648) * F.lit(2654435761) % 4294967296
    if label is None:
        return df.withColumn(out, F.floor(hashed * k / 4294967296).cast("int"))
    ranked = dense_index(df.withColumn("_h", hashed), [label], ["_h", key], "_i")
    return ranked.withColumn(out, (F.col("_i") % k).cast("int")).drop("_h", "_i")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (number of classes * class size) beside each row."""
    sizes = pin_small(df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")))  # one row per class
    total = sizes.agg(F.sum("_n")).scalar()
    classes = sizes.agg(F.count(F.lit(1))).scalar()
    return attach(df, sizes.withColumn(out, total / (classes * F.col("_n"))).drop("_n"), [label])


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """(majority, minority, ratio)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n").alias("majority"), F.min("n").alias("minority")).withColumn(
        "ratio", F.col("majority") / F.col("minority")
    )


def bootstrap_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Sample with replacement: each row is drawn a Poisson(fraction) number of times.

    ``copy`` numbers the draws of a row. A large mean is a sum of draws of means of
    ``POISSON_MEAN`` at most, each from the inverse distribution at a hashed uniform. Integer
    keys under ``PERIOD`` have a uniform that SQL can make too, all others the hash of the whole
    key. Rows without a key are numbered in the order of their contents and drawn each.
    """
    parts = max(1, math.ceil(fraction / POISSON_MEAN))
    steps = poisson_steps(fraction / parts)
    integral = isinstance(df.schema[key].dataType, T.IntegralType)

    def hashed(part: Column, *of: Column) -> Column:
        return (F.shiftrightunsigned(F.xxhash64(*of, part, F.lit(seed).cast("long")), 11) + 0.5) / F.lit(2.0**53)

    def by_key(part: Column) -> Column:
        if not integral:
            return hashed(part, F.col(key))
        whole = F.col(key).cast("long")
        mixed = (whole % PERIOD + part * 15485863 + F.lit(seed * 7919)) % 2147483648 * F.lit(2654435761) % 4294967296
        again = ((mixed % 1048576) * F.lit(40503) + F.floor(mixed / 1048576)) % 1000003
        return F.when(whole.between(0, PERIOD - 1), (again + 0.5) / F.lit(1000003.0)).otherwise(hashed(part, whole))

    def drawn(rows: DataFrame, uniform: Callable[[Column], Column]) -> DataFrame:
        def one(part: Column) -> Column:
            u = uniform(part)
            return F.size(F.filter(F.array(*[F.lit(c) for c in steps]), lambda c: c < u))

        draws = F.aggregate(F.sequence(F.lit(0), F.lit(parts - 1)), F.lit(0), lambda n, part: n + one(part.cast("long")))
        return (
            rows.withColumn("_n", draws)
            .filter(F.col("_n") > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
            .select(*df.columns, "copy")
        )

    named = drawn(df.filter(F.col(key).isNotNull()), by_key)
    contents = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    nameless = df.filter(F.col(key).isNull()).withColumn("_h", F.xxhash64(*contents))
    if not df.schema[key].nullable or nameless.isEmpty():
        return named
    numbered = dense_index(nameless, [], ["_h"], "_i")
    return named.unionByName(drawn(numbered, lambda part: hashed(part, F.lit("no key"), F.col("_i"))))


def poisson_steps(mean: float) -> list[float]:
    """The distribution function at 0, 1, 2, ... until its tail is below 1e-9."""
    term = cdf = math.exp(-mean)
    steps = [cdf]
    while 1 - cdf > 1e-9:
        term *= mean / len(steps)
        cdf += term
        steps.append(cdf)
    return steps
