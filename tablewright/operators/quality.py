"""Data quality reports, row and column removal, imputation."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.aggs import is_missing, long_values, stack_columns
from tablewright.operators.ordering import exact_quantiles
from tablewright.operators.skew import attach
from tablewright.session import pin, small_table


def schema_validate(df: DataFrame, expected: StructType) -> DataFrame:
    """(column_name, expected_type, actual_type, status) from the two schemas alone."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name in {**want, **have}:
        w, h = want.get(name), have.get(name)
        if h is None:
            status = "missing"
        elif w is None:
            status = "extra"
        else:
            status = "ok" if w == h else "type mismatch"
        rows.append((name, w or "", h or "", status))
    return small_table(
        df.sparkSession, rows, "column_name string, expected_type string, actual_type string, status string"
    )


@dataclass
class QualityRules:
    """Allowed numeric ranges and allowed values per column."""

    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    domains: Mapping[str, Sequence] = field(default_factory=dict)
    missing_pct: float = 50.0


def quality_report(df: DataFrame, rules: QualityRules) -> DataFrame:
    """(column_name, metric, value): the whole report from one aggregate.

    Metrics: rows, columns; per column missing and missing_pct; for ranged columns
    min, max, mean, stddev, out_of_range; for columns with a domain unexpected; and
    issue = 1 where a column breaks a rule.
    """
    n = F.count(F.lit(1)).cast("double")
    aggs: dict[tuple[str, str], Column] = {
        ("*", "rows"): n,
        ("*", "columns"): F.max(F.lit(float(len(df.columns)))),
    }
    issue: dict[str, list[Column]] = {c: [] for c in df.columns}
    for c in df.columns:
        missing = F.count_if(is_missing(df, c)).cast("double")
        pct = F.try_divide(missing * 100, n)
        aggs[(c, "missing")] = missing
        aggs[(c, "missing_pct")] = pct
        issue[c].append(pct > rules.missing_pct)
    for c, (lo, hi) in rules.ranges.items():
        outside = F.count_if(~F.col(c).between(lo, hi)).cast("double")
        aggs[(c, "min")] = F.min(c).cast("double")
        aggs[(c, "max")] = F.max(c).cast("double")
        aggs[(c, "mean")] = F.avg(c)
        aggs[(c, "stddev")] = F.stddev_samp(c)
        aggs[(c, "out_of_range")] = outside
        issue[c].append(outside > 0)
    for c, allowed in rules.domains.items():
        unexpected = F.count_if(~F.col(c).isin(list(allowed))).cast("double")
        aggs[(c, "unexpected")] = unexpected
        issue[c].append(unexpected > 0)
    for c, tests in issue.items():
        aggs[(c, "issue")] = F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)).cast("double")
    keys = list(aggs)
    stats = df.agg(*[aggs[k].alias(f"_{i}") for i, k in enumerate(keys)])
    return stack_columns(
        stats, [list(k) for k in keys], [[f"_{i}"] for i in range(len(keys))], ["column_name", "metric", "value"]
    )


def corrupt_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(n_rows, n_corrupt_rows, n_corrupt_values): rows with any missing value, and their total."""
    per_row = reduce(lambda a, b: a + b, [is_missing(df, c).cast("int") for c in cols])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(per_row > 0).alias("n_corrupt_rows"),
        F.coalesce(F.sum(per_row), F.lit(0)).alias("n_corrupt_values"),
    )


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def drop_sparse_rows(df: DataFrame, cols: Sequence[str], frac: float = 0.5) -> DataFrame:
    """Drop rows in which at least ``frac`` of the columns are missing."""
    need = len(cols) - math.ceil(frac * len(cols)) + 1
    return df.dropna(thresh=need, subset=list(cols))


def drop_null_columns(df: DataFrame, how: str = "any") -> DataFrame:
    """Drop columns with a missing value (``any``) or nothing else (``all``).

    One aggregate finds them; only its single row comes to the driver.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(is_missing(df, c)).alias(c) for c in df.columns]
    ).first()
    limit = 0 if how == "any" else max(row["_n"] - 1, 0)
    return df.select(*[c for c in df.columns if row[c] <= limit])


def mode_scalar(df: DataFrame, col: str) -> Column:
    """Most frequent value as a scalar subquery; ties to the smallest."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), col).limit(1).select(col).scalar()


def impute_mean_mode(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Numbers get the mean, strings the mode, as scalar subqueries of one plan."""
    fills = {c: F.coalesce(F.col(c), df.agg(F.avg(c)).scalar()) for c in numeric}
    fills |= {c: F.coalesce(F.col(c), mode_scalar(df, c)) for c in text}
    return df.withColumns(fills)


def impute_constant(df: DataFrame, values: Mapping) -> DataFrame:
    return df.fillna(dict(values))


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians on the driver, one number per column."""
    rows = exact_quantiles(long_values(df, cols), ["column_name"], "value", {"q": 0.5}).collect()
    return {r["column_name"]: r["q"] for r in rows}


def impute_median(train: DataFrame, rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill with the medians of ``train``."""
    return rows.fillna(medians(train, cols), subset=list(cols))


def impute_group_stat(
    df: DataFrame, col: str, keys: Sequence[str], stat: str = "median", out: str | None = None
) -> DataFrame:
    """Group statistic first, the statistic of the whole table where a group has none. Null keys are a group
    with a median; for means they are none, as for a data frame's groups, and take the whole table's."""
    out = out or col
    known = df.filter(F.col(col).isNotNull())
    if stat == "mean":
        groups = known.dropna(subset=list(keys)).groupBy(*keys).agg(F.avg(col).alias("_g"))
        overall = known.agg(F.avg(col)).scalar()
    else:
        groups = exact_quantiles(known, keys, col, {"_g": 0.5})
        overall = F.lit(medians(df, [col]).get(col))
    joined = attach(df, groups, list(keys), "left")
    return joined.withColumn(out, F.coalesce(F.col(col).cast("double"), "_g", overall)).drop("_g")


def impute_zero_as_missing(train: DataFrame, rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zeros become the median of the non-zero values of ``train``."""
    as_null = train.select(*[F.nullif(F.col(c), F.lit(0)).alias(c) for c in cols])
    mids = medians(as_null, cols)
    return rows.withColumns(
        {c: F.when(F.col(c) == 0, F.lit(mids.get(c))).otherwise(F.col(c).cast("double")) for c in cols}
    )


def impute_knn(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """Missing targets get the mean of the k nearest complete rows (exact search)."""
    from tablewright.operators.neighbours import knn

    vec = F.array(*[F.col(c).cast("double") for c in features])
    rows = df.select(key, target, vec.alias("_vec"))
    lacking = rows.filter(F.col(target).isNull()).select(key, "_vec")
    donors = rows.filter(F.col(target).isNotNull()).select(F.col(key).alias("_donor"), "_vec", target)
    near = knn(lacking, donors.select("_donor", "_vec"), key, "_donor", "_vec", k)
    means = (
        near.select(key, "_donor")
        .join(donors.select("_donor", target), "_donor")
        .groupBy(key)
        .agg(F.avg(target).alias("_fill"))
    )
    return (
        df.join(means, key, "left")
        .withColumn(target, F.coalesce(F.col(target).cast("double"), "_fill"))
        .drop("_fill")
    )


def impute_iterative(df: DataFrame, cols: Sequence[str], rounds: int = 3) -> DataFrame:
    """Chained regressions: start from means, then predict each incomplete column from the others.

    Every regression is one aggregate of moments and a solve of the size of the
    columns; rows are rewritten once per round.
    """
    from tablewright.operators.linear import ols_coefficients

    missing = {c: f"_miss_{c}" for c in cols}
    start = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    work = df.withColumns({m: F.col(c).isNull() for c, m in missing.items()}).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(start[c])) for c in cols}
    )
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    for _ in range(rounds):
        for c in cols:
            if gaps[c] == 0:
                continue
            others = [o for o in cols if o != c]
            beta = ols_coefficients(work.filter(~F.col(missing[c])), others, c)
            guess = reduce(
                lambda a, b: a + b, [F.lit(beta[o]) * F.col(o) for o in others], F.lit(beta["intercept"])
            )
            work = work.withColumn(c, F.when(F.col(missing[c]), guess).otherwise(F.col(c)))
        work = pin(work)
    return work.drop(*missing.values())
