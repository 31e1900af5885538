"""Grouped and whole-table aggregates, with map-side combine throughout."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordering import exact_quantiles
from tablewright.operators.skew import CHUNK, bounded_parts, in_pages

DEALS = 16  # parts of a key whose products are cut to k each before its one window
ITEMS_PER_ORDER = 4  # orders are dealt to so many times the partitions their rows need, as their items are exploded


def stack_columns(stats: DataFrame, labels: Sequence[Sequence], fields: Sequence[Sequence[str]],
                  names: Sequence[str]) -> DataFrame:
    """Turn a one-row wide aggregate into rows: ``labels[i]`` as literals, then ``fields[i]``."""
    rows = [
        F.struct(
            *[F.lit(v).alias(names[j]) for j, v in enumerate(lab)],
            *[F.col(f).alias(names[len(lab) + j]) for j, f in enumerate(fld)],
        )
        for lab, fld in zip(labels, fields)
    ]
    return stats.select(F.inline(F.array(*rows)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column_name, value): numeric columns unpivoted as doubles."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(keep), list(cols), "column_name", "value"
    )


def group_sum(df: DataFrame, keys, value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def group_count(df: DataFrame, keys, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_mean(df: DataFrame, keys, value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def _bought_items(df: DataFrame, key: str, items: str, schema: str, product: str, qty: str) -> DataFrame:
    """(key, product, qty): an item of a JSON array column in a row."""
    item = F.explode(F.from_json(items, schema))
    return df.select(key, item.alias("_i")).select(key, F.col(f"_i.{product}").alias(product), F.col(f"_i.{qty}").alias(qty))


def nested_quantity(df: DataFrame, key: str, items: str, schema: str, product: str, qty: str) -> DataFrame:
    """Quantity per (key, product) out of a JSON array column."""
    return _bought_items(df, key, items, schema, product, qty).groupBy(key, product).agg(F.sum(qty).alias("quantity"))


def collect_items(
    df: DataFrame, key: str, item_id: str, fields: Sequence[str], out: str = "items", chunk: int = CHUNK
) -> DataFrame:
    """(key, part, items): the rows of a key as sorted arrays of structs, ``chunk`` rows a part.

    Part p holds the rows p * chunk and on in the order of the fields, so no array grows
    with the data and the parts of a key, one after another, are its sorted rows.
    """
    dealt = in_pages(df, [key], list(dict.fromkeys([*fields, item_id])), chunk, "part")
    return dealt.groupBy(key, "part").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def flatten_lists(
    df: DataFrame, keys: Sequence[str], lists: str, item_id: str, out: str, chunk: int = CHUNK
) -> DataFrame:
    """(keys, part, out): the elements of a group's arrays, sorted, ``chunk`` elements a part.

    ``item_id`` tells apart rows of a group; parts are counted in elements, however long
    the arrays are.
    """
    spread = df.select(*keys, item_id, F.posexplode(lists).alias("_at", "_x"))
    dealt = in_pages(spread, keys, ["_x", item_id, "_at"], chunk, "part")
    return dealt.groupBy(*keys, "part").agg(F.array_sort(F.collect_list("_x")).alias(out))


def top_products(quantities: DataFrame, key: str, product: str, k: int) -> DataFrame:
    """(key, top): the k products of the largest quantity, ties by product id."""
    w = Window.partitionBy(key).orderBy(F.desc("quantity"), product)
    return (
        quantities.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= k)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("_rn", product))).alias("_s"))
        .select(key, F.transform("_s", lambda s: s[product]).alias("top"))
    )


def customer_summary(orders: DataFrame, items: DataFrame, schema: str, k: int = 3) -> DataFrame:
    """Orders, spending and top-k products per customer.

    ``orders`` has o_orderkey, o_custkey, o_totalprice; ``items`` has l_orderkey
    and a JSON array of items. More orders than the session's partitions should hold are dealt
    to as many as hold them, so a task's share does not grow with the table.
    """
    parts = bounded_parts(orders, ITEMS_PER_ORDER)
    totals = (orders.select("o_custkey", "o_totalprice").repartition(parts, "o_custkey") if parts else orders).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("o_totalprice").alias("total_spent")
    )
    placed = orders.select("o_orderkey", "o_custkey")
    if parts:
        placed = placed.repartition(-(-parts // ITEMS_PER_ORDER), "o_orderkey")
    bought = placed.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    if not parts:
        quantities = nested_quantity(bought, "o_custkey", "items", schema, "l_partkey", "l_quantity")
    else:
        dealt = _bought_items(bought, "o_custkey", "items", schema, "l_partkey", "l_quantity").withColumn(
            "_deal", F.pmod(F.xxhash64("l_partkey"), F.lit(DEALS))
        )
        sums = dealt.repartition(parts, "o_custkey", "_deal").groupBy("o_custkey", "_deal", "l_partkey").agg(F.sum("l_quantity").alias("quantity"))
        # The best of a customer are among the best of each deal.
        w = Window.partitionBy("o_custkey", "_deal").orderBy(F.desc("quantity"), "l_partkey")
        best = sums.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
        quantities = best.select("o_custkey", "l_partkey", "quantity").repartition(parts, "o_custkey")
    return totals.join(top_products(quantities, "o_custkey", "l_partkey", k), "o_custkey", "left")


def count_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_distinct), exact.

    Each column is reduced to its distinct values map-side; no expanded rows with
    all columns are shuffled, and no value set sits in one task.
    """
    values = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column_name", "value"
    )
    return (
        values.filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def approx_distinct(df: DataFrame, cols: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """The same by sketch: one pass, a few kilobytes per column."""
    stats = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
    return stack_columns(stats, [[c] for c in cols], [[c] for c in cols], ["column_name", "n_distinct"])


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value): the distinct values, one row each."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        .unpivot([], list(cols), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per column, one row per column."""
    long = long_values(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, ["column_name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(quartiles, "column_name", "left")


def is_missing(df: DataFrame, col: str) -> Column:
    """NULL, or NaN where the column can hold it."""
    kind = df.schema[col].dataType
    c = F.col(col)
    return c.isNull() | F.isnan(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c.isNull()


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    stats = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in cols])
    return stack_columns(stats, [[c] for c in cols], [[c] for c in cols], ["column_name", "n_null"])


def null_profile(df: DataFrame, cols: Sequence[str], flag_over: float = 50.0) -> DataFrame:
    """(column_name, n_null, pct_null, mostly_null) in one pass."""
    stats = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(is_missing(df, c)).alias(c) for c in cols]
    )
    rows = stack_columns(
        stats, [[c] for c in cols], [[c, "_n"] for c in cols], ["column_name", "n_null", "_n"]
    )
    pct = F.try_divide(F.col("n_null") * 100.0, F.col("_n"))
    return rows.select("column_name", "n_null", pct.alias("pct_null")).withColumn(
        "mostly_null", (F.col("pct_null") > flag_over).cast("int")
    )


def zero_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_zero, pct_zero): zeros that may stand for missing."""
    stats = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c) == 0).alias(c) for c in cols])
    rows = stack_columns(
        stats, [[c] for c in cols], [[c, "_n"] for c in cols], ["column_name", "n_zero", "_n"]
    )
    return rows.select(
        "column_name", "n_zero", F.try_divide(F.col("n_zero") * 100.0, F.col("_n")).alias("pct_zero")
    )


def _pair_matrix(df: DataFrame, cols: Sequence[str], fn, out: str) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    stats = df.agg(*[fn(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    place = {p: f"_{i}" for i, p in enumerate(pairs)}
    full = [(a, b) for a in cols for b in cols]
    return stack_columns(
        stats,
        [[a, b] for a, b in full],
        [[place.get((a, b)) or place[(b, a)]] for a, b in full],
        ["col_a", "col_b", out],
    )


def covariance_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample covariance, long form: all pairs of columns in one aggregate."""
    return _pair_matrix(df, cols, F.covar_samp, "covariance")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _pair_matrix(df, cols, F.corr, "correlation")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are kept."""
    x = F.col(col).cast("double")
    lo = df.agg(F.min(x)).scalar()
    hi = df.agg(F.max(x)).scalar()
    width = F.nullif(hi - lo, F.lit(0.0))
    place = F.least(F.coalesce(F.floor((x - lo) / width * bins), F.lit(0)), F.lit(bins - 1))
    counted = (
        df.filter(x.isNotNull())
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (lo + (hi - lo) * F.col("bin") / bins).alias("bin_from"),
        (lo + (hi - lo) * (F.col("bin") + 1) / bins).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def kernel_density(df: DataFrame, col: str, grid: Sequence[float], bandwidth: float) -> DataFrame:
    """Gaussian kernel density at each grid point.

    One aggregate per grid point in a single pass; rows are never multiplied by
    the grid.
    """
    x = F.col(col).cast("double")
    norm = 1.0 / (bandwidth * math.sqrt(2 * math.pi))
    kernels = [
        (F.avg(F.exp(-F.pow((x - F.lit(float(g))) / bandwidth, 2) / 2)) * norm).alias(f"_{i}")
        for i, g in enumerate(grid)
    ]
    stats = df.agg(*kernels)
    return stack_columns(
        stats, [[float(g)] for g in grid], [[f"_{i}"] for i in range(len(grid))], ["point", "density"]
    )


def frobenius_norm(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    total = sum((F.pow(F.col(c).cast("double"), 2) for c in cols), F.lit(0.0))
    return df.agg(F.sqrt(F.sum(total)).alias("norm"))


def share_by_class(df: DataFrame, col: str) -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share_pct", F.col("n") * 100.0 / total)


def pivot_mean(df: DataFrame, index: str, column: str, value: str, levels: Sequence) -> DataFrame:
    """index x column table of means; the levels are given, so no extra pass finds them."""
    return df.groupBy(index).pivot(column, list(levels)).agg(F.avg(value))


def rate_by_group(df: DataFrame, key: str, outcome: Column) -> DataFrame:
    return df.groupBy(key).agg(
        F.avg(outcome.cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")
    )


def weighted_centroid(df: DataFrame, keys, x: str, y: str, w: str) -> DataFrame:
    total = F.sum(w)
    return df.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(x) * F.col(w)), total).alias("cx"),
        F.try_divide(F.sum(F.col(y) * F.col(w)), total).alias("cy"),
        total.alias("weight"),
    )


def column_variance_rank(df: DataFrame, cols: Sequence[str], drop_top: float = 0.1) -> DataFrame:
    """(column_name, variance, position, kept): columns by falling variance, the top share dropped."""
    stats = df.agg(*[F.var_samp(c).alias(c) for c in cols])
    rows = stack_columns(stats, [[c] for c in cols], [[c] for c in cols], ["column_name", "variance"])
    dropped = math.floor(len(cols) * drop_top)
    w = Window.orderBy(F.desc("variance"), "column_name")  # one row per column
    return rows.withColumn("position", F.row_number().over(w)).withColumn(
        "kept", (F.col("position") > dropped).cast("int")
    )
