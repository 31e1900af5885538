"""Ordered computations that no single task has to hold a whole key for.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. The
helpers here cut a key into range partitions or into blocks of steps, work
inside each cut, and carry small per-cut totals across.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.joins import null_safe_join
from tablewright.session import pin, pin_small

BLOCK = 65_536
SMALL = 10_000  # rows of a key that one task may sort
WAYS = 1024


def _place(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    by = [F.col(c) for c in (*keys, *order)]
    return pin(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )


def _carry(placed: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Per (key, range partition): totals of the earlier partitions of the key, and of the key."""
    parts = placed.groupBy(*keys, "_pid").agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    return parts.select(
        *keys,
        "_pid",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in totals],
        *[F.sum(n).over(whole).alias(f"_all_{n}") for n in totals],
    )


def _rejoin(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    return null_safe_join(rows, carry, ["_pid", *keys])


def dense_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "t", start: int = 0
) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ... in the given (unique) order.

    The rows are range-partitioned on key and order, so a key with a third of
    all rows is spread over a third of the tasks.
    """
    placed = _place(df, keys, order)
    first = placed.groupBy(*keys, "_pid").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = first.select(
        *keys,
        "_pid",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return (
        _rejoin(placed, shift, keys)
        .withColumn(out, (F.col("_pos") + F.col("_shift") + start).cast("long"))
        .drop("_pid", "_pos", "_shift")
    )


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, str]
) -> DataFrame:
    """Running sums ``{output: input column}`` per key; ``<output>_total`` holds the key's sum."""
    placed = _place(df, keys, order)
    carry = _carry(placed, keys, {out: F.sum(src) for out, src in sums.items()})
    local = (
        Window.partitionBy("_pid", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = placed.select("*", *[F.sum(src).over(local).alias(f"_run_{o}") for o, src in sums.items()])
    out = _rejoin(rows, carry, keys)
    return out.select(
        *df.columns,
        *[(F.col(f"_run_{o}") + F.col(f"_before_{o}")).alias(o) for o in sums],
        *[F.col(f"_all_{o}").alias(f"{o}_total") for o in sums],
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], limit: int = SMALL
) -> DataFrame:
    """Exact linearly interpolated quantiles per key, ``{output: probability}``.

    ``percentile`` keeps every distinct value of a group in one task, so it serves keys of up to ``limit``
    rows. In longer ones the values at the two ranks of each quantile are found by brackets
    (``_ranked``), in passes that aggregate before the shuffle. Null values do not count, null keys
    are a key; NaN is greater than all else, and long keys with infinite values go through sorted counts.
    """
    from tablewright.operators.skew import attach

    v = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull()).select(*keys, v.alias("_v"))
    odd = F.isnan("_v") | (F.abs("_v") == float("inf"))
    sizes = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.max(odd).alias("_odd")
    )
    long = pin_small(sizes.filter(F.col("_n") > limit))
    short = rows if long.isEmpty() else attach(rows, long.select(*keys, "_n"), keys, "left").filter("_n is null")
    found = short.groupBy(*keys).agg(F.percentile("_v", [float(p) for p in probs.values()]).alias("_q"))
    found = found.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)])
    if long.isEmpty():
        return found
    if not keys:  # the one key is long
        found = found.limit(0)
    plain = long.filter(~F.col("_odd"))
    if not plain.isEmpty():
        found = found.unionByName(_bracketed(rows, plain, keys, probs, limit))
    if not long.filter("_odd").isEmpty():
        whole = attach(rows, long.filter("_odd").select(*keys), keys)
        found = found.unionByName(_sorted_quantiles(whole, keys, "_v", probs))
    return found


def _bracketed(rows: DataFrame, long: DataFrame, keys: Sequence[str], probs: Mapping[str, float], limit: int) -> DataFrame:
    """The quantiles of the keys in ``long`` (``_n, _lo, _hi``), all values finite."""
    at = {n: F.lit(float(p)) * (F.col("_n") - 1) for n, p in probs.items()}
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in at.values() for f in (F.floor, F.ceil)]))
    start = long.select(*keys, F.explode(ranks).alias("_rank"), "_lo", "_hi", F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_inside"))
    values = _ranked(rows, pin_small(start), keys, limit)
    table = values.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_map"))
    joined = null_safe_join(long, table, keys)
    out = []
    for n, p in at.items():
        low, high = (F.element_at("_map", f(p).cast("long")) for f in (F.floor, F.ceil))
        out.append((low + (high - low) * (p - F.floor(p))).alias(n))
    return joined.select(*keys, *out)


def _ranked(rows: DataFrame, state: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """``keys, _rank, _value``: the value at each rank, from 0.

    ``state`` holds for each key and rank a bracket of values, how many lie below and how many inside.
    A pass counts the rows of each bracket in ``WAYS`` parts of equal width, whose order is that of
    the values, and goes on with the part that holds the rank and with the least and greatest value in it; it
    ends with one value, or with few enough rows to be sorted as an array.
    """
    from tablewright.operators.skew import attach

    names = [*keys, "_rank"]
    done = None
    while True:
        wide = (F.col("_inside") > limit) & (F.col("_lo") < F.col("_hi"))
        ready = state.filter(~wide)
        done = ready if done is None else done.unionByName(ready)
        state = state.filter(wide)
        if state.isEmpty():
            break
        met = attach(rows, state, keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        # Halves first, so that no difference of finite values overflows.
        width = F.col("_hi") / 2 - F.col("_lo") / 2
        share = F.try_divide(F.col("_v") / 2 - F.col("_lo") / 2, width)
        top = F.lit(WAYS - 1).cast("long")
        # The greatest value parts from the least even where halves of the smallest numbers are equal.
        part = F.when(F.col("_v") == F.col("_hi"), top).when(width > 0, F.least(F.floor(share * WAYS), top)).otherwise(F.lit(0).cast("long"))
        counts = met.groupBy(*names, "_below", part.alias("_part")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
        )
        run = F.sum("_c").over(Window.partitionBy(*names).orderBy("_part"))  # WAYS rows at most
        counts = counts.withColumn("_upto", F.col("_below") + run)
        inside = (F.col("_upto") - F.col("_c") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto"))
        state = pin_small(
            counts.filter(inside).select(
                *names, F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), (F.col("_upto") - F.col("_c")).alias("_below"), F.col("_c").alias("_inside")
            )
        )
    single = done.filter("_lo = _hi").select(*names, F.col("_lo").alias("_value"))
    several = pin_small(done.filter("_lo < _hi"))
    met = attach(rows, several, keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    lists = met.groupBy(*names, "_below").agg(F.array_sort(F.collect_list("_v")).alias("_all"))
    value = F.get("_all", (F.col("_rank") - F.col("_below")).cast("int"))
    return single.unionByName(lists.select(*names, value.alias("_value")))


def _sorted_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """The same from counts of equal values, accumulated over range partitions."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    run = running_totals(counts, keys, ["_v"], {"_cum": "_c"})
    picks = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_cum_total") - 1)
        for tag, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            inside = (F.col("_cum") - F.col("_c") <= at) & (at < F.col("_cum"))
            picks.append(F.max(F.when(inside, F.col("_v"))).alias(f"_{tag}_{name}"))
        picks.append(F.max(pos - F.floor(pos)).alias(f"_frac_{name}"))
    return run.groupBy(*keys).agg(*picks).select(
        *keys,
        *[
            F.when(F.col(f"_lo_{n}") == F.col(f"_hi_{n}"), F.col(f"_lo_{n}"))
            .otherwise(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_frac_{n}"))
            .alias(n)
            for n in probs
        ],
    )


def step_window(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    build: Callable[[object], Mapping[str, Column]],
    before: int = 0,
    after: int = 0,
    block: int = BLOCK,
) -> DataFrame:
    """Row-frame window columns over a dense step index, computed block by block.

    Each key is cut into blocks of ``block`` steps. The ``before`` steps ahead of
    a block and the ``after`` steps behind it are copied into it, so frames that
    reach no further are exact. Rows are placed by key and block: input that is
    already placed by key alone would otherwise keep a long key in one task.
    """
    block = max(block, before + after + 1)
    own = F.floor(F.col(t) / F.lit(block))
    low = F.floor((F.col(t) - F.lit(after)) / F.lit(block))
    high = F.floor((F.col(t) + F.lit(before)) / F.lit(block))
    spread = df.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(low, high)))
    spread = spread.repartition(*keys, "_block")
    w = Window.partitionBy(*keys, "_block").orderBy(t)
    cols = build(w)
    kept = [c for c in df.columns if c not in cols]
    return (
        spread.select(*kept, "_own", "_block", *[c.alias(n) for n, c in cols.items()])
        .filter(F.col("_own") == F.col("_block"))
        .drop("_own", "_block")
    )


def block_scan(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    column: str,
    out: str,
    how: str,
    block: int = BLOCK,
) -> DataFrame:
    """Unbounded scan over a step index: ``sum``, ``last`` or ``next`` non-null value.

    Blocks are reduced to one row each, the reduced rows are scanned per key, and
    the result enters every block as its starting value.
    """
    # One struct as key: structs with equal NULL fields are equal, in joins too.
    tagged = (
        df.withColumn("_key", F.struct(*keys) if keys else F.lit(0))
        .withColumn("_block", F.floor(F.col(t) / F.lit(block)))
        .repartition("_key", "_block")
    )
    x = F.col(column)
    seen = F.when(x.isNotNull(), F.col(t))
    per_key = Window.partitionBy("_key").orderBy("_block")
    local = Window.partitionBy("_key", "_block").orderBy(t)
    if how == "sum":
        reduced = F.sum(x)
        carry = F.sum("_red").over(per_key.rowsBetween(Window.unboundedPreceding, -1))
        inner = F.sum(x).over(local.rowsBetween(Window.unboundedPreceding, 0))
        merged = F.coalesce(F.col("_in"), F.lit(0.0)) + F.coalesce(F.col("_carry"), F.lit(0.0))
    elif how == "last":
        reduced = F.max_by(x, seen)
        carry = F.last("_red", ignorenulls=True).over(
            per_key.rowsBetween(Window.unboundedPreceding, -1)
        )
        inner = F.last(x, ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, 0))
        merged = F.coalesce(F.col("_in"), F.col("_carry"))
    elif how == "next":
        reduced = F.min_by(x, seen)
        carry = F.first("_red", ignorenulls=True).over(
            per_key.rowsBetween(1, Window.unboundedFollowing)
        )
        inner = F.first(x, ignorenulls=True).over(local.rowsBetween(0, Window.unboundedFollowing))
        merged = F.coalesce(F.col("_in"), F.col("_carry"))
    else:
        raise ValueError(how)
    blocks = tagged.groupBy("_key", "_block").agg(reduced.alias("_red"))
    carried = blocks.select("_key", "_block", carry.alias("_carry"))
    rows = tagged.withColumn("_in", inner).join(carried, ["_key", "_block"])
    return rows.select(*df.columns, merged.alias(out))
