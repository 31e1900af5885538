"""Mixing sources to target sizes by entropy balancing.

The rates of the documents of a source are as close to 1 as can be, in the sense of relative
entropy, subject to the source's words meeting its target and no rate above the ceiling:
``rate = min(ceiling, exp(tilt * size / mean size))``. The tilts solve the convex dual; Newton steps
run for all sources at once over the table of (source, size, documents), which holds
everything the dual needs, with a bracket that a step may not leave. Rates become whole copies:
the whole part, and one more for documents chosen by a hash in proportion to the
remainder until the source's target is reached.

Only DataFrame functions are used; the driver sees a few numbers a round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.joins import null_safe_join
from tablewright.operators.ordering import dense_index
from tablewright.operators.skew import attach
from tablewright.session import pin

WEIGHTS = (3, 1, 2)  # by place of the source, repeating
SHARE = 1.5  # of all words
CEILING = 2  # copies of a document
BUCKETS = 4096
NEWTON = 60
FILLS = 12
WORD = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame, text: str, source: str, key: Sequence[str]) -> DataFrame:
    """``docs`` with ``_source, _size`` (words) and ``_draw`` (a hash of the key and text)."""
    size = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        "*", F.col(source).cast("string").alias("_source"), size.alias("_size"), F.xxhash64(*key, text).alias("_draw")
    )


def told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with draws of their own for rows that have one in common, as copies of a row do.

    Only those are written and numbered 0, 1, ... within a draw, over range partitions, so a row
    that makes up a third of the table is spread too; number and draw give the new draw. Copies are alike, so it
    does not matter which of them has which number.
    """
    several = rows.groupBy("_draw").agg(F.count(F.lit(1)).alias("_several")).filter("_several > 1")
    several = pin(several)
    if several.isEmpty():
        return rows
    marked = attach(rows, several, ["_draw"], "left")
    tied = pin(marked.filter("_several is not null").drop("_several").withColumn("_tie", F.monotonically_increasing_id()))
    numbered = dense_index(tied, ["_draw"], ["_tie"], "_copy").drop("_tie")
    fresh = numbered.withColumn("_draw", F.xxhash64("_draw", "_copy")).drop("_copy")
    return marked.filter("_several is null").drop("_several").unionByName(fresh)


def targets(sizes: DataFrame, weights: Sequence[float], share: float, ceiling: float) -> DataFrame:
    """``_source, source_size, target`` from ``_source, source_size``.

    Sources in code point order, null last, get weights in turn. With level L a target is
    min(L * weight, ceiling * size); L rises until the targets sum to the share.
    """
    order = sizes.withColumn("_null", F.col("_source").isNull())
    placed = dense_index(order, [], ["_null", "_source"], out="_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("_place", F.lit(len(weights))) + 1).cast("int"))
    table = pin(placed.select("_source", "source_size", weight.alias("_weight")))
    cap = F.lit(float(ceiling)) * F.col("source_size")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = -1.0
    while True:
        above = (F.lit(level) * F.col("_weight")) > cap
        row = table.agg(
            F.sum(F.when(above, cap).otherwise(0.0)).alias("full"), F.sum(F.when(above, 0.0).otherwise(F.col("_weight"))).alias("open")
        ).first()
        if not row["open"]:
            break
        risen = (share * total - row["full"]) / row["open"]
        if risen <= level:
            break
        level = risen
    return table.select("_source", "source_size", F.least(F.lit(level) * F.col("_weight"), cap).alias("target"))


def _none() -> Column:
    return F.array().cast("array<long>")


def _rate(tilt: Column, size: Column, mean: Column, ceiling: float, full: Column) -> Column:
    return F.when(full, F.lit(float(ceiling))).otherwise(F.least(F.lit(float(ceiling)), F.exp(tilt * size / mean)))


def tilts(rows: DataFrame, aims: DataFrame, ceiling: float) -> DataFrame:
    """``aims`` with ``mean, full, tilt`` per source: the dual's solution.

    ``rows`` has ``_source, _size``. A source whose target is its ceiling is ``full``.
    """
    table = pin(rows.filter("_size > 0").groupBy("_source", "_size").agg(F.count(F.lit(1)).alias("n")))
    means = table.groupBy("_source").agg((F.sum(F.col("_size") * F.col("n")) / F.sum("n")).alias("mean"))
    base = null_safe_join(aims, means, ["_source"], "left").select(
        *aims.columns,
        F.coalesce("mean", F.lit(1.0)).alias("mean"),
        (F.col("target") >= ceiling * F.col("source_size")).alias("full"),
    )
    state = pin(
        base.select("*", F.lit(0.0).alias("tilt"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"), F.lit(1.0).alias("miss"))
    )
    size = F.col("_size").cast("double")
    for _ in range(NEWTON):
        joined = null_safe_join(table, state.select("_source", "mean", "tilt").filter("not full"), ["_source"])
        power = F.exp(F.col("tilt") * size / F.col("mean"))
        words = F.col("n") * size
        slopes = joined.groupBy("_source").agg(
            F.sum(words * F.least(F.lit(float(ceiling)), power)).alias("got"),
            F.sum(F.when(power < ceiling, words * power * size / F.col("mean")).otherwise(0.0)).alias("slope"),
        )
        moved = null_safe_join(state, slopes, ["_source"], "left")
        over = F.col("got") - F.col("target")
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(over, F.col("slope"))
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        step = F.when(inside, newton).otherwise((low + high) / 2)
        # Rounded, so that sums taken in another order give the same copies.
        tilt = F.when(F.col("got").isNull() | (over == 0), F.col("tilt")).otherwise(F.round(step, 9))
        miss = F.when(F.col("got").isNull(), 0.0).otherwise(F.abs(tilt - F.col("tilt")))
        state = pin(moved.select(*base.columns, tilt.alias("tilt"), low.alias("low"), high.alias("high"), miss.alias("miss")))
        if not state.filter("miss > 1e-8").head(1):
            break
    return state.select(*base.columns, "tilt")


def _bucket(k: Column, left: Column) -> Column:
    """Place of a row in fill ``k``, 0 to BUCKETS. The first fill orders rows by draw / remainder,
    so the chance of a copy is the remainder; later ones by a fresh draw."""
    draw = (F.pmod(F.xxhash64("_draw", k), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    return F.floor(F.when(k == 0, draw / (draw + left)).otherwise(draw) * BUCKETS).cast("long")


def _rest(ceiling: int) -> Column:
    """The part of a row's rate beyond whole copies."""
    rate = _rate(F.col("tilt"), F.col("_size").cast("double"), F.col("mean"), ceiling, F.col("full"))
    return rate - F.floor(rate)


def _copies(ceiling: int) -> Column:
    """Copies of a row joined with its source's ``tilt, mean, full, edges, gaps``: the whole copies
    of its rate, and one more in each fill k in which it fits, its size being ``gaps[k]`` at
    most and its bucket below ``edges[k]``, up to the ceiling."""
    whole = F.floor(_rate(F.col("tilt"), F.col("_size").cast("double"), F.col("mean"), ceiling, F.col("full"))).cast("long")
    fills = F.when(F.size("edges") > 0, F.sequence(F.lit(0), F.size("edges") - 1)).otherwise(F.array().cast("array<int>"))

    def one(n: Column, k: Column) -> Column:
        fits = (F.col("_size") > 0) & (F.col("_size") <= F.get("gaps", k)) & (n < ceiling)
        return n + F.when(fits & (_bucket(k, _rest(ceiling)) < F.get("edges", k)), 1).otherwise(0).cast("long")

    return F.aggregate(fills, whole, one)


def plan(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """What each source's rows need to know: ``_source, source_size, target, mean, full, tilt, edges, gaps``.

    ``rows`` has ``_source, _size, _draw`` and is read several times. Each fill buckets the rows that
    may still get a copy and fit into the words missing, and takes buckets while they fit;
    so what stays missing in the end is less than any row that could be added.
    """
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    state = tilts(rows, targets(pin(sizes), weights, share, ceiling), ceiling)
    first = null_safe_join(rows, state.withColumns({"edges": _none(), "gaps": _none()}), ["_source"])
    first = first.groupBy("_source").agg(F.sum(_copies(ceiling) * F.col("_size")).alias("used"))
    missing = F.greatest(F.floor(F.col("target")) - F.coalesce("used", F.lit(0)), F.lit(0)).cast("long")
    state = pin(null_safe_join(state, first, ["_source"], "left").select(*state.columns, missing.alias("gap"), _none().alias("edges"), _none().alias("gaps")))
    run = F.sum("words").over(Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    for k in range(FILLS):
        open_rows = null_safe_join(rows, state, ["_source"]).filter(
            (F.col("_size") > 0) & (F.col("_size") <= F.col("gap")) & (_copies(ceiling) < ceiling)
        )
        buckets = open_rows.groupBy("_source", _bucket(F.lit(k), _rest(ceiling)).alias("_bucket")).agg(F.sum("_size").alias("words"), F.first("gap").alias("gap"))
        buckets = buckets.filter(F.col("_bucket") < BUCKETS).withColumn("run", run)
        over = F.col("run") > F.col("gap")
        edge = buckets.groupBy("_source").agg(
            F.coalesce(F.min(F.when(over, F.col("_bucket"))), F.lit(BUCKETS)).alias("edge"),
            F.coalesce(F.max(F.when(~over, F.col("run"))), F.lit(0)).alias("taken"),
        )
        moved = null_safe_join(state, edge, ["_source"], "left")
        state = pin(
            moved.select(
                *[c for c in state.columns if c not in ("gap", "edges", "gaps")],
                (F.col("gap") - F.coalesce("taken", F.lit(0))).alias("gap"),
                F.concat("edges", F.array(F.coalesce("edge", F.lit(0)))).alias("edges"),
                F.concat("gaps", F.array("gap")).alias("gaps"),
                F.col("edge").isNotNull().alias("open"),
            )
        )
        going = state.filter("open").head(1)
        state = state.drop("open")
        if k and not going:
            break
    return state


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: Sequence[str] = ("doc_id",),
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    ceiling: int = CEILING,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken``.

    Size: words (runs of characters other than 0x20 and 0x09-0x0D); null text: 0; texts
    of no words are taken as their rate says. A null source is a source of its own, the last. Rows
    that repeat are drawn each by itself. Sources of no words have target 0. No rows: no rows. Columns
    named like the results are replaced, others pass through.
    """
    results = ["size", "source_size", "target", "copies", "taken"]
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in results or c in (text, source, *key)])
    rows = told_apart(measured(plain, text, source, key))
    narrow = pin(rows.select("_source", "_size", "_draw"))
    state = plan(narrow, weights, share, ceiling)
    return _applied(rows, state, ceiling, plain.columns)


def _applied(rows: DataFrame, state: DataFrame, ceiling: int, columns: Sequence[str]) -> DataFrame:
    found = null_safe_join(rows, state, ["_source"]).withColumn("_n", _copies(ceiling))
    return found.select(
        *[f"`{c}`" for c in columns],
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.col("_n").alias("copies"),
        (F.col("_n") * F.col("_size")).alias("taken"),
    )
