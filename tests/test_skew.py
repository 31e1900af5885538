"""A key with a third of all rows and more: ordered helpers must equal plain windows."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators import ordering as O
from tablewright.operators import series as S
from tablewright.operators.aggs import collect_items, flatten_lists
from tablewright.operators.skew import deal_hot_keys


@pytest.fixture(scope="module")
def skewed(spark):
    # Key 0 holds more than a third; one key is NULL; values repeat, some are missing.
    n = F.col("id")
    key = F.when(n % 5 < 2, 0).when(n % 7 == 6, None).otherwise(n % 7)
    return spark.range(6000, numPartitions=6).select(
        key.alias("k"), n.alias("id"), F.when(n % 11 != 0, (n * 37 % 101).cast("double")).alias("v")
    )


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dense_index(skewed):
    got = O.dense_index(skewed, ["k"], ["id"], "t").select("k", "id", "t")
    w = Window.partitionBy("k").orderBy("id")
    want = skewed.select("k", "id", (F.row_number().over(w) - 1).cast("long").alias("t"))
    assert rows(got, "id") == rows(want, "id")


def test_dense_index_without_key(skewed):
    got = O.dense_index(skewed, [], ["id"], "t").select("id", "t")
    assert all(a == b for a, b in rows(got, "id"))


def test_running_totals(skewed):
    base = skewed.na.fill(0.0)
    got = O.running_totals(base, ["k"], ["id"], {"run": "v"}).select("id", "run", "run_total")
    w = Window.partitionBy("k").orderBy("id")
    want = base.select("id", F.sum("v").over(w).alias("run"), F.sum("v").over(Window.partitionBy("k")).alias("t"))
    assert rows(got, "id") == rows(want, "id")


@pytest.mark.parametrize("probs", [{"a": 0.0, "b": 0.5, "c": 1.0}, {"a": 0.25, "b": 0.123, "c": 0.9}])
def test_exact_quantiles(skewed, probs):
    got = {r["k"]: r for r in O.exact_quantiles(skewed, ["k"], "v", probs).collect()}
    frame = skewed.dropna(subset=["v"]).toPandas()
    for k, g in [*frame.groupby("k"), (None, frame[frame["k"].isna()])]:
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(g["v"], p), abs=1e-9)


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_step_window_blocks(skewed, block):
    dense = O.dense_index(skewed, ["k"], ["id"], "t")

    def build(w):
        return {
            "lag2": F.lag("v", 2).over(w),
            "lead1": F.lead("v", 1).over(w),
            "mean": F.avg("v").over(w.rowsBetween(-3, 2)),
        }

    got = O.step_window(dense, ["k"], "t", build, before=3, after=2, block=block)
    plain = dense.select("*", *[c.alias(n) for n, c in build(Window.partitionBy("k").orderBy("t")).items()])
    assert rows(got.select("id", "lag2", "lead1", F.round("mean", 9)), "id") == rows(
        plain.select("id", "lag2", "lead1", F.round("mean", 9)), "id"
    )


@pytest.mark.parametrize("block", [5, 1000])
@pytest.mark.parametrize("how", ["sum", "last", "next"])
def test_block_scan(skewed, how, block):
    dense = O.dense_index(skewed, ["k"], ["id"], "t")
    w = Window.partitionBy("k").orderBy("t")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = {
        "sum": F.coalesce(F.sum("v").over(up), F.lit(0.0)),
        "last": F.last("v", True).over(up),
        "next": F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    }[how]
    got = O.block_scan(dense, ["k"], "t", "v", "out", how, block)
    assert rows(got.select("id", "out"), "id") == rows(dense.select("id", plain.alias("out")), "id")


def test_hot_keys_are_dealt_whole(skewed):
    dealt = deal_hot_keys(skewed, ["k"], ["id"], chunk=500)
    sizes = dealt.groupBy("k", "part").count().toPandas()
    assert sizes["count"].sum() == 6000
    assert sizes["count"].max() < 750
    assert (sizes[sizes["k"] != 0]["part"].nunique()) >= 1
    small = deal_hot_keys(skewed, ["k"], ["id"], chunk=100_000)
    assert small.select("part").distinct().collect() == [(0,)]


def test_collect_items_parts(skewed):
    lists = collect_items(skewed, "k", "id", ["id", "v"], chunk=300)
    assert lists.agg(F.sum(F.size("items"))).first()[0] == 6000
    assert lists.agg(F.max(F.size("items"))).first()[0] < 500
    pairs = skewed.withColumn("two", F.array("id", F.col("id") + 1))
    flat = flatten_lists(pairs, ["k"], "two", "id", "all", chunk=300)
    assert flat.agg(F.sum(F.size("all"))).first()[0] == 12000


def test_interpolation_over_blocks(spark):
    v = [None, 1.0, None, None, 4.0, None, 8.0, None]
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "t": range(8), "v": v}), "k int, t long, v double")
    out = [r["filled"] for r in S.linear_interpolate(df.replace(float("nan"), None), ["k"], "t", "v").orderBy("t").collect()]
    assert out == [None, 1.0, 2.0, 3.0, 4.0, 6.0, 8.0, None]


def test_fill_steps_long_span(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 25_001, 2.0), (None, 5, 3.0)], "k int, t long, v double")
    full = S.fill_steps(df, ["k"], "t")
    assert full.count() == 25_002 + 1
    assert full.filter("v IS NOT NULL").count() == 3


def test_null_keys_keep_their_rows(skewed):
    from tablewright.operators.sampling import class_weights
    from tablewright.operators.timeseries import centred

    weighted = class_weights(skewed, "k")
    assert weighted.count() == 6000 and weighted.filter("weight IS NULL").count() == 0
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(6000)
    assert centred(skewed, ["k"], "v").count() == 6000


def test_summary_sizes_its_own_shuffles(spark, monkeypatch):
    """With few partitions in the session, tasks of a customer summary stay at ``PART_ROWS`` rows, and its rows the same."""
    from tablewright.operators import aggs, skew

    class Few:
        lineitem = spark.range(6000).select(
            F.when(F.col("id") % 97 != 0, F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 800)).alias("l_orderkey"),
            F.col("id").alias("l_linenumber"), (F.col("id") % 53).alias("l_partkey"),
            (F.col("id") % 11).cast("double").alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"),
        )

    from tablewright.plans.bindings import ITEM_SCHEMA, Tables

    orders = spark.range(900).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 5 != 0, F.col("id") % 40).alias("o_custkey"), F.lit(2.0).alias("o_totalprice")
    )
    summary = lambda: aggs.customer_summary(orders, Tables.order_items.fget(Few), ITEM_SCHEMA)
    plain = summary().collect()
    for chunk in (10_000, 500):  # the second makes order 1 a hot key
        monkeypatch.setattr(skew, "PART_ROWS", 100)
        monkeypatch.setattr(skew.in_pages, "__defaults__", (chunk, "page", None))
        dealt = summary()
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain))
        if chunk == 10_000:
            plan = dealt._jdf.queryExecution().executedPlan().toString()
            sizes = {int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\)", plan)}
            assert sizes and min(sizes) > 8
