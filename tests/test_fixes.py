"""Cases that once gave wrong or incomplete results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import aggs as A
from tablewright.operators import classify as C
from tablewright.operators import drift as D
from tablewright.operators import features as X
from tablewright.operators import loops as L
from tablewright.operators import mlops as O
from tablewright.operators import quality as Q
from tablewright.operators import sampling as S
from tablewright.operators import timeseries as TS
from tablewright.operators import trees as M
from tablewright.operators.ordering import exact_quantiles
from tablewright.sources import readers as R


def test_pages_follow_the_order(spark):
    rows = [(1, i) for i in range(25)] + [(2, i) for i in range(3)] + [(None, i) for i in range(11)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(5)
    got = {(r.k, r.part): [x.i for x in r["items"]] for r in A.collect_items(df, "k", "i", ["i"], chunk=10).collect()}
    assert got == {
        (1, 0): list(range(10)), (1, 1): list(range(10, 20)), (1, 2): list(range(20, 25)),
        (2, 0): [0, 1, 2], (None, 0): list(range(10)), (None, 1): [10],
    }


def test_flattened_lists_are_counted_in_elements(spark):
    df = spark.createDataFrame([(1, i, list(range(200))) for i in range(100)], "k int, id int, xs array<int>")
    got = A.flatten_lists(df, ["k"], "xs", "id", "xs", chunk=3000).select("part", F.size("xs").alias("n"), F.col("xs")[0].alias("lo")).collect()
    assert sorted((r.part, r.n) for r in got) == [(i, 3000) for i in range(6)] + [(6, 2000)]
    assert [r.lo for r in sorted(got)] == [0, 30, 60, 90, 120, 150, 180]


@pytest.mark.parametrize("fraction", [0.8, 3.0, 400.0])
def test_bootstrap_has_no_ceiling(spark, fraction):
    rows = spark.range(4000).withColumnRenamed("id", "key")
    n = S.bootstrap_sample(rows, "key", fraction, 3).count()
    assert n == pytest.approx(4000 * fraction, rel=0.05)


@pytest.mark.parametrize("block", [7, 16_384])
def test_lag_looks_everywhere(spark, block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=60)
    y = np.roll(x, 23)
    df = spark.createDataFrame([(None, i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "loop_id int, t long, x double, y double")
    got = {r.lag: r.c for r in L.cross_products(df, "t", "x", "y", block).collect()}
    want = np.correlate(x, y, "full")
    assert [got[k] for k in range(-59, 60)] == pytest.approx(list(want), abs=1e-9)
    loop = spark.createDataFrame([(1, i, float(a), 0.0, float(b)) for i, (a, b) in enumerate(zip(x, y))], "loop_id int, t long, pv double, sp double, op double")
    assert L.loop_pv_op_lag(loop).first().pv_op_lag in (23, 37)


def test_small_and_flat_classes(spark):
    rng = np.random.default_rng(1)
    rows = [(0, *map(float, rng.normal(0, 1, 2))) for _ in range(50)] + [(1, *map(float, rng.normal(8, 1, 2))) for _ in range(50)]
    rows += [(2, 4.0, 30.0)] + [(3, 100.0, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "label int, a double, b double")
    got = C.gaussian_discriminant(df, df, "label", ["a", "b"], "own").collect()
    assert np.mean([r.prediction == r.label for r in got if r.label < 2]) > 0.97
    assert all(r.prediction == 3 for r in got if r.label == 3)


def test_null_category_and_series_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), ("a", 1), ("b", 0)], "c string, y int")
    assert sorted(r.c_target for r in X.encode_target(df, "c", "y").collect()) == [0.0, 0.5, 0.5, 1.0]
    rows = [(k, t, float(t % 4) + 0.1 * t + (0 if k else 1) * ((t * 7919) % 13)) for k in (None, 5) for t in range(40)]
    series = spark.createDataFrame(rows, "k int, t long, v double")
    keys = lambda out: {r.k for r in out.select("k").collect()}
    assert keys(TS.forecast_ar(series, ["k"], "t", "v", 1, 2)) == {None, 5}
    trend = TS.forecast_trend_seasonal(series, ["k"], "t", "v", 4, 4)
    assert keys(trend) == {None, 5}
    parts = TS.decompose_moving_average(series, ["k"], "t", "v", 4)
    assert parts.filter("trend is not null and season is null").isEmpty()
    assert keys(TS.stationarity_report(series, ["k"], "t", "v", 0, 5)) == {None, 5}
    assert keys(TS.forecast_fourier(series, ["k"], "t", "v", 4, 1, 2)) == {None, 5}
    assert keys(TS.forecast_sarima(series, ["k"], "t", "v", (1, 0, 0), 4, 2)) == {None, 5}


def test_drift_of_a_column_without_values(spark):
    ref = spark.createDataFrame([(float(i), None) for i in range(50)], "a double, b double")
    new = spark.createDataFrame([(float(i), 1.0) for i in range(50)], "a double, b double")
    got = {r.feature: (r.psi, r.drift) for r in D.psi_drift(ref, new, ["a", "b"]).collect()}
    assert got["a"] == (pytest.approx(0, abs=1e-4), 0) and got["b"] == (None, None)


def test_profile_runs_whole_stages(spark):
    ran = spark.sparkContext.accumulator(0)

    def touch(x):
        ran.add(1)
        return x

    slow = F.udf(touch, "long")
    out = O.config_profile(spark, {"s": lambda: spark.range(20).select(slow("id").alias("x"))}, {"c": {}}).first()
    assert out.rows == 20 and ran.value >= 20 and out.seconds > 0 and out.share == 1


def test_models_work_after_a_profile(spark):
    """A fitted model with a training summary holds the session; nothing in it may refuse to be sent."""
    from pyspark.ml.linalg import Vectors

    O.config_profile(spark, {"s": lambda: spark.range(20)}, {"c": {}}).collect()
    rows = [(float(i % 2), Vectors.dense([i % 2 + 0.1 * (i % 7), 1.0 * (i % 3)])) for i in range(60)]
    df = spark.createDataFrame(rows, ["label", "features"])
    for model in (M.logistic_regression, M.random_forest, M.linear_svc):
        assert model(df, df).first().accuracy == 1


def test_html(spark):
    html = """<DIV id='x' class="big ad"><b>one</b><div>in</div> two</DIV><div class=ad>three</div><div class="add">no</div>
    <A HREF='u1'>x</A><a href="u2">y</a><a href=u3>z</a>"""
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert df.select(R.html_class_text(F.col("html"), "div", "ad").alias("x")).first().x == "onein two"
    assert [r.href for r in R.html_links(df, "html", "").collect()] == ["u1", "u2", "u3"]
    cards = """<li class="item"><p class="t">A</p><i class="p">1</i></li><li class='item new'><p class="t">B</p></li>"""
    rows = R.html_elements(spark.createDataFrame([(1, cards)], "page_id int, html string"), "html", "li", "item", {"title": ("p", "t"), "price": ("i", "p")})
    assert [tuple(r) for r in rows.orderBy("element").collect()] == [(1, 0, "A1", "A", "1"), (1, 1, "B", "B", None)]


def test_html_of_any_depth_and_length(spark):
    deep = "<div class=ad>" + "".join(f"{i}<div>" for i in range(5)) + "x" + "</div>" * 5 + "end</div>"
    long = '<div class="ad">' + "word " * 20_000 + "</div>"
    nested = "<div class=ad>a<div class=ad>b</div>c</div>"
    left_open = "<div class=ad>no<div class='ad'>yes</div>"
    df = spark.createDataFrame([(1, deep + long + nested + left_open), (2, None), (3, "<div class=ad")], "page_id int, html string")
    want = ["01234xend", ("word " * 20_000).strip(), "abc"]
    got = R.html_elements(df, "html", "div", "ad", {}).orderBy("element").collect()
    assert [(r.page_id, r.element, r.text) for r in got] == [(1, i, t) for i, t in enumerate([*want, "yes"])]
    first = df.select("page_id", R.html_class_text(F.col("html"), "div", "ad").alias("x")).collect()
    assert {r.page_id: r.x for r in first} == {1: want[0], 2: None, 3: None}


def test_loop_files(spark, tmp_path):
    (tmp_path / "loop_id=1").mkdir()
    (tmp_path / "loop_id=2").mkdir()
    (tmp_path / "loop_id=1" / "a.csv").write_text("Time,PV,SP,OP\n0.1,1,2,3\n0.2,4,5,6\n")
    (tmp_path / "loop_id=2" / "b.csv").write_text("a,b\n7,8\n")
    got = sorted(map(tuple, R.read_loop_files(spark, str(tmp_path), r"loop_id=(\d+)").collect()), key=str)
    assert got == [(1, 0.1, 1.0, 2.0, 3.0), (1, 0.2, 4.0, 5.0, 6.0), (2, None, None, None, None), (2, None, None, None, None)]


def test_many_levels(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("v"), F.col("id") % 1500)).alias("c"))
    rows = X.encode_onehot_vector(df, "c", "v").collect()
    levels = {r.c for r in rows if r.c}
    assert len(rows) == 3000 and len(levels) > 1000
    assert all(r.v.size == len(levels) and r.v.numNonzeros() == (r.c is not None) for r in rows)
    assert len({int(r.v.indices[0]) for r in rows if r.c}) == len(levels)


def test_broadcast_is_bounded_by_bytes(spark):
    from tablewright.operators.joins import small_enough

    assert small_enough(spark.range(100)) and not small_enough(spark.range(101), rows=100)
    assert not small_enough(spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s")), size=50_000)


def test_adf_p_values():
    """The critical values of the statistic are where its p-value says so."""
    assert TS.adf_p_value(-3.43) == pytest.approx(0.01, abs=0.001)
    assert TS.adf_p_value(-2.862) == pytest.approx(0.05, abs=0.001)
    assert TS.adf_p_value(-2.567) == pytest.approx(0.10, abs=0.002)
    assert TS.adf_p_value(3.0) == 1.0 and TS.adf_p_value(-30.0) == 0.0


def test_seasonal_terms_are_found(spark):
    rng = np.random.default_rng(6)
    y = list(rng.normal(size=4))
    for i in range(4, 4000):
        y.append(0.7 * y[i - 4] + rng.normal() * 0.1)
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(y)], "k int, t long, v double")
    out = TS.forecast_sarima(df, ["k"], "t", "v", (0, 0, 0), 4, 2, seasonal=(1, 0, 0)).orderBy("t").collect()
    assert [r.forecast for r in out] == pytest.approx([0.7 * y[-4], 0.7 * y[-3]], abs=0.02)
    assert out[0].high - out[0].low == pytest.approx(2 * 1.96 * 0.1, rel=0.1)


def test_scope_leaves_nothing_behind(spark):
    import os

    from tablewright.session import pin, scratch_scope

    with scratch_scope(spark) as path:
        kept = pin(spark.range(5))
        assert kept.count() == 5 and path in kept.inputFiles()[0]
        local = path.removeprefix("file:")
        assert os.path.isdir(local)
    assert not os.path.exists(local)


def test_pivot_is_wide(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 4.0), (1, "b", 5.0), (2, "b", 7.0)], "m int, y string, v double")
    got = A.pivot_mean(df, "m", "y", "v", ["a", "b"]).orderBy("m").collect()
    assert [tuple(r) for r in got] == [(1, 3.0, 5.0), (2, None, 7.0)]


def test_group_statistic_of_null_keys_and_a_hot_key(spark):
    rows = [(None, 1.0), (None, 3.0), (None, None), ("a", 10.0), ("a", None), ("none", None)] + [("hot", float(i)) for i in range(99)] + [("hot", None)]
    got = Q.impute_group_stat(spark.createDataFrame(rows, "k string, v double"), "v", ["k"], out="f").filter("v is null").collect()
    known = sorted([1.0, 3.0, 10.0] + [float(i) for i in range(99)])
    overall = (known[50] + known[51]) / 2 if len(known) % 2 == 0 else known[len(known) // 2]
    assert {r.k: r.f for r in got} == {None: 2.0, "a": 10.0, "hot": 49.0, "none": overall}


@pytest.mark.parametrize("limit", [5, 40, 10_000])
def test_quantiles_by_brackets(spark, limit):
    rng = np.random.default_rng(limit)
    data = {
        "even": rng.uniform(-5, 5, 300), "skew": np.exp(rng.normal(0, 6, 301)), "ties": rng.integers(0, 4, 200).astype(float), "one": np.full(150, 2.5),
        None: np.r_[np.full(99, -1e308), np.full(101, 1e308)], "tiny": rng.integers(0, 9, 120) * 5e-324, "few": np.array([3.0]),
        "wild": np.r_[rng.normal(size=60), np.inf, -np.inf],
    }
    rows = [(k, float(v)) for k, y in data.items() for v in y] + [("even", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    probs = {"lo": 0.0, "q": 0.25, "m": 0.5, "r": 0.9, "hi": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs, limit).collect()}
    assert set(got) == set(data)
    for k, y in data.items():
        s = np.sort(y)
        for n, p in probs.items():
            pos = p * (len(s) - 1)
            a, b = s[int(np.floor(pos))], s[int(np.ceil(pos))]
            want = a if a == b else a + (b - a) * (pos - np.floor(pos)) if np.isfinite(b - a) else None
            if want is not None:
                assert got[k][n] == pytest.approx(want, rel=1e-12), (k, n)
    whole = exact_quantiles(df.filter("k = 'even'"), [], "v", {"m": 0.5}, limit).collect()
    assert [r.m for r in whole] == [pytest.approx(np.median(data["even"]))]
    assert exact_quantiles(df.limit(0), ["k"], "v", probs, limit).collect() == []


def test_kpss_lags_from_the_data(spark):
    rng = np.random.default_rng(2)
    data = {"noise": rng.normal(size=400), None: rng.normal(size=150).cumsum(), "flat": np.full(30, 2.0), "one": np.array([1.0])}
    df = spark.createDataFrame([(k, i, float(v)) for k, y in data.items() for i, v in enumerate(y)], "k string, t long, v double")
    got = {r.k: r for r in TS.kpss_auto(df, ["k"], "t", "v").collect()}
    assert set(got) == set(data) and got["flat"].kpss is None and got["one"].kpss is None
    for k in ("noise", None):
        d = data[k] - data[k].mean()
        n = len(d)
        g = lambda j: float(d[j:] @ d[: n - j])
        m = int(n ** (2 / 9))
        s0, s1 = g(0) / n + sum(2 * g(j) / n for j in range(1, m + 1)), sum(2 * j * g(j) / n for j in range(1, m + 1))
        lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
        longrun = (g(0) + sum(2 * (1 - j / (lags + 1)) * g(j) for j in range(1, lags + 1))) / n
        want = (d.cumsum() ** 2).sum() / n**2 / longrun
        assert got[k].lags == lags and got[k].kpss == pytest.approx(want, rel=1e-9)
    assert got["noise"].p_value == 0.1 and got["noise"].stationary == 1 and got[None].stationary == 0


@pytest.mark.parametrize("cell", [1, 16, 1 << 17])
def test_long_loops_are_correlated_by_spectrum(spark, cell):
    """Also with missing values and a start far from zero, in one band or many."""
    rng = np.random.default_rng(4)
    sizes = {None: 75, 1: 64, 2: 9}
    data, want = [], {}
    for k, n in sizes.items():
        x, y = rng.normal(size=n), rng.normal(size=n)
        gone = {3, 4, n - 1}
        data += [(k, 1000 + i, None if i in gone else float(a), float("nan") if i == 1 else float(b)) for i, (a, b) in enumerate(zip(x, y))]
        x[list(gone)], y[1] = 0, 0
        want[k] = dict(zip(range(-n + 1, n), np.correlate(x, y, "full")))
    df = spark.createDataFrame(data, "loop_id int, t long, x double, y double")
    got = L.cross_products(df, "t", "x", "y", 7, cell).collect()
    for k, n in sizes.items():
        own = {r.lag: r.c for r in got if r.loop_id == k}
        assert sorted(own) == list(range(-n + 1, n - 1))
        assert [own[i] for i in sorted(own)] == pytest.approx([want[k][i] for i in sorted(own)], abs=1e-9)


def test_rows_of_long_loops_are_not_copied_per_block(spark):
    rows = spark.range(4000).selectExpr("1 loop_id", "id t", "sin(id) x", "cos(id) y")
    plan = L.cross_products(rows, "t", "x", "y", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan


def test_partitions_of_a_fit_grow_with_the_table(spark, monkeypatch):
    from tablewright.operators import skew

    monkeypatch.setattr(skew, "PART_ROWS", 100)
    rows = spark.range(2000).selectExpr("id", "id * 2.0 x")
    spread = skew.spread_out(rows)
    assert spread.rdd.getNumPartitions() == 20
    assert sorted(r.id for r in spread.collect()) == list(range(2000))
    assert skew.spread_out(rows, 3).rdd.getNumPartitions() == 3
