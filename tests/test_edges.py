"""Empty tables, single rows, constants, all-NULL columns, ties, zero denominators."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators import aggs as A
from tablewright.operators import drift as D
from tablewright.operators import evaluate as E
from tablewright.operators import features as X
from tablewright.operators import project as P
from tablewright.operators import quality as Q
from tablewright.operators import series as S
from tablewright.operators import timeseries as TS
from tablewright.operators import windows as W


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1, "a", 1.0), (2, "a", None), (3, None, 3.0), (4, "b", 3.0), (5, None, None)]
    return spark.createDataFrame(rows, "id long, s string, v double")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "id long, s string, v double")


def test_empty_table(empty):
    assert A.null_profile(empty, ["s", "v"]).filter("pct_null IS NULL").count() == 2
    assert Q.corrupt_rows(empty, ["s", "v"]).first() == (0, 0, 0)
    assert A.describe_numeric(empty, ["v"]).count() == 0
    assert W.zscore_outliers(empty, "v").count() == 0
    assert W.mode_value(empty, "s").count() == 0
    assert A.collect_items(empty, "s", "id", ["id"]).count() == 0


def test_reports_on_nulls(small):
    assert {r[0]: r[1] for r in A.null_counts(small, ["id", "s", "v"]).collect()} == {"id": 0, "s": 2, "v": 2}
    assert Q.corrupt_rows(small, ["s", "v"]).first() == (5, 3, 4)
    assert Q.drop_sparse_rows(small, ["s", "v"], 1.0).count() == 4
    assert Q.drop_sparse_rows(small, ["s", "v"], 0.5).count() == 2
    assert Q.drop_null_columns(small).columns == ["id"]
    assert Q.drop_null_columns(small.withColumn("n", F.lit(None).cast("int")), "all").columns == ["id", "s", "v"]


def test_nan_counts_as_missing_only_in_float_columns(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "NaN")], "v double, s string")
    assert {r[0]: r[1] for r in A.null_counts(df, ["v", "s"]).collect()} == {"v": 1, "s": 0}


def test_imputers(small):
    out = {r["id"]: r for r in Q.impute_mean_mode(small, ["v"], ["s"]).collect()}
    assert out[2]["v"] == pytest.approx(7 / 3) and out[3]["s"] == "a"
    med = {r["id"]: r["v"] for r in Q.impute_median(small, small, ["v"]).collect()}
    assert med[5] == 3.0
    grp = {r["id"]: r["v"] for r in Q.impute_group_stat(small, "v", ["s"], "mean").collect()}
    assert grp[2] == 1.0 and grp[5] == pytest.approx(7 / 3)
    zero = small.select("id", F.when(F.col("id") < 3, 0).otherwise(F.col("id")).alias("z"))
    got = {r["id"]: r["z"] for r in Q.impute_zero_as_missing(zero, zero, ["z"]).collect()}
    assert got == {1: 4.0, 2: 4.0, 3: 3.0, 4: 4.0, 5: 5.0}


def test_constant_column(spark):
    df = spark.range(6).select(F.lit(2.0).alias("v"), "id")
    assert [r["n"] for r in A.histogram(df, "v", 4).orderBy("bin").collect()] == [6, 0, 0, 0]
    assert X.scale_minmax(df, df, ["v"]).filter("v IS NOT NULL").count() == 0
    assert X.scale_standard(df, df, ["v"]).filter("v IS NOT NULL").count() == 0
    edges = D.reference_edges(df, ["v"], 10)["v"]
    assert len(edges) == 11 and edges[0] == 2.0
    assert D.psi_drift(df, df, ["v"]).first()["psi"] == pytest.approx(0.0, abs=1e-6)


def test_psi_overflow_bins(spark):
    ref, new = spark.range(100).toDF("v"), spark.range(100, 200).toDF("v")
    plain = D.psi_drift(ref, new, ["v"]).first()
    wide = D.psi_drift(ref, new, ["v"], overflow=True).first()
    assert plain["psi"] >= 0 and wide["psi"] > 5 and wide["drift"] == 1
    assert D.ks_drift(ref, new, ["v"]).first()["ks"] == 1.0


def test_ties(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("x", 3, 4), ("x", 4, 4), ("y", 5, 1)], "k string, id int, q int")
    assert W.rank_topk(df, ["k"], [F.desc("q")], 3).count() == 5
    top = W.rownum_topk(df, ["k"], [F.desc("q"), F.col("id")], 3)
    assert sorted(r["id"] for r in top.collect()) == [1, 2, 3, 5]
    modes = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "s string")
    assert W.mode_value(modes, "s").first()["s"] == "a"


def test_single_row_group(spark):
    one = spark.createDataFrame([(1, 0, 2.0)], "k int, t long, v double")
    assert S.lag_diff(one, ["k"], "t", "v").first()["diff"] is None
    assert S.rolling_mean_std(one, ["k"], "t", "v", 3).first()["rolling_mean"] is None
    f = TS.forecast_drift(one, ["k"], "t", "v", 2).collect()
    assert [r["forecast"] for r in f] == [2.0, 2.0]
    assert S.lag_features(one, ["k"], "t", "v", 2).count() == 0
    assert TS.adf_test(one, ["k"], "t", "v").count() == 0


def test_series_shorter_than_segment(spark):
    df = spark.createDataFrame([(1, i, float(i % 3)) for i in range(10)], "k int, t long, v double")
    psd = TS.welch_psd(df, ["k"], "t", "v", 256)
    assert psd.count() == 6 and psd.agg(F.max("frequency")).first()[0] == 0.5


def test_mape_with_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 2.0), (4.0, 3.0)], "a double, p double")
    r = E.mape(df, "a", "p").first()
    assert r["mape"] == 0.25 and r["mape_masked"] == pytest.approx((2 + 0.25) / 2)
    same = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, p double")
    assert E.regression_metrics(same, "a", "p").first()["r2"] is None


def test_one_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "y string, p string")
    grid = {(r["label"], r["prediction"]): r["n"] for r in E.confusion_matrix(df, "y", "p").collect()}
    assert grid == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}
    rep = {r["class"]: r for r in E.classification_report(df, "y", "p").collect()}
    assert rep["b"]["recall"] == 0.0 and rep["a"]["precision"] == 1.0 and rep["accuracy"]["f1"] == 0.5


def test_bad_casts_become_null(spark):
    df = spark.createDataFrame([("$1,200.50",), ("n/a",), (None,)], "p string")
    assert [r["p"] for r in P.clean_currency(df, "p").collect()] == [1200.5, None, None]


def test_keyword_flag(spark):
    df = spark.createDataFrame([("Yes, HIGH",), ("nothing",), (None,), ("Oscillating SP",)], "s string")
    assert [r[0] for r in df.select(P.keyword_flag("s")).collect()] == [1, 0, 0, 1]


def test_schema_validate(small):
    want = StructType.fromDDL("id bigint, s int, w double")
    got = {r["column_name"]: r["status"] for r in Q.schema_validate(small, want).collect()}
    assert got == {"id": "ok", "s": "type mismatch", "w": "missing", "v": "extra"}


def test_unseen_level_gets_next_index(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "s string")
    rows = spark.createDataFrame([("b",), ("z",), ("a",)], "s string")
    got = {r["s"]: r["i"] for r in X.encode_label(train, rows, "s", "i").collect()}
    assert got == {"a": 0, "b": 1, "z": 2}


def test_onehot_of_many_levels(spark):
    assert len(X.encode_onehot(spark.range(1001).toDF("k"), "k").columns) == 1002


def test_kde_integrates_to_one(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    grid = [i / 10 for i in range(-60, 71)]
    out = A.kernel_density(df, "x", grid, 0.7).agg(F.sum("density")).first()[0]
    assert out / 10 == pytest.approx(1.0, abs=1e-6)


def test_log_diff_of_zero(spark):
    df = spark.createDataFrame([(1, 0, 0.0), (1, 1, math.e), (1, 2, math.e**2)], "k int, t long, v double")
    got = [r["log_diff"] for r in S.log_diff(df, ["k"], "t", "v").orderBy("t").collect()]
    assert got[:2] == [None, None] and got[2] == pytest.approx(1.0)
