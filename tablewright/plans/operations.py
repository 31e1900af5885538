"""Saved pipelines, scoring, promotion, profiles and streams."""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators import mlops as O
from tablewright.operators import trees as M
from tablewright.operators.aggs import customer_summary
from tablewright.operators.sampling import hash_percent
from tablewright.operators.windows import zscore_outliers
from tablewright.plans.bindings import DIRTY_ORDERS, ITEM_SCHEMA
from tablewright.plans.learning import line_split, vector_split
from tablewright.plans.process import PSI_SQL, halves
from tablewright.plans.registry import query
from tablewright.plans.relational import rounded
from tablewright.session import scratch_path
from tablewright.streaming import jobs


@query("submission_table")
def submission_table(t):
    train, test = vector_split(t)
    pred = LogisticRegression(maxIter=10).fit(train).transform(test)
    return rounded(M.submission_table(pred, "vec_id", [str(i) for i in range(10)]))


def order_table(t):
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority",
        "o_orderstatus",
        (F.col("o_totalprice") > 250000).cast("double").alias("label"),
    )


NUMERIC, TEXT = ["o_custkey", "o_orderkey"], ["o_orderpriority", "o_orderstatus"]


@query(
    "pipeline_save_load",
    """
    WITH r AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i FROM orders GROUP BY 1),
    s AS (SELECT o_orderstatus, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS j FROM orders GROUP BY 1)
    SELECT o_orderkey, i::DOUBLE AS priority_ix, j::DOUBLE AS status_ix FROM orders JOIN r USING (o_orderpriority) JOIN s USING (o_orderstatus)
    """,
)
def pipeline_save_load(t):
    from pyspark.ml import PipelineModel

    path = scratch_path(t.spark, "pipeline")
    M.tabular_pipeline(NUMERIC, TEXT).fit(order_table(t)).write().overwrite().save(path)
    again = PipelineModel.load(path).transform(order_table(t)).withColumn("a", vector_to_array("features"))
    return again.select("o_orderkey", F.col("a")[2].alias("priority_ix"), F.col("a")[3].alias("status_ix"))


@query(
    "tabular_prep",
    f"""
    WITH {DIRTY_ORDERS}, g AS (SELECT o_custkey, median(o_totalprice) AS med FROM dirty_orders WHERE o_totalprice IS NOT NULL GROUP BY 1),
    a AS (SELECT median(o_totalprice) AS med_all,
      (SELECT o_orderpriority FROM dirty_orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS m FROM dirty_orders),
    l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1),
    b AS (SELECT d.o_orderkey, CASE WHEN o_totalprice IS NULL THEN 0 ELSE 1 END AS o_totalprice_known,
      round(coalesce(o_totalprice, med, med_all), 4) AS o_totalprice, coalesce(o_orderpriority, m) AS o_orderpriority,
      coalesce(n, 0) + coalesce(r, 0) + 1 AS size FROM dirty_orders d LEFT JOIN g USING (o_custkey) LEFT JOIN l ON l_orderkey = d.o_orderkey, a)
    SELECT *, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' WHEN o_orderpriority IN ('5-LOW') THEN 'slow' ELSE 'other' END
      AS o_orderpriority_group, CASE WHEN size = 1 THEN 1 ELSE 0 END AS alone FROM b
    """,
)
def tabular_prep(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r")
    )
    rows = t.dirty_orders.join(lines, "o_orderkey", "left").na.fill(0, ["n", "r"])
    ready = O.tabular_prep(
        rows,
        price="o_totalprice",
        price_groups=["o_custkey"],
        category="o_orderpriority",
        groups={"fast": ["1-URGENT", "2-HIGH"], "slow": ["5-LOW"]},
        parts=["n", "r"],
    )
    return rounded(ready.drop("o_custkey", "o_orderstatus", "n", "r"))


def _saved_models(t):
    pipe, model = scratch_path(t.spark, "pipe"), scratch_path(t.spark, "model")
    rows = order_table(t)
    fitted = M.tabular_pipeline(NUMERIC, TEXT).fit(rows)
    fitted.write().overwrite().save(pipe)
    LogisticRegression(maxIter=10).fit(fitted.transform(rows)).write().overwrite().save(model)
    return pipe, model


@query("batch_score")
def batch_score(t):
    pipe, model = _saved_models(t)
    return rounded(O.batch_score(order_table(t), pipe, model).select("o_orderkey", "prediction", "score"), 6)


@query("champion_challenger")
def champion_challenger(t):
    """A weak first model is promoted, then a better one replaces it, then the same loses."""
    train, test = line_split(t, "l_orderkey")
    root = scratch_path(t.spark, "registry")
    early = train.filter(hash_percent(F.col("l_orderkey")) < 40).withColumn(
        "label", F.when(F.col("label") == 1, 0.0).otherwise(1.0)
    )
    rounds = [
        O.champion_challenger(test, new, f"{root}/production", f"{root}/candidates").withColumn("round", F.lit(i))
        for i, new in enumerate([early, train, early])
    ]
    return rounded(rounds[0].unionByName(rounds[1]).unionByName(rounds[2]))


@query(
    "config_profile",
    f"""
    WITH {DIRTY_ORDERS}, s AS (
      SELECT 'clean' AS stage, count(*) AS rows FROM dirty_orders
        WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
      UNION ALL SELECT 'summary', count(DISTINCT o_custkey) FROM orders
      UNION ALL SELECT 'anomaly', count(*) FROM events WHERE value > (SELECT avg(value) + 3 * stddev_samp(value) FROM events))
    SELECT config, stage, rows, true AS timed, CAST(1 AS DOUBLE) AS shares FROM s, (VALUES ('few partitions'), ('more partitions')) c(config)
    """,
)
def config_profile(t):
    stages = {
        "clean": lambda: t.dirty_orders.dropna(),
        "summary": lambda: customer_summary(t.orders, t.order_items, ITEM_SCHEMA),
        "anomaly": lambda: zscore_outliers(t.events, "value"),
    }
    configs = {
        "few partitions": {"spark.sql.shuffle.partitions": "4"},
        "more partitions": {"spark.sql.shuffle.partitions": "16"},
    }
    found = O.config_profile(t.spark, stages, configs)
    shares = F.round(F.sum("share").over(Window.partitionBy("config")), 6)
    return found.select("config", "stage", "rows", (F.col("seconds") > 0).alias("timed"), shares.alias("shares"))


# -- streams ---------------------------------------------------------------


def event_stream(t):
    return jobs.file_stream(t.spark, f"{t.sf_dir}/events.parquet", t.events.schema)


@query("stream_psi_drift", PSI_SQL)
def stream_psi_drift(t):
    ref, _ = halves(t)
    incoming = event_stream(t).filter(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")).select(
        "value", F.get_json_object("props", "$.k").cast("double").alias("k")
    )
    cols = ["value", "k"]
    counts = jobs.stream_psi_drift(
        ref, incoming, cols, scratch_path(t.spark, "psi_counts"), scratch_path(t.spark, "psi_log")
    )
    return rounded(jobs.psi_of_batches(ref, counts, cols), 6)


@query("stream_score")
def stream_score(t):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegressionModel

    pipe, model = _saved_models(t)
    prep, lr = PipelineModel.load(pipe), LogisticRegressionModel.load(model)
    rows = jobs.file_stream(t.spark, f"{t.sf_dir}/orders.parquet", t.orders.schema)

    def score(df):
        return M.class_probability(lr.transform(prep.transform(df))).select("o_orderkey", "prediction", "score")

    out = jobs.stream_score(rows, score, scratch_path(t.spark, "scores"), scratch_path(t.spark, "score_log"))
    return rounded(out, 6)
