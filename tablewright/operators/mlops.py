"""Preparation, batch scoring, champion and challenger, configuration profiles."""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.evaluate import auc_roc
from tablewright.operators.project import case_bucket, flag_known
from tablewright.operators.quality import impute_group_stat, mode_scalar
from tablewright.operators.skew import held
from tablewright.operators.trees import class_probability
from tablewright.session import small_table


def tabular_prep(
    df: DataFrame,
    *,
    price: str,
    price_groups: Sequence[str],
    category: str,
    groups: Mapping[str, Sequence[str]],
    parts: Sequence[str],
) -> DataFrame:
    """Impute a number by group median and a category by mode, flag what was known, group
    rare categories, add the size of the parts and whether there is only one."""
    flagged = df.withColumn(f"{price}_known", flag_known(price))
    filled = impute_group_stat(flagged, price, price_groups, "median")
    filled = filled.withColumn(category, F.coalesce(category, mode_scalar(df, category)))
    size = F.lit(1)
    for p in parts:
        size = size + F.col(p)
    return filled.withColumn(f"{category}_group", case_bucket(F.col(category), groups, "other")).withColumns(
        {"size": size, "alone": F.when(size == 1, 1).otherwise(0)}
    )


def batch_score(df: DataFrame, pipeline_path: str, model_path: str) -> DataFrame:
    """Saved preprocessing and saved model over rows: class and probability."""
    ready = PipelineModel.load(pipeline_path).transform(df)
    pred = LogisticRegressionModel.load(model_path).transform(ready)
    return class_probability(pred).select(*df.columns, "prediction", "score")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _auc(model, df: DataFrame) -> float:
    scored = class_probability(model.transform(df)).select("label", "score")
    return auc_roc(scored, "score", F.col("label") == 1).first()["auc"]


def champion_challenger(ref: DataFrame, new: DataFrame, production: str, candidates: str) -> DataFrame:
    """(champion_auc, challenger_auc, promoted): fit on new rows, compare on the reference,
    keep a time-stamped copy and replace production only if better."""
    spark = ref.sparkSession
    with held(new) as data:
        challenger = LogisticRegression(maxIter=50).fit(data)
    current = -1.0
    with held(ref) as data:
        score = _auc(challenger, data)
        if path_exists(spark, production):
            current = _auc(LogisticRegressionModel.load(production), data)
    promoted = score > current
    if promoted:
        stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
        challenger.write().save(f"{candidates}/model_{stamp}")
        challenger.write().overwrite().save(production)
    return small_table(
        spark, [(float(current), float(score), int(promoted))], "champion_auc double, challenger_auc double, promoted int"
    )


def config_profile(
    spark: SparkSession, stages: Mapping[str, Callable[[], DataFrame]], configs: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """(config, stage, rows, seconds, share): each stage run under each set of session settings.

    Settings are put back afterwards, also when a stage fails. The timed run feeds every row and
    column to a sink that drops them; rows are counted by a second run outside the time (an observed
    metric would stay with the session, and models with a training summary no longer serialise then).
    """
    out = []
    for name, conf in configs.items():
        old = {k: spark.conf.get(k, None) for k in conf}
        times = []
        try:
            for k, v in conf.items():
                spark.conf.set(k, v)
            for stage, build in stages.items():
                rows = build()
                t0 = time.perf_counter()
                rows.write.format("noop").mode("overwrite").save()
                taken = time.perf_counter() - t0
                times.append((stage, rows.count(), taken))
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        total = sum(x[2] for x in times)
        out += [(name, s, int(n), float(t), float(t / total)) for s, n, t in times]
    return small_table(spark, out, "config string, stage string, rows long, seconds double, share double")
