"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before kept.
All but the last return the columns of ``docs``. ``run`` writes each stage's result as Parquet
in the shared folder and reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import crf_quality, langid, mixing, packing, setsketch
from tablewright.llm.folds import ACCEPT, CONFIDENT, language_model, quality_model
from tablewright.llm.sieve import Sieve
from tablewright.session import pin, scratch_path, scratch_scope

# A trained model, hashes of sketches and token ids have no counterpart in SQL.
ORACLE_SQL = None


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator adds, and the name of each column there."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(found: DataFrame, names: dict[str, str]) -> DataFrame:
    return found.select(*[F.col(n).alias(c) for c, n in names.items()])


def _located(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``_plain`` with ``row``, which names each row alike in every read.

    Rows of Parquet files have a place, file and index, so nothing is written; other rows are
    numbered and written once.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = [F.col(f"`{c}`").alias(n) for c, n in names.items()]
    try:
        place = docs.metadataColumn("_metadata")
        file = F.xxhash64(place.getField("file_path")).alias("file")
        return docs.select(*own, F.struct(file, place.getField("row_index").alias("index")).alias("row")), names
    except AnalysisException:  # not read from Parquet files
        return pin(docs.select(*own, F.monotonically_increasing_id().alias("row"))), names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language: with a letter, and a confidence of at least even odds."""
    rows, names = _plain(docs)
    found = langid.predict(rows, language_model(docs), names["text"])
    return _back(found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= CONFIDENT)), names)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier takes for good."""
    model = quality_model(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    rows, names = _plain(docs)
    return _back(crf_quality.quality_scores(rows, model, names["text"]).filter(F.col("score") >= ACCEPT), names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one of the least doc_id. Every row counts by
    itself, so of rows that repeat a doc_id or have none those of like text are one group too."""
    rows, names = _located(docs)
    doc = F.col(names["doc_id"])
    found = setsketch.near_duplicates(rows, "row", names["text"]).select(F.col("doc_id").alias("row"), "component_id")
    named = found.join(rows.select("row", doc.isNull().alias("none"), doc.alias("doc")), "row")
    named = named.select(F.col("component_id").alias("group"), "none", "doc", "row")
    least = named.groupBy("group").agg(F.min(F.struct("none", "doc", "row")).getField("row").alias("row"))
    dropped = pin(named.select("row").join(least, "row", "left_anti"))
    # Only rows that may be among the dropped ones are sent to a join with their texts.
    doubted, clear = Sieve(dropped, "row").split(rows, "row")
    return _back(clear.unionByName(doubted.join(dropped, "row", "left_anti")), names)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows, names = _plain(docs)
    mixed = mixing.mix(rows, names["text"], names["source"], [names["doc_id"]])
    times = F.array_repeat(F.lit(True), F.col("copies").cast("int"))
    return _back(mixed.withColumn("copy", F.explode(times)), names)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences: one row a piece of a document."""
    return packing.pack(docs, added_tokens=True)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):  # what the stage has pinned goes once its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
