"""Arriving batches: drift of each against a fixed reference, and scoring as rows arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.drift import bin_counts, psi_from_counts, reference_edges


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Stream of parquet files: those of a folder, or one file picked out of its folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_file(spark, path):
        folder, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def stream_psi_drift(
    ref: DataFrame, incoming: DataFrame, cols: Sequence[str], out: str, checkpoint: str, bins: int = 10
) -> DataFrame:
    """Bin counts of every arriving batch under ``out``, then (batch_id, feature, psi, ...) per batch.

    A batch writes its counts to a folder of its own by overwrite, so a batch that
    is run again after a failure is not counted twice.
    """
    spark = ref.sparkSession
    edges = reference_edges(ref, cols, bins)

    def keep(batch: DataFrame, batch_id: int) -> None:
        bin_counts(batch, edges).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (
        incoming.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema("feature string, bin int, n long, batch_id long").parquet(out)


def psi_of_batches(ref: DataFrame, counts: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """PSI of all batches together, from their stored counts."""
    base = bin_counts(ref, reference_edges(ref, cols, bins))
    return psi_from_counts(base, counts.groupBy("feature", "bin").agg(F.sum("n").alias("n")))


def psi_per_batch(ref: DataFrame, counts: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """(batch_id, feature, psi) of each batch by itself."""
    eps = F.lit(1e-6)
    base = bin_counts(ref, reference_edges(ref, cols, bins))
    totals = base.groupBy("feature").agg(F.sum("n").alias("_t"))
    e = base.join(totals, "feature").select("feature", "bin", (F.col("n") / (F.col("_t") + eps)).alias("e"))
    got = counts.groupBy("batch_id", "feature").agg(F.sum("n").alias("_t"))
    a = counts.join(got, ["batch_id", "feature"]).withColumn("a", F.col("n") / (F.col("_t") + eps))
    term = (F.col("a") - F.col("e")) * F.log((F.col("a") + eps) / (F.col("e") + eps))
    return a.join(e, ["feature", "bin"]).groupBy("batch_id", "feature").agg(F.sum(term).alias("psi"))


def stream_score(incoming: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> DataFrame:
    """Score rows as they arrive into a parquet sink; the sink's log makes each batch count once."""
    (
        score(incoming)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return incoming.sparkSession.read.parquet(out)
