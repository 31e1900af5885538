"""Session settings, and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def get_session(app: str = "tablewright", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle partitions are left to the cluster's own setting and to adaptive
    execution; pass ``**{"spark.sql.shuffle.partitions": "8"}`` on one machine.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tablewright-")
    spark.sparkContext.setCheckpointDir(root)
    return root


_SCOPE: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared root, within the innermost open scope."""
    folder = _SCOPE[-1] if _SCOPE else f"{shared_root(spark).rstrip('/')}/tablewright"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession):
    """Pinned tables made inside go when the scope ends: write or collect results before that.

    Scopes are for a driver's own thread of work; without one, pins stay until the shared
    folder is cleared.
    """
    path = scratch_path(spark, "scope")
    _SCOPE.append(path)
    try:
        yield path
    finally:
        _SCOPE.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Used where a plan is read twice and must give the same rows both times (range
    partitions), and between rounds of an iteration. The rows live in the shared
    folder, so a lost executor costs a re-read only; as a parquet table they can be
    pruned, and the planner knows their size.
    """
    path = scratch_path(df.sparkSession, "pin")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_small(df: DataFrame) -> DataFrame:
    """The same for a few rows (statistics per key) that several plans read: a reliable
    checkpoint in the shared folder, with less set-up than a table."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A handful of driver-side rows as literals, without a Python worker."""
    schema = T._parse_datatype_string(ddl)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows
    ]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs)))
