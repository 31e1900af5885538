"""Hot keys and thin inputs."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tablewright.operators.joins import null_safe_join, small_enough
from tablewright.session import pin_small

CHUNK = 10_000
PART_ROWS = 500_000  # rows that one task of a fit holds at most


def deal_hot_keys(
    df: DataFrame, keys: Sequence[str], spread: Sequence[str], chunk: int = CHUNK, out: str = "part"
) -> DataFrame:
    """Number parts 0, 1, ... within keys of more than ``chunk`` rows; all other rows are part 0.

    Rows of a hot key are dealt by a hash of the ``spread`` columns, so grouping on
    keys and part puts about ``chunk`` rows into one group, whatever the key. Hot
    keys come from a count with map-side combine; there are at most rows / chunk.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > chunk)
    hot = pin_small(counts.select(*keys, F.ceil(F.col("_n") / chunk).alias("_parts")))
    if hot.isEmpty():
        return df.withColumn(out, F.lit(0).cast("long"))
    side = F.broadcast(hot) if small_enough(hot) else hot
    part = F.pmod(F.xxhash64(*spread), F.coalesce("_parts", F.lit(1).cast("long")))
    return null_safe_join(df, side, keys, "left").withColumn(out, part).drop("_parts")


def bounded_parts(df: DataFrame, times: int = 1) -> int | None:
    """How many partitions keep a task at ``PART_ROWS`` rows, each of them made into ``times`` rows; None if the session's number does."""
    needed = -(-df.count() * times // PART_ROWS)
    return needed if needed > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def in_pages(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = CHUNK, out: str = "page", parts: int | None = None
) -> DataFrame:
    """Number pages 0, 1, ... of ``size`` rows within each key, in the given (unique) order.

    A key of up to ``size`` rows is page 0 as it stands; the rows of larger ones are
    numbered over range partitions, so a key of any length is cut the same way. With ``parts``
    keys are counted in that many partitions, and the rows come dealt to as many, a page in one.
    """
    from tablewright.operators.ordering import dense_index

    counted = df.select(*keys).repartition(parts, *keys) if parts else df
    counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > size)
    hot = pin_small(counts.select(*keys, F.lit(True).alias("_long")))
    if hot.isEmpty():
        return (df.repartition(parts, *keys) if parts else df).withColumn(out, F.lit(0).cast("long"))
    side = F.broadcast(hot) if small_enough(hot) else hot
    marked = null_safe_join(df, side, keys, "left")
    short = marked.filter(F.col("_long").isNull()).drop("_long").withColumn(out, F.lit(0).cast("long"))
    numbered = dense_index(marked.filter("_long").drop("_long"), keys, order, "_index")
    paged = short.unionByName(numbered.withColumn(out, F.floor(F.col("_index") / size).cast("long")).drop("_index"))
    return paged.repartition(parts, *keys, out) if parts else paged


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the statistics of their key, where ``stats`` has one row per key.

    The statistics are written once and counted. Few enough are broadcast, so the
    rows stay where they are and a hot key does no harm; otherwise both sides are
    shuffled, and adaptive execution splits a hot key's partition.
    """
    fixed = pin_small(stats)
    side = F.broadcast(fixed) if small_enough(fixed) else fixed
    return null_safe_join(df, side, keys, how)


def spread_out(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Deal rows by a hash of all plain columns (of vectors, if there are no others) before a fit that reads them many times, so a
    table in one small file uses all tasks. ``parts`` fixes the number of partitions, which
    seeded forests and boosting depend on; without it the session's setting holds, or as many as
    keep a partition at ``PART_ROWS`` rows if that is more, so that a task's share does not grow with the table.
    """
    if parts is None:
        parts = bounded_parts(df)
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (VectorUDT, MapType))]
    vectors = [vector_to_array(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    by = F.xxhash64(*(plain or vectors))
    return df.repartition(by) if parts is None else df.repartition(parts, by)


@contextmanager
def held(*tables: DataFrame):
    """Keep tables in memory (or on local disk) while a fit reads them several times."""
    kept = [t.persist(StorageLevel.MEMORY_AND_DISK) for t in tables]
    try:
        yield kept[0] if len(kept) == 1 else kept
    finally:
        for t in kept:
            t.unpersist()
