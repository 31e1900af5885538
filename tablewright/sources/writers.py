"""Writers. Each returns the path, so a read can follow."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """CSV with header, embedded quotes doubled, spaces kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_json_report(df: DataFrame, path: str) -> str:
    """One JSON object per row; made for long-form (column, metric, value) reports."""
    df.write.mode("overwrite").json(path)
    return path
