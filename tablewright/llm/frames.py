"""Passing whole rows through Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm import words as W


def fresh(columns: Sequence[str], base: str) -> str:
    """A name that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def add_columns(
    df: DataFrame, text: str, added: Sequence[tuple[str, str]], compute: Callable[[pa.Array], Sequence[pa.Array]], limit: int = 1 << 22
) -> DataFrame:
    """Append columns that ``compute`` derives from the text column, slice by slice.

    All other columns pass through unchanged. A column that has the name of an added one
    is replaced by it.
    """
    names = {n.lower() for n, _ in added}
    fields = [f for f in df.schema.fields if f.name.lower() not in names]
    passed = [F.col(f"`{f.name}`") for f in fields]
    whole = any(f.name == text and f.dataType == T.StringType() for f in fields)
    held = text if whole else fresh(df.columns, "_text")
    rows = df.select(*passed) if whole else df.select(*passed, F.col(f"`{text}`").cast("string").alias(held))
    out = [f.name for f in fields] + [n for n, _ in added]

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, held, limit):
                arrays = [part.column(i) for i in range(len(fields))]
                yield pa.RecordBatch.from_arrays([*arrays, *compute(part.column(held))], names=out)

    schema = T.StructType(fields + [T.StructField(n, T._parse_datatype_string(k)) for n, k in added])
    return rows.mapInArrow(run, schema)


def text_of(column: str) -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
