"""Projections, filters, recodes and conversions. All narrow: no shuffle."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import small_table


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def column_slice(df: DataFrame, first: str, last: str) -> DataFrame:
    """All columns from ``first`` to ``last``, both included."""
    names = df.columns
    return df.select(*names[names.index(first) : names.index(last) + 1])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop those of ``cols`` that are present."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[re.sub(r"\W+", "_", c.strip().lower()) for c in df.columns])


def filter_predicate(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(condition)


def range_filter(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows within the bounds; rows without a value stay."""
    return df.filter(F.col(col).isNull() | F.col(col).between(lo, hi))


def range_violations(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """How many rows lie outside the bounds."""
    outside = ~F.col(col).between(lo, hi)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(outside).alias("n_outside"))


def isin_filter(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def type_class(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, T.StringType):
        return "string"
    return "other"


def types_split(df: DataFrame) -> DataFrame:
    """(column_name, type_class) from the schema alone; reads no rows."""
    rows = [(f.name, type_class(f.dataType)) for f in df.schema.fields]
    return small_table(df.sparkSession, rows, "column_name string, type_class string")


def clean_currency(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """'$1,234.50' -> 1234.5; unreadable text -> NULL."""
    return df.withColumn(out or col, F.regexp_replace(col, r"[$,]", "").try_cast("double"))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast; values that do not convert become NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def case_bucket(value: Column, groups: Mapping[str, Sequence], default: str) -> Column:
    """Group label of a value; ``groups`` is label -> members."""
    out = None
    for label, members in groups.items():
        hit = value.isin(list(members))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def flag_known(col: str) -> Column:
    return F.when(F.col(col).isNull(), 0).otherwise(1)


def map_values(value: Column, mapping: Mapping, null_code) -> Column:
    """Recode by a constant map; NULL and unlisted values get ``null_code``."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(null_code))


def bin_numeric(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open range (edges[i], edges[i+1]]; NULL outside."""
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        hit = (value > lo) & (value <= hi)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


# Words that mark a loop as affected. The list as first written
# joined two phrases by a missing comma; here they are apart.
LOOP_KEYWORDS = [
    "yes",
    "high",
    "oscillat",
    "noise",
    "sticky",
    "bad",
    "oscillatory",
    "yes, long oscillation",
    "oscillating sp",
    "variance high",
    "yes + high variance",
    "yes (intermittent)",
    "ripples",
    "disturbance",
    "instability",
    "highly oscillatory",
    "yes , long oscillation",
    "yes. oscillatory",
    "highly intermittenly oscillatory",
]


def keyword_flag(col: str, words: Sequence[str] = LOOP_KEYWORDS) -> Column:
    """1 if the text holds any of the words, whatever the case; NULL -> 0."""
    pattern = "|".join(re.escape(w.lower()) for w in words)
    return F.coalesce(F.lower(F.trim(col)).rlike(pattern), F.lit(False)).cast("int")


def text_normalize(col: str) -> Column:
    """Lower case, trimmed, inner spaces as underscores."""
    return F.regexp_replace(F.lower(F.trim(col)), " ", "_")
