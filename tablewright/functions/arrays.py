"""Array, JSON, map, date and vector expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_items(col: str, schema: str) -> Column:
    return F.from_json(col, schema)


def keep_fields(col: Column, fields: Sequence[str]) -> Column:
    """Array of structs with only some of the fields."""
    return F.transform(col, lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences of two arrays, in double precision."""
    diffs = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + d * d)


def euclidean_distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))
