"""Name -> query and name -> SQL that must give the same rows."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""
    from tablewright.plans.bindings import Tables

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return register
