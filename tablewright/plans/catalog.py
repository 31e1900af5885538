"""All registered queries."""

import importlib

from tablewright.plans.registry import ORACLES, QUERIES

MODULES = ["scans", "projections", "relational", "cleaning", "metrics", "timeseries", "process", "learning", "operations"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"tablewright.plans.{name}")


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(ORACLES)
