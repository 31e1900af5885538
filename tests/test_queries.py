"""Every registered query beside its SQL; those without SQL must give rows."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 200


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir) is None


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 50 and df.columns[0] == "o_custkey"
