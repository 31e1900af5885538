from pyspark.sql import functions as F

from tablewright.llm import sieve


def split(spark, keys, rows, kind):
    keys, rows = spark.createDataFrame(keys, f"k {kind}"), spark.createDataFrame(rows, f"k {kind}, page string")
    found, rest = sieve.Sieve(keys, "k").split(rows, "k")
    assert found.columns == rest.columns == ["k", "page"]
    return found.collect(), rest.collect()


def test_no_key_is_missed(spark):
    keys = [(i * 3,) for i in range(9000)]
    found, rest = split(spark, keys, [(i, "text") for i in range(30000)], "long")
    assert len(found) + len(rest) == 30000
    assert {i for i, in keys} <= {r.k for r in found}
    assert 0 < len(found) - 9000 < 21000 * 0.12  # 16 bits a key: about a seventeenth passes without need


def test_keys_of_two_fields_nulls_and_repeats(spark):
    rows = [((1, 2), "a"), ((1, 2), "a"), ((2, 1), "b"), (None, None)]
    found, rest = split(spark, [((1, 2),), ((1, 2),)], rows, "struct<a: long, b: long>")
    assert [tuple(r.k) for r in found] == [(1, 2)] * 2 and len(rest) == 2


def test_empty_tables(spark):
    assert split(spark, [], [(1, "a")], "long") == ([], [(1, "a")])
    assert split(spark, [(1,)], [], "long") == ([], [])


def test_full_pages_let_all_pass(spark, monkeypatch):
    monkeypatch.setattr(sieve, "PAGES", 1)
    keys = spark.range(2_000_000).withColumnRenamed("id", "k")
    found, rest = sieve.Sieve(keys, "k").split(spark.range(5000).select((-F.col("id")).alias("k")), "k")
    assert found.count() == 5000 and rest.isEmpty()
