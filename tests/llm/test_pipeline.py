import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and result of every stage over the documents with odd rows and columns added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("mine")).withColumn("size", F.lit(1))
    odd = [(-1, None), (-2, ""), (-3, "123 !!"), (-4, "\n\n")]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True).unionByName(docs.limit(1).withColumn("doc_id", F.lit(10**6).cast("long")))
    out = []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF).checkpoint()
        out.append((name, docs, result))
        docs = result
    return out


def test_columns_and_rows(steps):
    assert [s[0] for s in steps] == ["language", "quality", "near_dedup", "source_mix", "sequences"]
    for name, docs, result in steps[:-1]:
        assert result.columns == docs.columns and result.schema == docs.schema
        assert result.select("score").filter("score <> 'mine'").isEmpty()
        if name != "source_mix":
            assert result.count() == result.join(docs.select("doc_id"), "doc_id", "left_semi").count() <= docs.count()


def test_decisions(steps, spark):
    ids = [{r.doc_id for r in result.select("doc_id").collect()} for _, _, result in steps]
    assert not ids[0] & {-1, -2, -3, -4} and 10**6 in ids[1] and 10**6 not in ids[2]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i in ids[0] if labels.get(i) == 1]
    assert sum(i in ids[1] for i in good) >= 0.97 * len(good)
    assert sum(i in ids[1] for i in ids[0] if labels.get(i) == 0) <= 2
    assert ids[4] == ids[3]


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.isEmpty()


def test_near_dedup_of_repeated_and_missing_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars > 200").limit(40).checkpoint()
    once = corpus_pipeline.near_dedup(spark, docs, SF).checkpoint()
    nameless = docs.withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    twice = corpus_pipeline.near_dedup(spark, nameless.unionByName(docs).unionByName(docs), SF).checkpoint()
    assert sorted(r.doc_id for r in twice.collect()) == sorted(r.doc_id for r in once.collect())
    alone = corpus_pipeline.near_dedup(spark, nameless.unionByName(nameless), SF)
    assert alone.count() == once.count()
    words = " ".join(f"w{i}" for i in range(50))
    other = docs.limit(1).drop("doc_id", "text").crossJoin(spark.createDataFrame([(7, words), (7, words.upper()), (7, words.replace("w", "x"))], "doc_id long, text string"))
    kept = corpus_pipeline.near_dedup(spark, other.select(*docs.columns), SF).collect()
    assert sorted(r.text[0].lower() for r in kept) == ["w", "x"] and {r.doc_id for r in kept} == {7}


def test_near_dedup_of_files(spark, tmp_path):
    """Rows named by their place in a file give what numbered rows give, repeated and nameless ones too."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    nameless = docs.limit(30).withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    path = f"{tmp_path}/docs"
    docs.unionByName(docs.limit(20)).unionByName(nameless).withColumn("_metadata", F.lit("own")).withColumn("row", F.lit(1)).repartition(3).write.parquet(path)
    read = spark.read.parquet(path)
    by_place = corpus_pipeline.near_dedup(spark, read, SF)
    by_number = corpus_pipeline.near_dedup(spark, read.checkpoint(), SF)
    assert by_place.columns == read.columns and "_metadata" in by_place.columns
    assert sorted(map(str, by_place.collect())) == sorted(map(str, by_number.collect()))


def test_run_leaves_stage_results_only(spark):
    from tablewright.session import scratch_scope

    with scratch_scope(spark) as folder:
        got = corpus_pipeline.run(spark, SF)
        assert got.count() > 100 and "sequence_id" in got.columns
        left = {p.rsplit("-", 1)[0] for p in os.listdir(folder)}
        assert left == {f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES}
