import numpy as np
import pyarrow as pa
import pytest
from corpus import SCHEMA, rows, table
from pyspark.sql import functions as F

from tablewright.llm import crf_quality, langid
from tablewright.llm.folds import fold, language_model, quality_model


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_language_held_out(spark, docs):
    model = language_model(docs)
    got = langid.predict(docs, model).filter(fold(4) == 2).select("lang", "lang_pred", "score").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()
    assert (model.table == 0).mean() > 0.5  # the penalty leaves most weights at zero


def test_language_edges(spark, docs):
    model = language_model(docs)
    data = rows()
    got = langid.predict(table(spark, data), model).collect()
    assert len(got) == len(data) and got[0].node == "n"
    for r in got:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and (r.score > 0) == lettered
    assert langid.predict(spark.createDataFrame([], SCHEMA), model).collect() == []
    nothing = langid.train(table(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(table(spark), nothing).collect()} == {"und"}
    one = langid.train(table(spark).withColumn("lang", F.lit("xx")))
    assert {r.lang_pred for r in langid.predict(table(spark), one).collect()} == {"und", "xx"}


def test_grams_stay_within_rows():
    a = [(b.tolist(), c.tolist()) for b, c in langid.term_counts(pa.array(["ab", None, "éß x", ""]))]
    b = [next((x.tolist(), y.tolist()) for x, y in langid.term_counts(pa.array([t], pa.string()))) for t in ("ab", None, "éß x", "")]
    assert a == b and a[1] == ([], [])


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_model(docs, labels)
    got = crf_quality.quality_scores(docs, model).join(labels, "doc_id").filter(fold(5) == 0).toPandas()
    good, bad = got[got.quality == 1].score, got[got.quality == 0].score
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean() > 0.95 and (good >= 0.3).mean() > 0.97
    again = quality_model(docs.repartition(7), labels)
    assert np.allclose(again.weights, model.weights)


def test_quality_edges(spark, docs):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (2, None), (None, 1), (3, 7), (4, 0), (6, 1)], "doc_id long, quality int")
    model = quality_model(table(spark), labels)
    got = crf_quality.quality_scores(table(spark), model).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if not (r.text or "").strip()} == {model.prior}
    assert crf_quality.quality_scores(spark.createDataFrame([], SCHEMA), model).collect() == []
    none = quality_model(table(spark), labels.filter("doc_id < 0"))
    assert {r.score for r in crf_quality.quality_scores(table(spark), none).collect()} == {0.5}


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    first = np.array([0, 3, 3, 4, 9])
    good, step = rng.normal(size=9), rng.normal(size=(2, 2))
    p, moves, logs = crf_quality.forward_backward(good, first, step)
    want, pairs, total = np.zeros(9), np.zeros((2, 2)), 0.0
    for a, b in zip(first, first[1:]):
        n, z, own, both = b - a, 0.0, np.zeros(b - a), np.zeros((2, 2))
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            w = np.exp(sum(good[a + i] for i in range(n) if y[i]) + sum(step[y[i], y[i + 1]] for i in range(n - 1)))
            z += w
            own += w * np.array(y)
            for i in range(n - 1):
                both[y[i], y[i + 1]] += w
        if n:
            want[a:b] = own / z
            pairs += both / z
            total += np.log(z)
    assert np.allclose(p, want) and np.allclose(moves, pairs) and np.isclose(logs.sum(), total)


def test_language_works_in_little_memory():
    """A task's temporaries are those of a slice, far below a batch's text times fifty."""
    import tracemalloc

    import pyarrow as pa

    from tablewright.llm import langid, words

    batch = pa.RecordBatch.from_pydict({"text": ["plain words and more of them " * 100] * 1500})  # 4 MB
    words.kept("folded", langid._folded)
    tracemalloc.start()
    for part in words.slices(batch, "text", langid.SLICE):
        points, first = langid.code_points(part.column("text"))
        list(langid.gram_buckets(points, first))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 << 20
