"""What the classifiers learn from: repeated rows, long texts, and fits done plainly."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import crf_quality, langid

WORDS = "the river ran past old stone walls and small green fields while people walked home".split()


def sentence(i):
    return " ".join(WORDS[(i * 7 + j * (1 + i % 5)) % len(WORDS)] for j in range(8 + i % 5)) + "."


def corpus(n=60):
    """(doc_id, text, quality): even ids are prose, odd ones are noise."""
    return [
        (i, "\n".join(sentence(i + j) if i % 2 == 0 else f"$$ {j} || %% {i} ## <> !! {j * i}" for j in range(1 + i % 4)), 1 - i % 2)
        for i in range(n)
    ]


def quality_model(spark, rows, **kw):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame(sorted({(r[0], r[2]) for r in rows}), "doc_id long, quality int")
    return crf_quality.train(docs, labels, F.lit(True), **kw)


def same(a, b):
    return np.array_equal(a.weights, b.weights) and np.array_equal(a.step, b.step) and a.prior == b.prior


def test_quality_learns_once_from_rows_that_repeat(spark):
    rows = corpus()
    assert same(quality_model(spark, rows), quality_model(spark, rows + [rows[3]] * 3_000))
    # Of two texts under one id one is taken, the same one whatever the order of the rows.
    other = (3, "another text under the same id", 0)
    assert same(quality_model(spark, rows + [other]), quality_model(spark, [other] + rows[::-1]))


def test_quality_bounds_on_lines(spark, monkeypatch):
    met = []
    fit = crf_quality.fit
    monkeypatch.setattr(crf_quality, "fit", lambda x, first, y: met.append((len(x), len(first) - 1)) or fit(x, first, y))
    rows = corpus()
    total = sum(1 + i % 4 for i in range(60))
    quality_model(spark, rows)
    quality_model(spark, rows + [(100, "one more line\n" * 50_000, 1)])  # too long for the fit
    quality_model(spark, rows, lines=40)
    quality_model(spark, rows, sample=7)
    quality_model(spark, rows, lines=0)
    assert met[0] == met[1] == (total, 60)
    assert 36 <= met[2][0] <= 40 and met[3][1] == 7 and met[4] == (0, 0)


def test_quality_score_by_enumeration(spark):
    model = quality_model(spark, corpus())
    texts = [r[1] for r in corpus(12)] + ["one\n\n two \nthree four", "", None]
    got = model.score(pa.array(texts))
    for text, score in zip(texts, got):
        x, length, _ = crf_quality.line_features(pa.array([text], pa.string()))
        if not len(x):
            assert score == model.prior
            continue
        odds, total, good = model.odds(x), 0.0, np.zeros(len(x))
        for path in itertools.product((0, 1), repeat=len(x)):
            w = math.exp(sum(o * s for o, s in zip(odds, path)) + sum(model.step[a, b] for a, b in zip(path, path[1:])))
            total += w
            good += w * np.array(path)
        assert score == pytest.approx(float((good / total * length).sum() / length.sum()), abs=1e-9)


def test_language_sample_of_repeated_rows(spark, monkeypatch):
    """A text in most rows of a language is one draw; the others still fill the sample."""
    letters = {"aa": "abcde fghij", "bb": "vwxyz stuvw"}
    rows = [(f"{letters[lang][i % 11:]}{letters[lang][:i % 11]} {chr(97 + i % 26)}{chr(97 + i // 26)}", lang) for lang in letters for i in range(200)]
    met = []
    leader = langid.follow_leader
    monkeypatch.setattr(langid, "follow_leader", lambda data, k: met.append(data) or leader(data, k))
    hot = rows + [("abc " * 30, "aa")] * 5_000
    for part in (rows, hot, hot[::-1]):
        langid.train(spark.createDataFrame(part, "text string, lang string").repartition(6), per_language=100)
    counts = [[sum(r[2] == k for r in data) for k in (0, 1)] for data in met]
    for n in counts:
        assert all(40 <= v <= 120 for v in n)  # about 100 draws, a fifth of them held aside
    assert counts[1] == counts[2]
    assert all(np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]) for a, b in zip(met[1], met[2]))


def test_follow_leader_against_scalars():
    """The same recursion over dictionaries, one weight at a time."""
    rng = np.random.default_rng(5)
    data = [(np.sort(rng.choice(40, 4, replace=False)), rng.random(4) + 0.1, int(i % 3)) for i in range(30)]
    w, bias = langid.follow_leader(data, 3, epochs=2)
    z, n = {}, {}

    def weight(b, k):
        own, pen = z.get((b, k), 0.0), 0.0 if b == "bias" else langid.L1
        if abs(own) <= pen:
            return 0.0
        return -(own - math.copysign(pen, own)) / ((langid.BETA + math.sqrt(n.get((b, k), 0.0))) / langid.ALPHA + langid.L2)

    order = np.random.default_rng(7)
    for _ in range(2):
        for i in order.permutation(len(data)):
            bucket, value, label = data[i]
            terms = [*zip(bucket.tolist(), value.tolist()), ("bias", 1.0)]
            score = [sum(v * weight(b, k) for b, v in terms) for k in range(3)]
            e = [math.exp(s - max(score)) for s in score]
            old = {(b, k): weight(b, k) for b, _ in terms for k in range(3)}
            for k in range(3):
                for b, v in terms:
                    g = v * (e[k] / sum(e) - (k == label))
                    before = n.get((b, k), 0.0)
                    n[b, k] = before + g * g
                    z[b, k] = z.get((b, k), 0.0) + g - (math.sqrt(n[b, k]) - math.sqrt(before)) / langid.ALPHA * old[b, k]
    for b in range(40):
        assert np.allclose(w[b], [weight(b, k) for k in range(3)], atol=1e-9)
    assert np.allclose(bias, [weight("bias", k) for k in range(3)], atol=1e-9)
