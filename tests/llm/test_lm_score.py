import math
from collections import Counter

import pytest
from corpus import SCHEMA, rows, table, words
from pyspark.sql import functions as F

from tablewright.llm import lm_score


def brute(data, learned):
    """The model, text by text, with dictionaries."""
    own = [words(r[1]) + [None] for r in data]
    uni, bi = Counter(), Counter()
    for w, yes in zip(own, learned):
        if yes:
            uni.update(w)
            bi.update(zip(["<s>", *w], w))
    n, v = sum(uni.values()), len(uni)
    once, twice = sum(c == 1 for c in uni.values()), sum(c == 2 for c in uni.values())
    cut = min(max(once / (once + 2 * twice), 0.1), 0.9) if once + twice else 0.5
    sums = [sum(c**g for c in uni.values()) for g in lm_score.POWERS]
    g = 1.0
    for k in range(40):
        if sums[k] <= len(bi) <= sums[k + 1]:
            g = lm_score.POWERS[k] + (len(bi) - sums[k]) / (sums[k + 1] - sums[k]) / 40
    if len(bi) < sums[0]:
        g = 0.0
    out = []
    for w in own:
        base = score = 0.0
        for u, x in zip(["<s>", *w], w):
            base += math.log10((uni[x] + 1) / (n + v + 1))
            p = (uni[x] - cut) / n if uni[x] else (cut * v / n if n else 1.0)
            c = uni[None] if u == "<s>" else uni[u]
            if c:
                p = (bi[u, x] + c**g * p) / (c + c**g)
            score += math.log10(p)
        out.append((len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def run(df, keep=("doc_id", "size"), **settings):
    found = lm_score.lm_scores(df, F.coalesce(F.col("doc_id"), F.lit(0)) % 7 != 2, keep=list(keep), **settings)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 300, "part_bytes": 200}])
def test_against_dictionaries(spark, settings):
    data = rows()
    want = brute(data, [(r[0] or 0) % 7 != 2 for r in data])
    want = sorted(((r[0], r[6], *w) for r, w in zip(data, want)), key=str)
    got = run(table(spark), **settings)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-7) and g[6] == pytest.approx(w[6], abs=1e-7)


def test_longer_contexts(spark):
    two, three = run(table(spark)), run(table(spark), order=3)
    assert sum(r[6] for r in three) > sum(r[6] for r in two)


def test_empty_table_and_nothing_learned(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    got = lm_score.lm_scores(table(spark), F.lit(None).cast("boolean")).collect()
    assert {r.train_tokens for r in got} == {0} and all(r.n_known == 0 and r.score == 0 for r in got)
