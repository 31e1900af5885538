from collections import defaultdict

import pytest
from corpus import SCHEMA, rows, table, words

from tablewright.llm import mixing


def brute_targets(sizes):
    """Water-filling by hand; sources by code point, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        share = {s: rest * weight[s] / open_ for s in order if s not in full} if open_ else {}
        more = {s for s, t in share.items() if t > 2 * sizes[s]}
        if not more:
            return {s: 2 * sizes[s] if s in full else share[s] for s in order}
        full |= more


def check(spark, data, near=0.05):
    df = table(spark, data)
    got = mixing.mix(df).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert len(got) == len(data)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r, d in zip(sorted(got, key=key), sorted(data, key=key)):
        assert r.text == d[1] and r.source == d[3] and r.node == d[5]
        assert 0 <= r.taken <= 2 * len(words(d[1])) and r.taken == r.copies * len(words(d[1]))
        sizes[r.source] += len(words(d[1]))
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = brute_targets(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source]
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        smallest = min((len(words(d[1])) for d in data if d[3] == s and words(d[1])), default=0)
        assert abs(taken[s] - target[s]) <= max(near * target[s], smallest)
    assert sorted(map(str, mixing.mix(df.repartition(5)).collect())) == sorted(map(str, got))


def test_edge_rows(spark):
    check(spark, rows())


def test_many_sources_and_a_long_document(spark):
    data = [(i, " ".join(["w"] * (1 + i * i % 61)), None, f"s{i % 11}", None, None, None) for i in range(700)]
    data += [(9000, "w " * 4000, None, "s3", None, None, None), (9001, None, None, "only null", None, None, None)]
    check(spark, data, 0.01)


def test_hot_source(spark):
    data = [(i, " ".join(["w"] * (1 + i % 13)), None, "hot" if i % 3 else f"s{i % 4}", None, None, None) for i in range(400)]
    check(spark, data, 0.02)


def test_sources_of_equal_rows(spark):
    data = [(1, "w " * 10, None, "a", None, None, None)] * 1000 + [(2, "w " * 10, None, "b", None, None, None)] * 1000
    check(spark, data, 0)
    data += [(i, "w " * (1 + i % 7), None, "ab"[i % 2], None, None, None) for i in range(10, 300)] + [(None, None, None, "a", None, None, None)] * 5
    check(spark, data, 0.01)


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_words(spark):
    got = mixing.mix(table(spark, [(1, None, None, "a", None, None, None), (2, " ", None, None, None, None, None)])).collect()
    assert [(r.source_size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_native_plan(spark, capsys):
    mixing.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_rates_follow_the_tilt(spark):
    """A source that is to shrink keeps short documents rather than long ones, all by one tilt."""
    data = [(i, " ".join(["w"] * (1 + i % 50)), None, f"s{i % 2}", None, None, None) for i in range(2000)]
    narrow = mixing.measured(table(spark, data), "text", "source", ["doc_id"]).select("_source", "_size", "_draw")
    state = {r["_source"]: r for r in mixing.plan(narrow, weights=(1, 9), share=0.6).collect()}
    assert state["s0"].tilt < 0
    import math

    sizes = [1 + i % 50 for i in range(0, 2000, 2)]
    mean = sum(sizes) / len(sizes)
    met = sum(x * min(2, math.exp(state["s0"].tilt * x / mean)) for x in sizes)
    assert met == pytest.approx(state["s0"].target, rel=1e-6)
