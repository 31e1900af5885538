import hashlib
import random
import zlib

import pytest
from corpus import words
from oracle import compare, duck

from tablewright.llm import catalog
from tablewright.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, d string, conv int, K1 double"


def ordered(data):
    convs = {}
    for c, turn, role, text, *_ in data:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(rows)] for c, rows in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends, kids = {}, {}, {}
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
        ends.setdefault(tuple(own), []).append(c)
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(node, [])]
        saved = (len(members[node]) - 1) * len(words(node[-1][1])) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])), *sums[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def made(seed, convs=120, texts=4, most=9):
    rng = random.Random(seed)
    data = []
    for c in rng.sample(range(convs * 2), convs):
        for t in range(rng.randint(1, most)):
            data.append((c, rng.choice([t, t, t, None, t // 2]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "hi  there", "a\tb c", "ok"][:texts]), "x", 1, 0.5))
    return data + data[:5] + [(None, 1, "user", "of none", "x", 1, 0.5)]


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def same(got, want):
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.parametrize("band", [2, 3, 16])
def test_bands_give_the_sums_of_the_whole(spark, band):
    data = made(1) + [(5000 + c, t, "user", f"long {t} of many" if t < 30 else f"own {c}", "x", 1, 0.5) for c in range(3) for t in range(37)]
    convs = ordered(data)
    same(P.prefix_trie(table(spark, data), band=band).collect(), brute(convs))


def test_query(spark, tmp_path):
    data = made(2) + [(c, 0, "user", "the same", "x", 1, 0.5) for c in range(1000, 1300)] + [(20_001, 0, "user", "lost", "x", 1, 0.5)]
    assert any(not own for own in rebuilt(ordered(data)).values())
    table(spark, data).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    got = catalog.op12_prefix_trie(spark, str(tmp_path))
    assert all(kind == "bigint" for name, kind in got.dtypes if name != "ends_sha256")
    same(got.collect(), brute(rebuilt(ordered(data))))


def test_many_ends_and_children(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 20)
    monkeypatch.setattr(P, "in_pages", lambda df, keys, order: __import__("tablewright.operators.skew", fromlist=["x"]).in_pages(df, keys, order, 7))
    data = [(c, 0, "user", "one", "x", 1, 0.5) for c in range(60)] + [(100 + c, t, "user", f"{'two' if t == 0 else c}", "x", 1, 0.5) for c in range(50) for t in range(2)]
    same(P.prefix_trie(table(spark, data)).collect(), brute(ordered(data)))


def test_order_and_place_of_turns_matter(spark):
    data = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "b"), (2, 1, "u", "a"), (3, 0, "ua", ""), (4, 0, "u", "a")]
    data = [(*r, "x", 1, 0.5) for r in data]
    same(P.prefix_trie(table(spark, data)).collect(), brute(ordered(data)))


def test_no_conversations(spark):
    assert P.prefix_trie(table(spark, [])).collect() == []
    assert P.prefix_trie(table(spark, [(None, 1, "u", "a", "x", 1, 0.5)])).collect() == []


def test_sql(spark, sf_dir):
    assert compare(spark, duck(sf_dir), "op12_prefix_trie", catalog.op12_prefix_trie, catalog.ORACLES["op12_prefix_trie"], sf_dir) is None
