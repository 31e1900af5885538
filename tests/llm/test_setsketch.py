import random
from collections import Counter

import numpy as np
from corpus import SCHEMA, rows, table, texts, words

from tablewright.llm import setsketch
from tablewright.llm.graph import components


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(data):
    """doc_id -> component over all rows; rows of one id are one document."""
    ids = [r[0] for r in data if r[0] is not None]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(r[0], shingles(r[1])) for r in data if r[0] is not None]
    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def check(spark, data):
    out = setsketch.near_duplicates(table(spark, data)).collect()
    assert len(out) == len(data)
    want = brute(data)
    assert Counter((r.doc_id, r.n_shingles) for r in out) == Counter((r[0], len(shingles(r[1]))) for r in data)
    for r in out:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)


def near_copies(seed=1):
    rng = random.Random(seed)
    data = [list(r) for r in rows(30)]
    long = [t for t in texts(200, 8) if len(t.split()) > 60][:12]
    for base in long:
        words_ = base.split()
        for _ in range(rng.randint(2, 9)):
            w = list(words_)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(["zz", "yy", "xx"])
            data.append([len(data) + 500, " ".join(w), "az", "s1", 0.0, "n", 0])
        data.append([len(data) + 500, base, "az", "s1", 0.0, "n", 0])
    rng.shuffle(data)
    return [tuple(r) for r in data]


def test_against_brute_force(spark):
    check(spark, near_copies())


def test_many_copies_and_a_chain(spark):
    base = " ".join(f"w{i}" for i in range(80))
    data = [(i, base, None, None, None, None, None) for i in range(300)]
    chain = [f"c{i}" for i in range(60)]
    for i in range(20):  # each step changes two words at the end: ends of the chain are far apart
        data.append((1000 + i, " ".join(chain), None, None, None, None, None))
        chain = chain[2:] + [f"d{i}", f"e{i}"]
    check(spark, data)


def test_empty_table(spark):
    assert setsketch.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cells_cover_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "CELL", 3)
    monkeypatch.setattr(setsketch, "MEMBERS", 2)
    check(spark, near_copies(5))


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(x[:2500]), np.unique(x[500:])  # similarity 2000 / 3000
    ra, rb, both = setsketch.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(ra, rb) == both).all()
    est = setsketch.likely_similarity(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([2500.0]), np.array([2500.0]))[0]
    assert abs(est - 2 / 3) < 0.16
    assert (setsketch.registers([x[:3]]) > 0).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 8), (8, 7), (9, 9)] + [(100 + i, 101 + i) for i in range(50)] + [(200, 201 + i) for i in range(50)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got[3] == 1 and got[8] == 7 and 9 not in got and got[150] == 100 and got[250] == 200 and got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
