import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from corpus import SCHEMA, rows, table, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import catalog
from tablewright.llm import periodic_runs as P


def brute(items, length, exponent):
    """Runs straight from the definition: for each period the maximal stretches, of smallest period only."""
    n, out = len(items), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if items[i] != items[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and items[j] == items[j + q]:
                j += 1
            size = j + q - i
            smaller = any(all(items[x] == items[x + p] for x in range(i, i + size - p)) for p in range(1, q))
            if size >= max(length, exponent * q) and not smaller:
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(items, length, exponent):
    return P.find_runs(list(items), np.array([0, len(items)]), length, exponent)


@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 3), st.integers(2, 9))
@settings(max_examples=400, deadline=None)
def test_runs_by_definition(items, exponent, length):
    assert found(items, length, exponent) == brute(items, length, exponent)


@pytest.mark.parametrize("seed", range(30))
def test_planted_runs(seed):
    rng = random.Random(seed)
    items = []
    for _ in range(6):
        unit = [rng.randint(0, 3) for _ in range(rng.randint(1, 9))]
        items += (unit * rng.randint(1, 12))[: rng.randint(1, 80)] + [rng.randint(0, 3) for _ in range(rng.randint(0, 5))]
    for length, exponent in ((24, 3), (5, 2), (1, 2)):
        assert found(items, length, exponent) == brute(items, length, exponent)


def test_words_that_strain_hashes_and_classes():
    fib, thue = [0], [0]
    while len(fib) < 200:
        fib = fib + fib[: len(fib) * 2 // 3] if len(fib) > 3 else [0, 1, 0, 0, 1][: len(fib) + 1]
    while len(thue) < 512:
        thue += [1 - x for x in thue]
    assert found(thue, 2, 3) == []  # a Thue-Morse word has no cube
    assert found(fib[:200], 4, 2) == brute(fib[:200], 4, 2)
    assert found([7] * 50_000, 24, 3) == [(0, 50_000, 1)]


def test_rows_do_not_mix():
    texts = [[b"a"] * 30, [b"a"] * 10, [], [b"a", b"b"] * 12, [b"b"]]
    assert P.runs_of_texts(texts, 24, 3) == [[(0, 30, 1)], [], [], [(0, 24, 2)], []]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(doc_id, text):
    own = words(text, lower=False)
    h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(own)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]
    runs = brute(own, 24, 3)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    one = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *one, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(own) if i not in gone)))


def test_query_is_the_definition(spark, tmp_path):
    rng = random.Random(5)
    data = [r for r in rows(150) if len(r[1] or "") < 3000]
    data += [(1000 + i, " ".join(rng.choice("ab") for _ in range(200)), None, None, None, None, None) for i in range(40)]
    data += [(2000, "p q r " * 30 + "s\n" + "p q r " * 30, None, None, None, None, None)]
    table(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(r[0], r[1]) for r in data), key=str)
    assert sum(r.n_runs > 0 for r in got) > 10


def test_spans_text_and_clashing_names(spark):
    docs = spark.createDataFrame([("x", "a b c " * 20 + "end", 3), (None, None, 4)], "runs string, text string, n_runs int")
    got = P.periodic_runs(docs.withColumnRenamed("n_runs", "_key"), keep=("runs", "_key"), spans=False, collapsed=True).collect()
    by = {r["_key"]: r for r in got}
    assert by[3].collapsed == "a b c end" and (by[3].start, by[3].length, by[3].period, by[3].exponent_milli) == (0, 60, 3, 20000)
    assert by[4].collapsed == "" and by[4].n_runs == 0 and by[4].start is None
    listed = P.periodic_runs(docs.select("text"), keep=(), spans=True).collect()
    assert sorted([tuple(s) for s in r.runs] for r in listed) == [[], [(0, 60, 3)]]
    assert P.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
