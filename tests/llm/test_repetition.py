import numpy as np
import pyarrow as pa
from corpus import SCHEMA, rows, table, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import repetition


def longest_at(w, i):
    best = 0
    for j in range(len(w)):
        if j != i:
            k = 0
            while max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
    return best


def brute(text, shortest=repetition.SHORTEST):
    text = text or ""
    w = words(text, False)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    repeated = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    runs = [longest_at(w, i) for i in range(len(w))]
    covered = {i + k for i, n in enumerate(runs) if n >= shortest for k in range(n)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
        len(covered), max([n for n in runs if n >= shortest], default=0),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def measured(own):
    m = repetition.measures(pa.array(own, pa.string()))
    return list(zip(*(m[n].tolist() for n in NAMES)))


@given(st.lists(st.text(alphabet="ab#é \n", max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_measures(own):
    assert measured(own) == [brute(t) for t in own]


@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=4))
@settings(max_examples=150, deadline=None)
def test_suffix_array(data):
    items = np.array([x for r in data for x in r], np.uint64)
    first = np.concatenate([[0], np.cumsum([len(r) for r in data])]).astype(np.int64)
    order = repetition.suffix_array(items, first)
    want = [s + i for s, r in zip(first, data) for i in sorted(range(len(r)), key=lambda i: r[i:])]
    assert order.tolist() == want
    lcp = repetition.common_prefixes(items, first, order)
    for k in range(1, len(items)):
        a, b = order[k - 1], order[k]
        row = np.searchsorted(first, [a, b], side="right")
        n = 0
        while row[0] == row[1] and max(a, b) + n < first[row[0]] and items[a + n] == items[b + n]:
            n += 1
        assert lcp[k] == n


def test_rules(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    filler = " ".join(f"f{i}" for i in range(200))
    own = [filler, f"{passage} {filler} {passage}", f"{passage} {passage} x {passage}", "a b " * 100, f"{filler} {filler}", "few words", None]
    data = [(i, t, None, None, 0.0, None, 0) for i, t in enumerate(own)]
    got = {r.doc_id: r for r in repetition.repetition_rules(table(spark, data)).collect()}
    assert [got[i].kept for i in range(7)] == [True, True, False, False, False, False, False]
    assert got[4].longest_repeat == 200 and got[1].covered_words == 60 and got[0].node is None
    assert [got[i].base_failed for i in range(7)] == [False, False, True, True, True, True, True]


def test_edge_rows(spark):
    data = rows()
    got = repetition.repetition_rules(table(spark, data)).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    for r, d in zip(sorted(got, key=key), sorted(data, key=key)):
        if len(d[1] or "") < 3000:
            assert tuple(r[n] for n in NAMES) == brute(d[1])
        assert r.size == d[6]
    assert repetition.repetition_rules(spark.createDataFrame([], SCHEMA)).collect() == []
