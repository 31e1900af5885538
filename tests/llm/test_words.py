import numpy as np
import pyarrow as pa
from corpus import rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import words as W


def _spans(column, find):
    data, offsets = W.buffers(column)
    starts, ends, first = find(data, offsets)
    raw = data.tobytes()
    return [[raw[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]


def test_words_and_lines():
    own = [r[1] for r in rows()] + ["a\n\n b\n \nc", "\n", "x"]
    column = pa.array(own)
    assert _spans(column, W.word_spans) == [words(t, False) for t in own]
    assert _spans(column, W.line_spans) == [[x for x in (t or "").split("\n") if words(x)] for t in own]
    assert _spans(column.slice(3, 5), W.word_spans) == [words(t, False) for t in own[3:8]]


@given(st.lists(st.text(alphabet="ab \n\té", max_size=12), max_size=8))
@settings(max_examples=60, deadline=None)
def test_hashes_follow_words(own):
    hashes, first = W.word_hashes(pa.array(own, pa.string()))
    seen = [w for t in own for w in words(t)]
    assert len(seen) == len(hashes) and list(np.diff(first)) == [len(words(t)) for t in own]
    by = {}
    for w, h in zip(seen, hashes.tolist()):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_windows_do_not_matter(monkeypatch):
    column = pa.array([r[1] for r in rows()])
    whole, _ = W.word_hashes(column)
    monkeypatch.setattr(W, "WINDOW", 7)
    small, _ = W.word_hashes(column)
    assert (whole == small).all()


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"t": [r[1] for r in rows()]})
    parts = list(W.slices(batch, "t", 500))
    assert len(parts) > 5 and [x for p in parts for x in p["t"].to_pylist()] == batch["t"].to_pylist()
    assert list(W.slices(batch.slice(0, 0), "t")) == []
