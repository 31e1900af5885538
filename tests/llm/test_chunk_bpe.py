import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from corpus import SCHEMA, rows, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm import catalog
from tablewright.llm import chunk_bpe as C
from tablewright.llm.packing import default_vocabulary

REFERENCE = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
ENCODER = C.Encoder(default_vocabulary())


def want(text):
    return REFERENCE.encode(text, add_special_tokens=False).ids


def got(text, starts=None):
    data = text.encode()
    if starts is None:
        starts = C.cuts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
    return ENCODER.ids(data, starts)


PIECES = [
    "the ", "don't ", "'", "'s", "'ll", "'re", "r", "e", "ll", " ", "  ", "\n", " \n", "\t", "\r\n", "a", "Z", "7", "42", "!", "...", "é", "ß", "日本", "語。", "、",
    " ", "　", " ", "\x85", "\x1c", "᠎", "​", "😀", "👩‍👩", "́", "½", "٣", "ab" * 9, "\U00010400", "\U0001f9ff", "�", "\x00",
]
PIECED = st.lists(st.sampled_from(PIECES), max_size=40).map("".join)


@given(PIECED, st.data())
@settings(max_examples=1500, deadline=None)
def test_any_cuts_give_the_ids_of_the_whole(text, data):
    raw = text.encode()
    inner = [p for p in range(1, len(raw)) if raw[p] & 0xC0 != 0x80]
    starts = sorted(data.draw(st.sets(st.sampled_from(inner), max_size=12))) if inner else []
    assert got(text, [0, *starts, len(raw)]) == want(text)


@given(st.text(max_size=80), st.integers(1, 7))
@settings(max_examples=500, deadline=None)
def test_any_text(text, every):
    raw = text.encode()
    starts = [p for p in range(every, len(raw), every) if raw[p] & 0xC0 != 0x80]
    assert got(text, [0, *starts, len(raw)]) == want(text)


def test_every_character():
    """Code points (all of the assigned planes, some of the others) between letters, digits and
    blanks, cut before and behind them."""
    for low in (*range(0, 0x32400, 0x400), 0x32400, 0xE0000, 0xE0400, 0xF0000, 0x10FC00):
        chars = [chr(c) for c in range(low, low + 0x400) if not 0xD800 <= c < 0xE000]
        for form in ("a{}b", " {}1", "{}'s"):
            text = "".join(form.format(c) for c in chars)
            raw = text.encode()
            starts = [p for p in range(1, len(raw)) if raw[p] & 0xC0 != 0x80]
            if text and got(text, [0, *starts[:: 1 + low // 0x400 % 3], len(raw)]) != want(text):
                bad = [hex(ord(c)) for c in chars if got(form.format(c)) != want(form.format(c))]
                raise AssertionError(f"{form} {hex(low)} {bad}")


@pytest.mark.parametrize("char", [" ", "\n", "\t", "a", "'", "日", "7", "!", " \n", " ", "é "])
@pytest.mark.parametrize("n", [5_000, 150_000])
def test_long_runs(char, n):
    text = "start " + char * n + " end"
    assert got(text) == want(text)


def test_a_million_blanks():
    for text in (" " * 1_000_000, "\n" * ((1 << 20) - 1) + "x", " \t" * 400_000):
        ids = got(text)
        assert ENCODER.decode(np.array(ids)).decode() == text
        assert ids == want(text)


def test_added_tokens():
    text = "<|endoftext|>hello <|endoftext|> world<|endoftext|><|endoftext|" + "x y " * 600
    assert got(text) == want(text) and got(text).count(50256) == 3
    assert ENCODER.decode(np.array(got(text))).decode() == text == REFERENCE.decode(want(text), skip_special_tokens=False)


def test_shared_passages_are_cut_alike_and_encoded_once():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    shared = prose(4000)
    encoder = C.Encoder(default_vocabulary())
    texts = [prose(200 + i) + " " + shared + " " + prose(50) for i in range(8)]
    chunks = 0
    for t in texts:
        raw = t.encode()
        starts = C.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        chunks += len(starts) - 1
        assert encoder.ids(raw, starts) == want(t)
    assert encoder.encoded < chunks / 3
    small = C.Encoder(default_vocabulary(), store=20_000)
    for t in texts:
        raw = t.encode()
        assert small.ids(raw, C.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]) == want(t)
        assert small.held <= 10_000 + 9 * 8192 + 200 * 12


def test_rolling_hash_depends_on_its_window_only():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 256, 500, np.uint8), rng.integers(0, 256, 500, np.uint8)
    b[200:] = a[200:]
    x, y = C.rolling_hash(a), C.rolling_hash(b)
    assert (x[199 + C.WINDOW :] == y[199 + C.WINDOW :]).all() and (x[200:210] != y[200:210]).any()
    naive = [0] * 500
    table = (C.W.mix(np.arange(256, dtype=np.uint64) + np.uint64(1)) >> np.uint64(32)).tolist()
    for i in range(500):
        naive[i] = sum(table[a[i - k]] << k for k in range(min(C.WINDOW, i + 1))) % (1 << 32)
    assert x.tolist() == naive


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_query(spark, tmp_path):
    data = rows() + [(900, "hello <|endoftext|> world", None, None, None, None, None), (901, " " * 700_000 + "x", None, None, None, None, None)]
    data += [(902 + i, data[i][1] and data[i][1] * 50, None, None, None, None, None) for i in range(20)]
    table(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.op11_chunk_bpe(spark, str(tmp_path)).collect()
    expected = [(r[0], len(ids), sha(",".join(map(str, ids))), sha(r[1] or "")) for r in data for ids in [want(r[1] or "")]]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_encode_and_decode(spark):
    docs = table(spark).withColumnRenamed("doc_id", "ids")
    encoded = C.encode(docs, keep=("size", "node"))
    by = {r[6]: r[1] for r in rows() if r[6] is not None and r[6] > 10}
    for r in encoded.filter("size > 10").collect():
        assert r.ids == want(by[r["size"]] or "")
    back = C.decode(encoded, keep=("size",)).filter("size > 10").collect()
    assert {r["size"]: r.text for r in back} == {k: v or "" for k, v in by.items()}
    empty = spark.createDataFrame([], SCHEMA)
    assert C.encode(empty).collect() == C.round_trip(empty).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [220, 255])], "doc_id long, ids array<int>")
    assert [r.text for r in C.decode(nulls).orderBy("doc_id").collect()] == [None, REFERENCE.decode([220, 255], skip_special_tokens=False)]
