import zlib

import numpy as np
import public_tokenizers
from corpus import SCHEMA, rows, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm import packing

TOKENIZER = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
TOKENIZER.encode_special_tokens = True


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(got, data, capacity):
    """Whole documents, gapless sequences, ids by the reference library."""
    want = []
    for r in data:
        own = ids(r[1])
        at = 0
        for k, n in enumerate(packing.piece_lengths(len(own), capacity)):
            want.append((r[0], k, at, n, zlib.crc32(np.array(own[at : at + n], "<u4").tobytes())))
            at += n
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values(), default=0) <= capacity
    return len(fill)


def test_documents(spark):
    data = rows() + [(900, "hello <|endoftext|> world", None, None, None, None, None)]
    got = packing.pack(table(spark, data)).collect()
    lengths = np.array([r.length for r in got])
    assert check(got, data, 2048) == packing.bin_bound(lengths, 2048)


def test_partitions_exchange(spark):
    data = rows()
    got = packing.pack(table(spark, data), capacity=64, group=9).collect()
    alone = packing.pack(table(spark, data), capacity=64).collect()
    lengths = np.array([r.length for r in got])
    bins, best = check(got, data, 64), check(alone, data, 64)
    assert packing.bin_bound(lengths, 64) <= best <= bins <= best + 3


def test_ids_come_back(spark):
    data = rows()
    got = packing.pack(table(spark, data), keep=("size",), capacity=50, with_ids=True).filter("size = 40").collect()
    text = next(r[1] for r in data if r[6] == 40)
    assert [x for r in sorted(got, key=lambda r: r.piece) for x in r.ids] == ids(text)


def test_long_runs_and_empty_table(spark):
    own = [(1, " " * (1 << 20), None, None, None, None, None), (2, "a" * ((1 << 20) + 3), None, None, None, None, None)]
    check(packing.pack(table(spark, own)).collect(), own, 2048)
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_of_white_space():
    encoder = packing.Encoder(packing.default_vocabulary())
    for n in (packing.LONG - 1, 700_000, 1_000_000, (1 << 20) - 1):
        for unit in (" ", "\n", "\t", " \n\t"):
            text = (unit * n)[:n]
            assert encoder.ids(text).tolist() == ids(text)[:-1]


def test_added_tokens_have_their_own_ids(spark, tmp_path):
    import __spark_entry__ as entry
    import corpus_pipeline

    plain = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    own = ["hello <|endoftext|> world", "<|endoftext|>" * 3, "a" * (1 << 20) + "<|endoftext|>", "<|endoftext", None]
    docs = table(spark, [(i, t, None, "s", None, None, None) for i, t in enumerate(own)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(own)}
    assert want[0] == [31373, 220, 50256, 995, 0]
    cut = {}
    for i, x in want.items():
        ends = np.cumsum([0, *packing.piece_lengths(len(x), 2048)])
        cut[i] = [(int(a), int(b - a), zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for a, b in zip(ends, ends[1:])]
    for got in (entry.queries()["op6_best_fit_packing"](spark, str(tmp_path)), corpus_pipeline.sequences(spark, docs, "")):
        found = {i: [] for i in want}
        for r in got.orderBy("doc_id", "piece").collect():
            found[r.doc_id].append((r.start, r.length, r.ids_crc32))
        assert found == cut


@given(st.lists(st.integers(1, 30), max_size=40))
@settings(max_examples=150, deadline=None)
def test_bound_and_best_fit(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    place, offset, fill = packing.best_fit(lengths, 30)
    assert packing.bin_bound(lengths, 30) <= len(fill) <= max(1, 11 / 9 * packing.bin_bound(lengths, 30) * 1.5 + 1)
    assert fill.sum() == lengths.sum() and (fill <= 30).all()
    for b in range(len(fill)):
        own = np.flatnonzero(place == b)
        assert offset[own].tolist() == [0, *np.cumsum(lengths[own])[:-1]]


def test_bound_beats_area():
    assert packing.bin_bound(np.array([16] * 10), 30) == 10  # two never fit together
    assert packing.bin_bound(np.array([11] * 6), 30) == 3  # two in a bin
    assert packing.bin_bound(np.array([], np.int64), 30) == 0
