"""Byte-level BPE by content-defined chunks, and back.

A rolling hash over the last ``WINDOW`` bytes cuts texts into chunks, so passages that documents
share are cut alike wherever they stand. Each worker encodes a chunk once and keeps its ids in a
store of bounded size for all documents that follow. What stands at the join of two chunks was
encoded without its other half; it is encoded again, in a span that grows to both sides until
it ends where the ids on both sides agree with it: at a token end at which the vocabulary's
pattern begins a new piece whatever surrounds it. The ids are so those of the whole text.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm import words as W
from tablewright.llm.packing import default_vocabulary

WINDOW = 32  # bytes that decide on a cut
AVERAGE = 512  # bytes in a chunk, roughly
LEAST, MOST = 64, 8192
STORE = 48 << 20  # bytes of chunks and ids that a worker keeps
LONG = 100_000  # bytes from which a span goes to the slower encoder, which knows no limits

#: Classes of the pattern: letter, number, other, white space, and what is not certain.
LETTER, NUMBER, OTHER, SPACE, UNSURE = range(5)


def _class_of(char: str) -> int:
    """The class of a character if all versions of Unicode since 3.2 agree on it."""
    if char in "\x1c\x1d\x1e\x1f\x85᠎​":
        return UNSURE
    if char.isspace():
        return SPACE
    now, then = unicodedata.category(char), unicodedata.ucd_3_2_0.category(char)
    if then == "Cn" or now[0] != then[0]:
        return UNSURE
    return {"L": LETTER, "N": NUMBER}.get(now[0], OTHER)


_ASCII = [_class_of(chr(i)) for i in range(128)]


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte a hash of it and the ``WINDOW - 1`` bytes before: sum of g[byte] << age, by doubling."""
    table = (W.mix(np.arange(256, dtype=np.uint64) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
    out, step = table[data], 1
    while step < WINDOW:
        out[step:] += out[:-step] << np.uint32(step)  # the right side is made before it is added
        step *= 2
    return out


def cuts(data: np.ndarray, offsets: np.ndarray, average: int = AVERAGE) -> list[list[int]]:
    """For each row the starts of its chunks and its end, within the row.

    A chunk begins where the hash of the bytes before has its high bits zero; chunks under ``LEAST``
    go on, those over ``MOST`` are cut there. No cut lies within a character.
    """
    mask = np.uint32(((1 << (average.bit_length() - 1)) - 1) << (32 - average.bit_length() + 1))
    high = np.flatnonzero((rolling_hash(data) & mask) == 0) + 1 if len(data) else np.zeros(0, np.int64)
    high = high[high < len(data)]
    high = high[(data[high] & 0xC0) != 0x80]
    at = np.searchsorted(high, offsets)
    out = []
    for begin, end, low, top in zip(offsets[:-1].tolist(), offsets[1:].tolist(), at[:-1].tolist(), at[1:].tolist()):
        row, last = [0], begin
        for p in (*high[low:top].tolist(), end):
            while p - last > MOST:
                last += MOST
                while data[last] & 0xC0 == 0x80:
                    last -= 1
                row.append(last - begin)
            if p - last >= LEAST and p < end and p - begin >= WINDOW:
                row.append(p - begin)
                last = p
        out.append([*row, end - begin])
    return out


def _class_before(data: bytes, p: int) -> int:
    s = p - 1
    if data[s] < 128:
        return _ASCII[data[s]]
    while data[s] & 0xC0 == 0x80:
        s -= 1
    return _class_of(data[s:p].decode())


def _char_at(data: bytes, p: int) -> str:
    e = p + 1
    while e < len(data) and data[e] & 0xC0 == 0x80:
        e += 1
    return data[p:e].decode()


def settled(data: bytes, p: int) -> bool:
    """Whether the pattern begins a new piece at ``p`` whatever else the text holds, and what
    stands before ``p`` is cut into the same pieces whether or not the text ends there.

    True at the ends of the text; where white space follows anything else; behind one
    white space that is no blank (of several the pattern looks ahead); and where letters, numbers
    and others meet, but for an apostrophe before a letter.
    """
    if p <= 0 or p >= len(data):
        return True
    a, b = data[p - 1], data[p]
    if b & 0xC0 == 0x80:
        return False
    left = _class_before(data, p)
    right = _ASCII[b] if b < 128 else _class_of(_char_at(data, p))
    if left == right or left == UNSURE or right == UNSURE:
        return False
    if left == SPACE:
        return 9 <= a <= 13 and (p == 1 or _class_before(data, p - 1) in (LETTER, NUMBER, OTHER))
    return not (a == 39 and right == LETTER)


class Encoder:
    """Ids of byte-level BPE chunk by chunk, with a store of chunks that lives as long as it does."""

    def __init__(self, vocabulary: str, store: int = STORE):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        with open(f"{vocabulary}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        with open(f"{vocabulary}.json", encoding="utf-8") as file:
            self.added = {t["content"].encode(): t["id"] for t in json.load(file)["added_tokens"]}
        self.vocabulary = vocabulary
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None
        by_id = {i: t for t, i in (ranks | self.added).items()}
        self.tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.lengths = self.sizes.tolist()
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.limit, self.held = store // 2, 0
        self.young: dict[bytes, list[int]] = {}
        self.old: dict[bytes, list[int]] = {}
        self.encoded = 0  # chunks that were not in the store

    def plain(self, part: bytes) -> list[int]:
        """Ids of a part by itself, as ordinary text."""
        if len(part) < LONG:
            return self.fast.encode_ordinary(part.decode())
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(f"{self.vocabulary}.json")
            self.slow.encode_special_tokens = True
        return self.slow.encode(part.decode(), add_special_tokens=False).ids

    def chunk(self, part: bytes) -> list[int]:
        """Ids of a chunk from the store; of two halves the one not used lately goes."""
        ids = self.young.get(part)
        if ids is None:
            ids = self.old.get(part)
            if ids is None:
                ids = self.plain(part)
                self.encoded += 1
            self.young[part] = ids
            self.held += len(part) + 12 * len(ids) + 200
            if self.held > self.limit:
                self.old, self.young, self.held = self.young, {}, 0
        return ids

    def _tokens_until(self, ids: list[int], size: int, whole: int) -> int | None:
        """How many of the first ids make ``size`` bytes of the chunk's ``whole``; none if no token ends there."""
        lengths = self.lengths
        if size <= whole - size:
            k, at = 0, 0
            while at < size:
                at += lengths[ids[k]]
                k += 1
        else:
            k, at = len(ids), whole
            while at > size:
                k -= 1
                at -= lengths[ids[k]]
        return k if at == size else None

    def segment(self, data: bytes, starts: Sequence[int]) -> list[int]:
        """Ids of a text without added tokens, whose chunks begin at ``starts`` (its end last)."""
        parts = [(s, e, self.chunk(data[s:e])) for s, e in zip(starts, starts[1:]) if e > s]
        out: list[int] = []
        k, at = 0, 0  # the chunk to go on with, and the first byte not yet written
        while k < len(parts):
            s, e, ids = parts[k]
            first = self._tokens_until(ids, at - s, e - s)
            if e == len(data) or settled(data, e):
                out += ids[first:]
                k, at = k + 1, e
                continue
            # Back to where this chunk's ids can be trusted, on to where a later chunk's can.
            low = e - 1
            while low > at and not (settled(data, low) and self._tokens_until(ids, low - s, e - s) is not None):
                low -= 1
            high, after = e + 1, k + 1
            while high < len(data):
                while parts[after][1] < high:
                    after += 1
                b, c, later = parts[after]
                if settled(data, high) and self._tokens_until(later, high - b, c - b) is not None:
                    break
                high += 1
            out += ids[first : self._tokens_until(ids, low - s, e - s)]
            out += self.plain(data[low:high])
            k, at = after, high
            while k < len(parts) and parts[k][1] <= at:
                k += 1
        return out

    def ids(self, data: bytes, starts: Sequence[int]) -> list[int]:
        """Ids of a text: strings of added tokens have their own, what stands between is chunked."""
        if not any(t in data for t in self.added):
            return self.segment(data, starts)
        out: list[int] = []
        for part, token in self._split(data):
            if part:
                array = np.frombuffer(part, np.uint8)
                out += self.segment(part, cuts(array, np.array([0, len(part)]))[0])
            if token is not None:
                out.append(token)
        return out

    def _split(self, data: bytes) -> Iterator[tuple[bytes, int | None]]:
        at = 0
        while True:
            found = [(data.find(t, at), -len(t), t) for t in self.added]
            found = [f for f in found if f[0] >= 0]
            if not found:
                yield data[at:], None
                return
            p, _, token = min(found)
            yield data[at:p], self.added[token]
            at = p + len(token)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids' tokens, one after another."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ids) else 0
        return self.flat[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(n)].tobytes()


def encoder_of(vocabulary: str | None) -> Encoder:
    """The worker's encoder of a vocabulary, made once."""
    path = vocabulary or default_vocabulary()
    return W.kept(f"chunk encoder {path}", lambda: Encoder(path))


def _per_text(docs: DataFrame, text: str, keep: Sequence[str], added: str, compute: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, keep)], F.col(f"`{text}`").alias("_value"))
    fields = T._parse_datatype_string(added).fields

    def run(batches):
        for batch in batches:
            arrays = compute(batch.column("_value"))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *arrays], names=[*names, *(f.name for f in fields)])

    kept = [f for f in rows.schema.fields if f.name in names]
    found = rows.mapInArrow(run, T.StructType(kept + fields))
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], *[f.name for f in fields])


def encode(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns and ``ids``: the ids of every whole text.

    ``vocabulary``: path of a byte-level vocabulary without its ending (``.tiktoken`` ranks and
    ``.json``). Strings of its added tokens have their own ids; nothing is added, cut or padded. Null and
    empty texts have no ids. Repeated rows are encoded each; other columns are ignored.
    """

    def compute(column):
        encoder = encoder_of(vocabulary)
        return [pa.array(_ids_of(encoder, column), pa.list_(pa.int32()))]

    return _per_text(docs.withColumn(text, F.col(f"`{text}`").cast("string")), text, keep, "ids array<int>", compute)


def decode(rows: DataFrame, ids: str = "ids", keep: Sequence[str] = ("doc_id",), vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns and ``text``: what the ids stand for, added tokens as their strings. Null: null.
    Bytes that are no character become U+FFFD; an id outside the vocabulary fails the job."""

    def compute(column):
        encoder = encoder_of(vocabulary)
        out = [None if v is None else encoder.decode(np.array(v, np.int64)).decode("utf-8", "replace") for v in column.to_pylist()]
        return [pa.array(out, pa.string())]

    return _per_text(rows, ids, keep, "text string", compute)


def _ids_of(encoder: Encoder, column: pa.Array) -> list[list[int]]:
    data, offsets = W.buffers(column)
    raw = data.tobytes()
    spans = zip(offsets[:-1].tolist(), offsets[1:].tolist())
    return [encoder.ids(raw[s:e], starts) for (s, e), starts in zip(spans, cuts(data, offsets))]


def round_trip(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns, ``n_tokens``, and the SHA-256 of the ids (decimal, joined by commas) and of
    the text that they decode to. Rows and nulls as in ``encode``; a null text counts as empty."""
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in zip(names, keep)], F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches):
        encoder = encoder_of(vocabulary)
        for batch in batches:
            for part in W.slices(batch, "_text", 1 << 21):
                n, digest, back = [], [], []
                for ids in _ids_of(encoder, part.column("_text")):
                    n.append(len(ids))
                    digest.append(hashlib.sha256(",".join([encoder.decimal[i] for i in ids]).encode()).hexdigest())
                    back.append(hashlib.sha256(encoder.decode(np.array(ids, np.int64))).hexdigest())
                arrays = [*(part.column(c) for c in names), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"])

    kept = [f for f in rows.schema.fields if f.name in names]
    found = rows.mapInArrow(run, T.StructType(kept + T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string").fields))
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "n_tokens", "ids_sha256", "decoded_sha256")
