"""Best-fit packing of tokenised documents into sequences, with certified bin counts.

Documents become token ids and one end id; those longer than a sequence are cut. Pieces
that fill a sequence are done. The others are dealt into partitions of about ``GROUP``
pieces, each packed by best-fit decreasing. Dual feasible functions give a lower bound for a
partition's bins. A partition whose bins exceed its bound, the gap, gives back all documents of its
unfilled sequences, the others those of their emptiest one; they are dealt anew, so partitions
exchange documents, and packed again until one partition holds the rest or a round saves
nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm import words as W
from tablewright.session import pin

CAPACITY = 2048
GROUP = 100_000  # pieces in a partition
ROUNDS = 6
END = 0
LONG = 1 << 17  # characters


class Encoder:
    """Byte-level BPE ids of a text; with ``added`` the strings of added tokens have their own
    ids, as ``tokenizers`` gives them by default, without it they are ordinary text.

    The rank table of the vocabulary serves the fast encoder, whose pattern engine fails on runs of
    some 600,000 blanks and more: texts from ``LONG`` characters on, and those with an added token, go
    through the same vocabulary in ``tokenizers``.
    """

    def __init__(self, vocabulary: str, added: bool = False):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        with open(f"{vocabulary}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.vocabulary, self.added = vocabulary, added
        with open(f"{vocabulary}.json", encoding="utf-8") as file:
            self.tokens = [t["content"] for t in json.load(file)["added_tokens"]] if added else []
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None

    def ids(self, text: str) -> np.ndarray:
        if len(text) < LONG and not any(t in text for t in self.tokens):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(f"{self.vocabulary}.json")
            self.slow.encode_special_tokens = not self.added
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def default_vocabulary() -> str:
    """The public byte-level BPE vocabulary of 50,257 ids, without its file ending."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")).removesuffix(".json")


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document of ``n`` ids: whole sequences, and ahead of them what remains."""
    first = n % capacity
    return [first] * (first > 0) + [capacity] * (n // capacity)


def pieces(
    docs: DataFrame,
    text: str,
    keep: Sequence[str],
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    added_tokens: bool = False,
) -> DataFrame:
    """``keep`` with ``piece, start, length, ids_crc32`` (and ``ids``), one row a piece."""
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for n, c in zip(names, keep)], F.col(text).cast("string").alias("text"))

    def run(batches):
        path = vocabulary or default_vocabulary()
        encoder = W.kept(f"encoder {path} {added_tokens}", lambda: Encoder(path, added_tokens))
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 21):
                take, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": []}
                raw = []
                for i, value in enumerate(part.column("text").to_pylist()):
                    ids = np.append(encoder.ids(value or ""), np.uint32(END)).astype("<u4")
                    at = 0
                    for k, n in enumerate(piece_lengths(len(ids), capacity)):
                        take.append(i)
                        out["piece"].append(k)
                        out["start"].append(at)
                        out["length"].append(n)
                        out["ids_crc32"].append(zlib.crc32(ids[at : at + n].tobytes()))
                        if with_ids:
                            raw.append(ids[at : at + n].astype(np.int64))
                        at += n
                arrays = [part.column(n).take(pa.array(take, pa.int64())) for n in names]
                arrays += [pa.array(out["piece"], pa.int32()), *(pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32"))]
                if with_ids:
                    arrays.append(pa.array(raw, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *out, *(["ids"] if with_ids else [])])

    fields = [f for f in rows.schema.fields if f.name != "text"]
    added = "piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return rows.mapInArrow(run, T.StructType(fields + T._parse_datatype_string(added).fields))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit for lengths in the order given: bin and offset of each, and the bins' fill.

    Open bins are kept by free space; one integer has a bit for each free space that occurs.
    """
    spaces: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        rest = mask >> n
        if rest:
            free = n + (rest & -rest).bit_length() - 1
            b = spaces[free].pop()
            if not spaces[free]:
                mask &= ~(1 << free)
        else:
            free, b = capacity, len(fill)
            fill.append(0)
        place[i], offset[i] = b, fill[b]
        fill[b] += n
        free -= n
        if free:
            spaces[free].append(b)
            mask |= 1 << free
    return place, offset, np.array(fill, np.int64)


def bin_bound(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound for the bins, the greatest over two families of dual feasible functions.

    One counts lengths over ``capacity - t`` as whole bins and drops those under ``t``; the
    other rounds ``(k + 1) x`` down to k-ths unless it is whole.
    """
    if not len(lengths):
        return 0
    hist = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1)
    count, area = np.cumsum(hist), np.cumsum(hist * size)
    t = np.arange(0, capacity // 2 + 1)
    large = count[capacity] - count[capacity - t]
    middle = area[capacity - t] - np.where(t > 0, area[np.maximum(t - 1, 0)], 0)
    best = int((-(-(large * capacity + middle) // capacity)).max())
    for k in range(1, 41):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        exact = int((hist * size)[whole].sum())  # / capacity
        steps = int((hist * (scaled // capacity))[~whole].sum())  # / k
        best = max(best, -(-(exact * k + steps * capacity) // (capacity * k)))
    return best


def _packer(round_no: int, capacity: int, last: bool):
    def pack(key, table):
        length, row = np.asarray(table["length"]), np.asarray(table["row"])
        order = np.lexsort((row, -length))
        place, offset, fill = best_fit(length[order], capacity)
        bound = bin_bound(length, capacity)
        back = np.zeros(len(fill), bool)
        if not last:
            if len(fill) > bound:
                back = fill < capacity
            else:
                back[np.argmin(fill)] = fill.min() < capacity
        n = len(length)
        out = table.take(pa.array(order))
        for name, value in (
            ("sequence_id", (np.int64(round_no) << 58) + (np.int64(key[0].as_py()) << 28) + place),
            ("offset", offset),
            ("group_bins", np.full(n, len(fill))),
            ("group_bound", np.full(n, bound)),
            ("back", back[place]),
        ):
            out = out.append_column(name, pa.array(value))
        return out

    return pack


def pack(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    group: int = GROUP,
    with_ids: bool = False,
    added_tokens: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence: ``keep`` columns, ``piece, start, length,
    ids_crc32, sequence_id, offset``, and the bins and bound of the partition that packed it.

    ``vocabulary``: path of a vocabulary without its ending (``.tiktoken`` ranks and ``.json``).
    ``added_tokens``: strings of the vocabulary's added tokens, such as ``<|endoftext|>``, have their own
    ids; otherwise they are ordinary text.
    Null and empty texts are the end id alone. Repeated rows are packed each. Long documents
    are cut into whole sequences, with a shorter first piece. No rows: no pieces. Columns
    outside ``keep`` are ignored.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    # The row number is written with the pieces, so every later read sees the same.
    rows = pin(pieces(docs, text, keep, vocabulary, capacity, with_ids, added_tokens).withColumn("row", F.monotonically_increasing_id()))
    full = rows.filter(F.col("length") == capacity).select(
        "*",
        (F.lit(15 << 58).cast("long") + F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(1).cast("long").alias("group_bins"),
        F.lit(1).cast("long").alias("group_bound"),
    )
    schema = T.StructType(
        rows.schema.fields + T._parse_datatype_string("sequence_id long, offset long, group_bins long, group_bound long, back boolean").fields
    )
    rest, done, slack = rows.filter(F.col("length") < capacity), [full], None
    for k in range(1, ROUNDS + 1):
        n = rest.count()
        groups = -(-n // group)
        if not n:
            break
        last = groups == 1 or k == ROUNDS
        dealt = rest.withColumn("group", F.pmod(F.xxhash64("row", F.lit(k)), F.lit(groups)))
        packed = pin(dealt.groupBy("group").applyInArrow(_with_group(_packer(k, capacity, last)), schema))
        done.append(packed.filter(~F.col("back")).drop("back"))
        if last:
            break
        rest = packed.filter("back").select(*rows.columns)
        spare = packed.agg(F.sum(F.when(F.col("back"), F.col("length")))).first()[0] or 0
        if slack is not None and spare >= slack:  # nothing saved: keep what is packed
            done.append(packed.filter("back").drop("back"))
            break
        slack = spare
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    found = [F.col(n).alias(c) for n, c in zip(names, keep)]
    return out.select(*found, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "sequence_id", "offset", "group_bins", "group_bound")


def _with_group(fn):
    """Drops the group column, which is the key."""

    def run(key, table):
        return fn(key, table.drop_columns(["group"]))

    return run
