"""Language-model scores from a weighted backoff automaton.

The model is an n-gram model learned from all training rows, with Witten-Bell smoothing:
``P(w | h) = (c(h w) + t(h) * P(w | h')) / (c(h) + t(h))``, where ``t(h) = c(h) ** g`` stands for the
kinds of token that follow ``h``, and ``g`` is such that they sum to the corpus's distinct
n-grams. Read as an automaton, every context ``h`` that training saw is a state, every n-gram
``h w`` that it saw an arc, and a failure arc of weight ``t(h) / (c(h) + t(h))`` leads from ``h`` to the
shorter context ``h'`` when there is no arc for ``w``. The root has an arc for every known token,
``(c - D) / N`` by absolute discounting, and one of weight ``D * V / N`` for all unknown ones.

The automaton grows with the corpus, so no task holds all of it. Documents are dealt into
blocks of about ``BLOCK`` bytes. A block sends each of its distinct n-grams once, with its own
count, to the part that owns the n-gram; the part adds up the counts and sends back the
totals in the order in which the n-grams came. So every block gets just the states and arcs its
documents can reach, and the walk over each text runs inside the block.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import words as W

ORDER = 2
POWERS = np.linspace(0.0, 1.0, 41)  # exponents g at which sums of c ** g are known
BLOCK = 8 << 20  # bytes of text in a block of documents
PART = 8 << 20  # bytes of text that give the n-grams of one part
_U = np.uint64
_BEGIN, _END = _U(0x6A09E667F3BCC909), _U(0xBB67AE8584CAA73B)


class _Grams:
    """The n-grams of a block: for each order their distinct keys, own training counts, and
    the key of every position."""

    def __init__(self, column, train: np.ndarray, order: int, parts: int):
        hashes, first = W.word_hashes(column)
        rows = len(first) - 1
        self.tokens = np.diff(first) + 1  # words, then one end
        self.first = np.concatenate([[0], np.cumsum(self.tokens)])
        padded_first = np.concatenate([[0], np.cumsum(self.tokens + 1)])
        padded = np.empty(padded_first[-1], np.uint64)
        padded[padded_first[:-1]] = _BEGIN
        padded[padded_first[1:] - 1] = _END
        padded[np.arange(len(hashes)) + 2 * W.rows_of(first) + 1] = hashes
        learned = np.repeat(train, self.tokens)
        self.bits = _bits(parts)
        self.levels, self.owners = [], []  # keys ascend, and so do the parts that own them
        for n in range(1, order + 1):
            if n == 1:
                key, at = np.delete(padded, padded_first[:-1]), np.arange(len(learned))
            else:
                key, begin = W.gram_hashes(padded, padded_first, n)
                # the k-th n-gram of a row ends at its token k + n - 2
                at = np.arange(len(key)) + np.repeat(self.first[:-1] - begin[:-1] + n - 2, np.diff(begin))
                key = (self.part(key, parts) << _U(self.bits)) | (key & _U((1 << self.bits) - 1))
            order_by = np.argsort(key)
            key = key[order_by]
            new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            counts = np.add.reduceat(learned[at][order_by].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
            which = np.empty(len(key), np.int64)
            which[order_by] = np.cumsum(new) - 1
            self.levels.append((key[starts], counts, which, at))
            self.owners.append(self.part(key[starts], parts) if n == 1 else key[starts] >> _U(self.bits))
        self.rows = rows

    @staticmethod
    def part(key: np.ndarray, parts: int) -> np.ndarray:
        return ((key >> _U(40)) * _U(parts)) >> _U(24)


def _pack(keys: np.ndarray, width: int) -> bytes:
    return keys.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(np.uint64).reshape(-1)


def _planes(counts: np.ndarray) -> bytes:
    """Counts as all their low bytes, all their next bytes, ...: zeros lie together and compress."""
    return counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _counts(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1).astype(np.int64)


_SENT = "level int, part long, block long, keys binary, counts binary"
_TOTAL = "block long, level int, part long, totals binary"
_FACT = "level int, part long, fact int, value double"


def _bits(parts: int) -> int:
    """Bits of a longer n-gram's key that travel; the part that owns it says the others."""
    return 48 if parts <= 1 << 16 else 40


def _sender(order: int, parts: int):
    def send(key, table):
        grams = _Grams(table["text"], np.asarray(table["train"]), order, parts)
        out = {"level": [], "part": [], "block": [], "keys": [], "counts": []}
        for level, (keys, counts, _, _) in enumerate(grams.levels, 1):
            width = 8 if level == 1 else grams.bits // 8
            owner = grams.owners[level - 1]
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(keys) else []
            for s, e in zip(cuts, [*cuts[1:], len(keys)]):
                out["level"].append(level)
                out["part"].append(int(owner[s]))
                out["block"].append(key[0].as_py())
                out["keys"].append(_pack(keys[s:e], width))
                out["counts"].append(_planes(counts[s:e]))
        return pa.table(out, schema=pa.schema([("level", pa.int32()), ("part", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))

    return send


def _added(level: int, table: pa.Table, parts: int):
    """Entries of each block, the total of each entry's key, and the totals once per key."""
    width = 8 if level == 1 else _bits(parts) // 8
    keys = [_unpack(x, width) for x in table["keys"].to_pylist()]
    sizes = [len(x) for x in keys]
    keys = np.concatenate(keys)
    own = np.concatenate([_counts(x) for x in table["counts"].to_pylist()])
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    sums = np.add.reduceat(own[order], np.flatnonzero(new))
    total = np.empty(len(keys), np.int64)
    total[order] = sums[np.cumsum(new) - 1]
    return sizes, total, sums


def _adder(parts: int):
    def add(key, table):
        level, part = key[0].as_py(), key[1].as_py()
        sizes, total, _ = _added(level, table, parts)
        out = {"block": table["block"].to_pylist(), "level": [level] * table.num_rows, "part": [part] * table.num_rows, "totals": []}
        at = 0
        for n in sizes:
            out["totals"].append(_planes(total[at : at + n]))
            at += n
        return pa.table(out, schema=pa.schema([("block", pa.int64()), ("level", pa.int32()), ("part", pa.int64()), ("totals", pa.binary())]))

    return add


def _facts(parts: int):
    """Per part: n-grams, kinds, kinds seen once and twice, and sums of powers of their counts."""

    def sums(key, table):
        _, _, counts = _added(key[0].as_py(), table, parts)
        seen = counts[counts > 0].astype(np.float64)
        facts = [seen.sum(), len(seen), (seen == 1).sum(), (seen == 2).sum(), *((seen**g).sum() for g in POWERS)]
        n = len(facts)
        return pa.table({"level": pa.array([key[0].as_py()] * n, pa.int32()), "part": pa.array([key[1].as_py()] * n, pa.int64()), "fact": pa.array(range(n), pa.int32()), "value": pa.array(np.array(facts, np.float64))})

    return sums


def _exponent(powers: np.ndarray, kinds: float) -> float:
    """The g at which the sum of c ** g over the contexts is the number of n-grams."""
    return float(np.interp(kinds, powers, POWERS)) if powers[-1] > powers[0] else 1.0


def walk(grams: _Grams, counts: list[np.ndarray], facts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base and model log10 probability of each row, and its known tokens.

    ``facts``: for each order the corpus's n-grams, kinds, kinds seen once and twice, and sums
    of powers. The state before a token is the longest context that training saw; all
    positions of a block follow their failure arcs together, one order at a time.
    """
    tokens, kinds, once, twice = facts[0][:4]
    own = counts[0][grams.levels[0][2]]
    base = np.log10((own + 1.0) / (tokens + 1.0 * (kinds + 1)))
    cut = np.clip(once / (once + 2 * twice), 0.1, 0.9) if once + twice else 0.5
    prob = np.where(own > 0, (own - cut) / max(tokens, 1), cut * kinds / tokens if tokens else 1.0)
    context = own  # training count of the n-gram that ends at each position
    starts = counts[0][grams.levels[0][2][grams.first[1:] - 1]]  # every text begins once and ends once
    for n in range(2, len(counts) + 1):
        which, at = grams.levels[n - 1][2], grams.levels[n - 1][3]
        arc = counts[n - 1][which].astype(float)
        before = np.empty(len(own))
        before[1:] = context[:-1]
        before[grams.first[:-1]] = starts  # at a row's first token the context is the beginning of the text
        state = before[at]
        left = state ** _exponent(facts[n - 2][4:], facts[n - 1][1])
        prob[at] = np.where(state > 0, (arc + left * prob[at]) / np.maximum(state + left, 1), prob[at])
        context = np.zeros(len(own), np.int64)
        context[at] = counts[n - 1][which]
    return W.totals(base, grams.first), W.totals(np.log10(prob), grams.first), W.totals(own > 0, grams.first)


def lm_scores(
    docs: DataFrame,
    train: Column,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    order: int = ORDER,
    block_bytes: int = BLOCK,
    part_bytes: int = PART,
) -> DataFrame:
    """``keep`` columns with ``n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Texts are lower-cased (A-Z) and cut into words at 0x20 and 0x09-0x0D; each text ends with
    one end token. ``train`` marks the rows to learn from; a null mark counts as false.
    ``base_score`` is the sum of log10((c + 1) / (N + 1 * (V + 1))), ``score`` the automaton's
    log10 probability. Null or empty text: the end token alone. Repeated rows count each time.
    Empty table: no rows. No training rows: N = V = 0. Other columns are ignored.
    """
    spark = docs.sparkSession
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, parts = max(1, -(-size // block_bytes)), max(1, -(-size // part_bytes))
    names = [f"_k{i}" for i in range(len(keep))]
    placed = rows.withColumn("block", F.pmod(F.xxhash64(*names, "text"), F.lit(blocks))).repartition(blocks, "block")
    sent = placed.groupBy("block").applyInArrow(_sender(order, parts), _SENT)
    totals = sent.groupBy("level", "part").applyInArrow(_adder(parts), _TOTAL)
    # A few numbers about the corpus, to every block; they come from the same exchange.
    facts = sent.groupBy("level", "part").applyInArrow(_facts(parts), _FACT).groupBy("level", "fact").agg(F.sum("value").alias("value"))
    facts = facts.agg(F.array_sort(F.collect_list(F.struct("level", "fact", "value"))).alias("facts"))
    told = spark.range(blocks).select(F.col("id").alias("block"), facts.scalar().alias("facts"))
    right = totals.withColumn("facts", F.lit(None).cast(told.schema["facts"].dataType)).unionByName(told, allowMissingColumns=True)

    def score(left, right):
        grams = _Grams(left["text"], np.asarray(left["train"]), order, parts)
        counts = [level[1].copy() for level in grams.levels]
        facts = [np.zeros(4 + len(POWERS)) for _ in counts]
        for level, part, totals, told in zip(*(right[c].to_pylist() for c in ("level", "part", "totals", "facts"))):
            if told is not None:
                for fact in told:
                    facts[fact["level"] - 1][fact["fact"]] = fact["value"]
                continue
            first = np.searchsorted(grams.owners[level - 1], part)
            total = _counts(totals)
            counts[level - 1][first : first + len(total)] = total
        base, prob, known = walk(grams, counts, facts)
        out = left.select(names)
        for name, value in (
            ("n_tokens", grams.tokens.astype(np.int64)),
            ("n_known", known.astype(np.int64)),
            ("train_tokens", np.full(grams.rows, round(facts[0][0]), np.int64)),
            ("base_score", base),
            ("score", prob),
        ):
            out = out.append_column(name, pa.array(value))
        return out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema.fields)
    scored = placed.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(
        score, schema + ", n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return scored.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "n_tokens", "n_known", "train_tokens", "base_score", "score")
