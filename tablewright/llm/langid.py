"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams (one to three code points, lower case,
everything but letters as one separator), hashed into ``BUCKETS``. Document frequencies
come from all training rows. Weights are learned by follow-the-regularised-leader with an
elastic-net penalty, which leaves most of them at zero, on a bounded sample (about
``PER_LANGUAGE`` different texts of each language); a held-aside fifth of it sets the temperature.
Prediction reads every whole text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import words as W
from tablewright.llm.frames import add_columns

BUCKETS = 1 << 15
PER_LANGUAGE = 1_200
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
SCALE = 20.0  # of a relative frequency
SLICE = 1 << 18  # bytes of text at a time: temporaries take some fifty times as much
UNKNOWN = "und"


def _folded() -> np.ndarray:
    """Code point -> its lower case if a letter or mark, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if unicodedata.category(c)[0] in "LM":
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _letters() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[i for i in range(0x110000) if unicodedata.category(chr(i))[0] == "L"]] = True
    return out


def code_points(column) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a text column and each row's first."""
    data, offsets = W.buffers(column)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, heads[offsets]


def gram_buckets(points: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: buckets of the n-grams that hold a letter, and each row's first n-gram."""
    c = W.kept("folded", _folded)[points]
    row_end = np.repeat(first[1:], np.diff(first))
    at = np.arange(len(c))
    for n in (1, 2, 3):
        if len(c) < n:
            yield np.zeros(0, np.int64), np.zeros(len(first), np.int64)
            continue
        m = len(c) - n + 1
        whole = at[:m] + n <= row_end[:m]
        if n == 1:
            key, use = c.astype(np.uint32), c > 0
        elif n == 2:
            key, use = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77), (c[:-1] | c[1:]) > 0
        else:
            key = (c[:-2] * np.uint32(0xC2B2AE3D) + c[1:-1]) * np.uint32(0x27D4EB2F) + c[2:] * np.uint32(0x165667B1)
            use = c[1:-1] > 0
        use = np.flatnonzero(use & whole)
        key = (key[use] + np.uint32(n * 0x2545F491)) * np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x2C1B3C6D)
        yield (key >> np.uint32(32 - 15)).astype(np.int64), np.searchsorted(use, first)


def term_counts(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets present in each text and their counts."""
    points, first = code_points(column)
    grams = list(gram_buckets(points, first))
    for row in range(len(first) - 1):
        own = np.concatenate([b[f[row] : f[row + 1]] for b, f in grams])
        bucket, count = np.unique(own, return_counts=True)
        yield bucket, count


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages: IDF times weight
    bias: np.ndarray
    temperature: float

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        """Language and confidence of each text; ``und`` and 0 without a letter or a model."""
        points, first = code_points(column)
        n, k = len(first) - 1, len(self.languages)
        lettered = W.totals(W.kept("letters", _letters)[points], first) > 0
        if k == 0:
            return [UNKNOWN] * n, np.zeros(n)
        sums, seen = np.zeros((n, k)), np.zeros(n)
        for bucket, start in gram_buckets(points, first):
            for row in range(k):
                sums[:, row] += W.totals(self.table[:, row][bucket], start)
            seen += np.diff(start)
        z = (SCALE * sums / np.maximum(seen, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        p = z / z.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return names, np.where(lettered, p[np.arange(n), best], 0.0)


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over sparse rows ``(buckets, values, class)``: weights and bias."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))
    penalty = np.full((BUCKETS + 1, 1), L1)
    penalty[-1] = 0.0  # the bias is free

    def weights(at) -> np.ndarray:
        own = z[at]
        w = -(own - np.sign(own) * penalty[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(own) <= penalty[at], 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            bucket, value, label = rows[i]
            at = np.append(bucket, BUCKETS)
            x = np.append(value, 1.0)
            w = weights(at)
            p = x @ w
            p = np.exp(p - p.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p
            n_new = n[at] + g * g
            z[at] += g - (np.sqrt(n_new) - np.sqrt(n[at])) / ALPHA * w
            n[at] = n_new
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def _temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature of least log loss."""
    if not len(label):
        return 1.0

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(label)), label]).mean())

    return min(np.exp(np.linspace(-2.5, 2.5, 101)), key=loss)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on all rows given that have a language: frequencies from all of them, weights from a
    sample of about ``per_language`` texts of each language, drawn by a hash of the text.

    Rows that repeat a text of their language are one draw, so a text that stands in a third of
    the rows is taken once or not at all, and the others of its language fill the sample. A text
    goes to the driver as at most ``BUCKETS`` counts. Null languages and null texts teach
    nothing. No usable rows: a model that says ``und``.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    sizes, texts = {}, {}
    counts = (F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("texts"))
    for r in rows.groupBy("lang").agg(*counts).collect():  # one row a class
        sizes[r["lang"]], texts[r["lang"]] = r["n"], max(1, r["texts"])
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)

    def count(batches):
        seen = np.zeros(BUCKETS, np.int64)
        flags = np.zeros((32, BUCKETS), bool)
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                points, first = code_points(part.column("text"))
                grams = list(gram_buckets(points, first))
                for low in range(0, len(first) - 1, 32):
                    high = min(low + 32, len(first) - 1)
                    flags[:] = False
                    for bucket, start in grams:
                        own = slice(start[low], start[high])
                        flags[np.repeat(np.arange(high - low), np.diff(start[low : high + 1])), bucket[own]] = True
                    seen += flags.sum(axis=0)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    frequency = np.zeros(BUCKETS)
    counted = rows.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    frequency[np.asarray(counted["bucket"])] = np.asarray(counted["n"])
    idf = np.log((1 + sum(sizes.values())) / (1 + frequency)) + 1

    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, per_language / texts[name]))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)

    def sparse(batches):
        for batch in batches:
            for part in W.slices(batch, "text", SLICE):
                found = list(term_counts(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang"),
                        part.column("draw"),
                        pa.array([b.astype(np.uint16).tobytes() for b, _ in found], pa.binary()),
                        pa.array([c.astype(np.uint32).tobytes() for _, c in found], pa.binary()),
                    ],
                    names=["lang", "draw", "bucket", "n"],
                )

    sample = (
        rows.withColumn("draw", draw)
        .filter(F.col("draw") < F.element_at(share, F.col("lang")))
        .groupBy("lang", F.xxhash64("text", "lang").alias("draw"))
        .agg(F.min("text").alias("text"))
        .mapInArrow(sparse, "lang string, draw long, bucket binary, n binary")
        .toArrow()
        .sort_by([("draw", "ascending"), ("lang", "ascending")])
    )
    index = {name: i for i, name in enumerate(languages)}
    data = []
    for name, b, c in zip(sample["lang"].to_pylist(), sample["bucket"].to_pylist(), sample["n"].to_pylist()):
        bucket, n = np.frombuffer(b, np.uint16).astype(np.int64), np.frombuffer(c, np.uint32)
        if len(bucket):
            data.append((bucket, SCALE * n / n.sum() * idf[bucket], index[name]))
    aside = data[::5] if len(data) >= 10 else []
    w, bias = follow_leader([r for i, r in enumerate(data) if i % 5 or not aside], len(languages))
    logits = np.array([v @ w[b] + bias for b, v, _ in aside]) if aside else np.zeros((0, len(languages)))
    return Model(languages, idf[:, None] * w, bias, _temperature(logits, np.array([r[2] for r in aside], np.int64)))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) from every whole text.

    Null texts and texts without a letter: ``und`` with score 0. Other columns pass through;
    columns named ``lang_pred`` or ``score`` are replaced.
    """

    def compute(column):
        names, score = model.predict(column)
        return [pa.array(names, pa.string()), pa.array(score)]

    return add_columns(docs, text, [("lang_pred", "string"), ("score", "double")], compute, SLICE)
