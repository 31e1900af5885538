"""Document quality from a linear-chain conditional random field over lines.

Each line that holds a word gets measures of its bytes and words, and those of the line
before and after. A two-state chain (bad, good) labels the lines; forward-backward gives
each line's probability of good, and a document's score is their mean weighted by length.

Labels exist per document only, so in training every line carries its document's label.
The fit uses a bounded sample of labelled documents (``SAMPLE``, the least by a hash of the
id, of ``LONGEST`` lines at most and ``LINES`` together); scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm import words as W
from tablewright.llm.frames import add_columns
from tablewright.session import pin

SAMPLE = 5_000  # labelled documents in the fit
LONGEST = 4_000  # lines of a document in the fit
LINES = 1 << 19  # lines in the fit, some 90 MB of measures
ROUNDS = 120
PENALTY = 1e-3

_LETTER = np.zeros(256, np.uint8)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC3, 256)]] = 1
_UPPER = np.zeros(256, np.uint8)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.uint8)
_DIGIT[48:58] = 1
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[[ord(c) for c in "#$%&*<>@^~=_+\\{}[]/"]] = 1
_STOP = np.zeros(256, np.uint8)
_STOP[[ord(c) for c in ".,;:?"]] = 1
_BAR = np.zeros(256, np.uint8)
_BAR[ord("|")] = 1
_CRY = np.zeros(256, np.uint8)
_CRY[ord("!")] = 1
CLASSES = [_LETTER, _UPPER, _DIGIT, _SYMBOL, _STOP, _BAR, _CRY]


def line_features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures (lines x features, with neighbours), byte lengths, and each row's first line."""
    data, offsets = W.buffers(column)
    starts, ends, first = W.line_spans(data, offsets)
    n = len(starts)
    length = (ends - starts).astype(np.float64)

    def inside(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[ends] - sums[starts]

    counts = [inside(table[data]) for table in CLASSES]
    ws, we, _ = W.word_spans(data, offsets)
    hashes = W.span_hashes(W.FOLD[data], ws, we)
    line = np.searchsorted(starts, ws, side="right") - 1
    words = np.bincount(line, minlength=n).astype(np.float64)
    again = np.zeros(len(ws), bool)
    for lag in (1, 2):
        again[lag:] |= (hashes[lag:] == hashes[:-lag]) & (line[lag:] == line[:-lag])
    again = np.bincount(line[again], minlength=n)
    wordy = np.maximum(words, 1)
    letters = np.maximum(counts[0], 1)
    # An interrupted word ends in a symbol or a cry right before a space.
    tails = np.bincount(line, weights=(_SYMBOL | _CRY | _BAR)[data[np.maximum(we - 1, 0)]], minlength=n) if n else np.zeros(0)
    own = np.stack(
        [
            np.log1p(length) / 5,
            counts[0] / np.maximum(length, 1),
            counts[1] / letters,
            (counts[1] / letters > 0.6).astype(float),
            counts[2] / np.maximum(length, 1),
            counts[3] / wordy,
            counts[4] / wordy,
            counts[5] / wordy,
            (counts[5] / wordy > 0.2).astype(float),
            counts[6] / wordy,
            np.sqrt(again / wordy),
            tails / wordy,
            (tails / wordy > 0.3).astype(float),
            length / wordy / 10,
        ],
        axis=1,
    ) if n else np.zeros((0, 14))
    width = own.shape[1]
    out = np.zeros((n, 3 * width + 3), np.float32)
    out[:, :width] = own
    if n:
        row = W.rows_of(first)
        joined = np.flatnonzero(row[1:] == row[:-1])
        out[joined + 1, width : 2 * width] = own[joined]
        out[joined, 2 * width : 3 * width] = own[joined + 1]
        out[first[:-1][np.diff(first) > 0], 3 * width] = 1  # first line
        out[first[1:][np.diff(first) > 0] - 1, 3 * width + 1] = 1  # last line
    out[:, -1] = 1
    return out, length, first


def forward_backward(good: np.ndarray, first: np.ndarray, step: np.ndarray):
    """Marginals of state 1 per line, expected transitions, and log likelihood terms.

    ``good``: log-odds of state 1 at each line; ``step``: 2 x 2 log weights from one line's
    state to the next. Rows are taken longest first, so step t works on a prefix of them.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    sizes, begin = counts[order], first[:-1][order]
    n = len(good)
    peak = np.maximum(good, 0)
    emit = np.stack([np.exp(-peak), np.exp(good - peak)], axis=1)
    move = np.exp(step)
    alpha, beta, norm = np.empty((n, 2)), np.ones((n, 2)), np.ones(n)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # rows longer than t
    for t in range(longest):
        at = begin[: active[t]] + t
        now = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
        total = now.sum(axis=1)
        alpha[at], norm[at] = now / total[:, None], total
    moves = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        nxt = begin[: active[t + 1]] + t + 1
        ahead = emit[nxt] * beta[nxt] / norm[nxt][:, None]
        moves += (alpha[nxt - 1].T @ ahead) * move
        beta[nxt - 1] = ahead @ move.T
    both = alpha * beta
    return both[:, 1] / both.sum(axis=1), moves, np.log(norm) + peak


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    step: np.ndarray
    prior: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.center) / self.scale) @ self.weights

    def score(self, column) -> np.ndarray:
        """Length-weighted mean of the line marginals of each text; the prior without lines."""
        x, length, first = line_features(column)
        out = np.full(len(first) - 1, self.prior)
        if len(x):
            p, _, _ = forward_backward(self.odds(x), first, self.step)
            weight = W.totals(length, first)
            out = np.where(weight > 0, W.totals(p * length, first) / np.maximum(weight, 1), out)
        return np.clip(out, 0.0, 1.0)


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Penalised maximum likelihood by Adam on the whole sample; ``label`` is per row."""
    prior = float(label.mean()) if len(label) else 0.5
    width = x.shape[1]
    empty = Model(np.zeros(width), np.ones(width), np.zeros(width), np.zeros((2, 2)), prior)
    if not len(x) or prior in (0.0, 1.0):
        empty.weights[-1] = np.log((prior + 1e-3) / (1 - prior + 1e-3))
        return empty
    center, scale = x.mean(axis=0), x.std(axis=0)
    center[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    z = (x - center) / scale
    row = W.rows_of(first)
    y = label[row].astype(np.float64)
    share = 1.0 / np.sqrt(np.diff(first)[row])  # a long document counts by the root of its lines
    joined = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[joined].astype(int), y[joined + 1].astype(int)), 1.0)
    theta = np.zeros(width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        p, moves, _ = forward_backward(z @ theta[:width], first, theta[width:].reshape(2, 2))
        slope = np.concatenate([((y - p) * share) @ z / share.sum(), ((seen - moves) / max(len(joined), 1)).reshape(-1)])
        slope -= PENALTY * theta
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        theta += 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return Model(center, scale, theta[:width], theta[width:].reshape(2, 2), prior)


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    sample: int = SAMPLE,
    longest: int = LONGEST,
    lines: int = LINES,
) -> Model:
    """Fit on at most ``sample`` labelled documents: those of the least id hashes, as many in
    that order as have ``lines`` lines together. A document of over ``longest`` lines is left out.

    ``usable`` (over ``doc_id``) marks ids that may be learned from. A doc_id with several
    labels counts as the least of them; one with several rows stands for the row of the least
    text hash, however many there are; null ids and labels other than 0 and 1 are not used.
    """
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & usable)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 22):
                x, _, first = line_features(part.column("text"))
                count = np.diff(first)
                raw = [x[first[i] : first[i + 1]].tobytes() if count[i] <= longest else None for i in range(len(count))]
                columns = [part.column("doc_id").cast(pa.string()), part.column("quality"), pa.array(count), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "lines", "x"]).filter(pa.array(count <= longest))

    # At most ``sample`` narrow rows: a bounded broadcast.
    rows = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
        .join(F.broadcast(known), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.min(F.struct(F.xxhash64("text"), "text")).getField("text").alias("text"))
    )
    # Read twice: to add up the lines, and to fetch those of the documents that fit.
    measured = pin(rows.mapInArrow(run, "doc_id string, quality int, lines long, x binary"))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # at most ``sample`` narrow rows
    fitting = measured.select("doc_id", F.sum("lines").over(order).alias("upto")).filter(F.col("upto") <= lines)
    got = measured.join(F.broadcast(fitting.select("doc_id")), "doc_id", "left_semi").select("doc_id", "quality", "x").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("x", "ascending")])
    width = line_features(pa.array([""]))[0].shape[1]
    parts = [np.frombuffer(b, np.float32).reshape(-1, width) for b in got["x"].to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    x = np.concatenate(parts).astype(np.float64) if parts else np.zeros((0, width))
    return fit(x, first, np.asarray(got["quality"], dtype=np.int64))


def quality_scores(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text (0 to 1, higher: better).

    Null and empty texts, and texts of white space alone, get the training share of good
    documents. Other columns pass through unchanged; one named like ``out`` is replaced.
    """
    return add_columns(docs, text, [(out, "double")], lambda column: [pa.array(model.score(column))])
