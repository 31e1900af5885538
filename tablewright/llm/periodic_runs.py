"""Periodic runs of words: stretches that repeat themselves over and over.

Suffixes start at words. A suffix array and the longest common prefixes (LCP) of neighbours
come first. Then, as in Kruskal's algorithm, classes of suffixes are united by falling LCP:
union-find over ordered sets of positions, the lesser set going into the greater. At the level
of LCP l, two positions i < j = i + q that have just become neighbours in their class share a
prefix of exactly l words; if q <= l, then words i .. j + l - 1 have the smallest period q, and
no word after them extends them. Every run is met so at its first position (the pair whose
preceding words differ or do not exist), once.

A text in which no ``least_prefix`` words occur twice has no run; hashes find most of such texts
before any sorting (equal hashes of different words cost time, never results). Words compare
by their bytes throughout.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm import words as W
from tablewright.llm.repetition import suffix_array

LEAST_LENGTH = 24  # words in a run
LEAST_EXPONENT = 3  # periods in a run

#: Changes the words of a row before they are searched: (key value, words) -> words.
Rewrite = Callable[[object, list[bytes]], list[bytes]]


def least_prefix(length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> int:
    """Words that two suffixes must share to seed a run: the least of max(length - q, (exponent - 1) q)."""
    return min(max(length - q, (exponent - 1) * q) for q in range(1, length + 1))


def exact_prefixes(items: list[int], first: np.ndarray, order: np.ndarray) -> list[int]:
    """LCP of each suffix with the one before it in ``order``, word by word: from one position
    of a row to the next it falls by one at most, so the comparisons add up to twice the words."""
    n = len(items)
    before = np.full(n, -1, np.int64)
    if n:
        row = W.rows_of(first)
        same = row[order][1:] == row[order][:-1]
        before[order[1:][same]] = order[:-1][same]
    out, before = [0] * n, before.tolist()
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        k = 0
        for i in range(begin, end):
            j = before[i]
            if j < 0:
                k = 0
                continue
            stop = end - (i if i > j else j)
            while k < stop and items[i + k] == items[j + k]:
                k += 1
            out[i] = k
            k -= k > 0
    return out


def find_runs(items: list[int], first: np.ndarray, length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of all rows, positions counted over all items."""
    if exponent < 2 or length < 1:
        raise ValueError("a run has two periods at least")
    need = least_prefix(length, exponent)
    order = suffix_array(np.array(items, np.int64), first)
    prefix = exact_prefixes(items, first, order)
    lcp = np.array(prefix, np.int64)[order] if items else np.zeros(0, np.int64)
    at = np.flatnonzero(lcp >= need)
    at = at[np.argsort(-lcp[at], kind="stable")]
    edges = list(zip(lcp[at].tolist(), order[at - 1].tolist(), order[at].tolist()))
    begins = set(first.tolist())
    parent: dict[int, int] = {}
    classes: dict[int, list[int]] = {}
    after: dict[int, int] = {}
    runs: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def seed(i: int, j: int, level: int) -> None:
        q = j - i
        if level >= length - q and level >= (exponent - 1) * q and (i in begins or items[i - 1] != items[j - 1]):
            seeds.append((i, j))

    k, n = 0, len(edges)
    while k < n:
        level, seeds = edges[k][0], []
        while k < n and edges[k][0] == level:
            a, b = root(edges[k][1]), root(edges[k][2])
            k += 1
            if a == b:
                continue
            great, less = classes.get(a) or [a], classes.get(b) or [b]
            if len(great) < len(less):
                a, b, great, less = b, a, less, great
            parent[b] = a
            classes.pop(b, None)
            classes[a] = great
            last = -1
            for x in less:
                if x > great[-1]:
                    p, s = great[-1], -1
                    great.append(x)
                else:
                    place = bisect_left(great, x)
                    p, s = (great[place - 1] if place else -1), great[place]
                    great.insert(place, x)
                if p >= 0:
                    after[p] = x
                    if p != last:  # else the two were neighbours before
                        seed(p, x, level)
                if s >= 0:
                    after[x] = s
                    seed(x, s, level)
                last = x
        # Later unions of the same level may have come between.
        runs += [(i, j - i + level, j - i) for i, j in set(seeds) if after.get(i) == j]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _suspects(hashes: np.ndarray, first: np.ndarray, need: int) -> np.ndarray:
    """Rows in which ``need`` words occur twice, by hash."""
    grams, begin = W.gram_hashes(hashes, first, need)
    row = W.rows_of(begin)
    order = np.lexsort((grams, row))
    same = (grams[order][1:] == grams[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.unique(row[order][1:][same])


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _spread(ids: np.ndarray) -> np.ndarray:
    return W.mix(ids.astype(np.uint64) * np.uint64(W.MULTIPLIER) + np.uint64(1))


def runs_of_texts(texts: list[list[bytes]], length: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words, starts counted within it."""
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    table: dict[bytes, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for t in texts for w in t), np.int64, int(first[-1]))
    rows = _suspects(_spread(ids), first, least_prefix(length, exponent))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(rows):
        inner = np.concatenate([[0], np.cumsum(np.diff(first)[rows])]).astype(np.int64)
        items = np.concatenate([ids[first[r] : first[r + 1]] for r in rows]).tolist()
        for start, n, q in find_runs(items, inner, length, exponent):
            r = int(np.searchsorted(inner, start, side="right")) - 1
            out[rows[r]].append((start - int(inner[r]), n, q))
    return out


def collapse(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, n, q in runs:
        cover[start + q] += 1
        cover[start + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()]


def strongest(runs: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, compared as integers; then least start, then least period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    key: str | None = None,
    rewrite: Rewrite | None = None,
    length: int = LEAST_LENGTH,
    exponent: int = LEAST_EXPONENT,
    spans: bool = False,
    collapsed: bool = False,
) -> DataFrame:
    """``keep`` columns with ``n_runs``, the strongest run (``start, length, period,
    exponent_milli``), ``runs_sha256``, ``collapsed_sha256``; with ``spans`` also ``runs`` (all, by start
    and period), with ``collapsed`` the text without repeated periods, its words joined by a space.

    A run is a stretch of words with smallest period q, of ``max(length, exponent * q)`` words or more,
    that no neighbouring word extends. ``rewrite`` gets each row's ``key`` value and words
    and gives the words to search. Null and empty texts have no run, four nulls and the digests of the
    empty text; a null key goes to ``rewrite`` as it is. Repeated rows count by themselves, other columns are
    ignored, no rows give no rows. A text is one value and so is searched in one task.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for n, c in zip(names, keep)],
        F.col(f"`{text}`").cast("string").alias("_text"),
        (F.col(f"`{key}`") if key else F.lit(None).cast("long")).alias("_key"),
    )
    number = ("n_runs", "start", "length", "period", "exponent_milli")
    added = T.StructType([T.StructField(c, T.LongType()) for c in number] + [T.StructField(c, T.StringType()) for c in ("runs_sha256", "collapsed_sha256")])
    if spans:
        added.add("runs", T._parse_datatype_string("array<struct<start:long,length:long,period:long>>"))
    if collapsed:
        added.add("collapsed", T.StringType())
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "_text", 1 << 20):
                texts = [(t or b"").split() for t in part.column("_text").cast(pa.binary()).to_pylist()]
                if rewrite:
                    texts = [rewrite(k, t) for k, t in zip(part.column("_key").to_pylist(), texts)]
                out: dict[str, list] = {f.name: [] for f in added.fields}
                for words, found in zip(texts, runs_of_texts(texts, length, exponent)):
                    best = strongest(found)
                    rest = b" ".join(collapse(words, found))
                    values = [len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None]
                    for c, v in zip(number, values):
                        out[c].append(v)
                    out["runs_sha256"].append(_digest("".join(f"{s},{n},{q}\n" for s, n, q in found)))
                    out["collapsed_sha256"].append(hashlib.sha256(rest).hexdigest())
                    if spans:
                        out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    if collapsed:
                        out["collapsed"].append(rest.decode())
                arrays = [part.column(n) for n in names]
                arrays += [pa.array(out[c], pa.int64()) for c in number]
                arrays += [pa.array(out[c], pa.string()) for c in ("runs_sha256", "collapsed_sha256")]
                if spans:
                    arrays.append(pa.array(out["runs"], span))
                if collapsed:
                    arrays.append(pa.array(out["collapsed"], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *added.names])

    kept = [f for f in rows.schema.fields if f.name in names]
    found = rows.mapInArrow(run, T.StructType(kept + added.fields))
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], *added.names)
