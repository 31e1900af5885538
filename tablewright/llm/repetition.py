"""Quality rules on repetition, from a suffix array of each text.

Suffixes start at words. Sorting them by one, two, four, ... words (prefix doubling, only
suffixes that still tie go on) gives the suffix array; the longest common prefix of
neighbours gives the intervals of suffixes that share a repeated substring. At each word the
longest substring that occurs again has the greater of the two neighbouring prefix lengths;
those of ``SHORTEST`` words or more are marked, the union of their spans is the repeated
part of the text. A text fails if that part is too large or one repeat too long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import words as W
from tablewright.llm.frames import add_columns

SHORTEST = 4  # words in a repeated substring
MAX_COVERED = 0.30  # of a text's words
MAX_REPEAT = 100  # words in the longest repeat

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1


def suffix_array(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Suffix arrays of all rows, one after another: positions ordered by row, then by suffix.

    Items compare by value, and a suffix that ends is less than one that goes on. ``rank``
    holds the place of a suffix's group; a group of one is final.
    """
    n = len(items)
    row = W.rows_of(first)
    end = first[1:][row] if n else np.zeros(0, np.int64)
    order = np.lexsort((items, row))
    new = np.concatenate([[True], (items[order][1:] != items[order][:-1]) | (row[order][1:] != row[order][:-1])]) if n else np.zeros(0, bool)
    places = np.arange(n)
    head = np.maximum.accumulate(np.where(new, places, 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    sizes = np.diff(np.append(np.flatnonzero(new), n))
    open_places = np.flatnonzero(np.repeat(sizes > 1, sizes))
    h = 1
    while len(open_places):
        members = order[open_places]
        follow = members + h
        inside = follow < end[members]
        second = np.where(inside, rank[np.minimum(follow, n - 1)], -1)
        by = np.lexsort((second, rank[members]))
        members, second, group = members[by], second[by], rank[members][by]
        order[open_places] = members  # groups keep their places, in the same sequence
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        heads = np.maximum.accumulate(np.where(new, np.arange(len(members)), 0))
        rank[members] = open_places[heads]
        sizes = np.diff(np.append(np.flatnonzero(new), len(members)))
        open_places = open_places[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


def common_prefixes(items: np.ndarray, first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of each suffix with the one before it in ``order``.

    Runs of items are compared by prefix-sum hashes, in steps of falling powers of two.
    """
    n = len(items)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    row = W.rows_of(first)
    end = first[1:][row]
    pair = np.flatnonzero((row[order][1:] == row[order][:-1]) & (items[order][1:] == items[order][:-1])) + 1
    if not len(pair):
        return out
    up, down = W.powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(items * up[:n])])
    a, b = order[pair - 1], order[pair]
    room = np.minimum(end[a] - a, end[b] - b)
    length = np.zeros(len(pair), np.int64)
    step = 1 << int(room.max()).bit_length()
    while step:
        fits = np.flatnonzero(length + step <= room)
        s, t = a[fits] + length[fits], b[fits] + length[fits]
        equal = (sums[s + step] - sums[s]) * down[s] == (sums[t + step] - sums[t]) * down[t]
        length[fits[equal]] += step
        step //= 2
    out[pair] = length
    return out


def repeated_runs(items: np.ndarray, first: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each item the length of the longest run from it that occurs again in its row (0 if
    under ``shortest``), and whether a run of such length covers it."""
    order = suffix_array(items, first)
    lcp = common_prefixes(items, first, order)
    longest = np.empty(len(items), np.int64)
    longest[order] = np.maximum(lcp, np.append(lcp[1:], 0)) if len(items) else lcp
    longest[longest < shortest] = 0
    at = np.flatnonzero(longest)
    cover = np.zeros(len(items) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + longest[at], -1)
    return longest, np.cumsum(cover)[:-1] > 0


def _repeats(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a key occurs before in its row, and whether it occurs twice or more."""
    order = np.lexsort((keys, W.rows_of(first)))
    row = W.rows_of(first)[order]
    same = (keys[order][1:] == keys[order][:-1]) & (row[1:] == row[:-1])
    later, several = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True  # lexsort is stable: the first of a key comes first
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return later, several


def measures(column, shortest: int = SHORTEST) -> dict[str, np.ndarray]:
    """Per text: counts of words, their code points, symbols, repeated lines and words in
    repeated three-word windows; words covered by repeated substrings; the longest repeat."""
    data, offsets = W.buffers(column)
    starts, ends, first = W.word_spans(data, offsets)
    hashes = W.span_hashes(data, starts, ends)

    def count(flags: np.ndarray) -> np.ndarray:
        return W.totals(flags.astype(np.int64), offsets)

    line_start, line_end, line_first = W.line_spans(data, offsets)
    again, _ = _repeats(W.span_hashes(data, line_start, line_end), line_first)
    grams, begin = W.gram_hashes(hashes, first, 3)
    _, several = _repeats(grams, begin)
    at = np.flatnonzero(several)
    at = at + np.repeat(first[:-1] - begin[:-1], np.diff(begin))[at]  # word at which the window starts
    window = np.zeros(len(hashes), bool)
    for k in range(3):
        window[at + k] = True
    longest, covered = repeated_runs(hashes, first, shortest)
    row = W.rows_of(first)
    top = np.zeros(len(first) - 1, np.int64)
    np.maximum.at(top, row, longest)
    return {
        "n_words": np.diff(first).astype(np.int64),
        "word_chars": count(((data & 0xC0) != 0x80) & ~W.IS_SPACE[data]),
        "n_symbols": count(_SYMBOL[data]),
        "n_dup_lines": W.totals(again.astype(np.int64), line_first),
        "n_repeat_words": W.totals(window.astype(np.int64), first),
        "covered_words": W.totals(covered.astype(np.int64), first),
        "longest_repeat": top,
    }


def repetition_rules(
    docs: DataFrame,
    text: str = "text",
    shortest: int = SHORTEST,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """``docs`` with the measures of every whole text and ``base_failed``, ``kept``.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, compared as they stand.
    ``base_failed``: under 50 words, or more than half of the words in repeated three-word
    windows. ``kept``: not that, at most ``max_covered`` of the words within repeated
    substrings of ``shortest`` words or more, and none longer than ``max_repeat``.
    Null and empty texts have zero words and fail. Other columns pass through; columns
    named like the results are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]

    def compute(column):
        m = measures(column, shortest)
        return [pa.array(m[n]) for n in names]

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = add_columns(docs, text, [(n, "long") for n in names], compute, 1 << 21).withColumn("base_failed", failed)
    mild = (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat)
    return found.withColumn("kept", ~F.col("base_failed") & mild)
