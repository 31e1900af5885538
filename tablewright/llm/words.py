"""Word, line and hash kernels over Arrow text columns.

A text column arrives in a task as one byte buffer and its offsets, so words, lines and
their 64-bit hashes are found for a whole batch with array operations. Nothing here
keeps state between batches, and temporaries are a small multiple of a window of
``WINDOW`` bytes, however long a text is.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 18
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_U = np.uint64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1, from 0) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    raw = column.buffers()
    if raw[1] is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(raw[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text at most (or one row)."""
    if batch.num_rows == 0:
        return
    _, offsets = buffers(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that lie within one row."""
    if len(inside) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(inside)]
    begins[at] = inside[at]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    at = offsets[1:][offsets[1:] > 0] - 1
    ends[at] = inside[at]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes other than 0x20 and 0x09-0x0D), and for
    each row the index of its first word (rows + 1)."""
    starts, ends = _runs(~IS_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the ``\\n``-separated lines that hold a word, and each row's first."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    starts, ends = _runs(data != 10, offsets)
    filled = np.concatenate([[0], np.cumsum(~IS_SPACE[data])])
    keep = filled[ends] > filled[starts]
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offsets)


def kept(name: str, make: Callable[[], object]):
    """What ``make`` gives, made once in a process.

    Functions travel to tasks by value, so a module's own variables would begin anew in
    every task; a module of this name lives as long as the worker.
    """
    store = sys.modules.setdefault("tablewright_kept", ModuleType("tablewright_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse, modulo 2**64."""

    def make(size: int) -> tuple[np.ndarray, np.ndarray]:
        inverse = pow(MULTIPLIER, -1, 1 << 64)
        return np.cumprod(np.r_[_U(1), np.full(size, _U(MULTIPLIER))]), np.cumprod(np.r_[_U(1), np.full(size, _U(inverse))])

    return kept("powers", lambda: make(WINDOW)) if n <= WINDOW else make(n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial in the bytes, from prefix sums.

    Spans are ordered and do not overlap. Work goes window by window, so the sums stay
    in cache; a span longer than a window has one of its own.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + WINDOW, side="right")), first + 1)
        low, high = int(starts[first]), int(ends[last - 1])
        up, down = powers(high - low)
        sums = np.empty(high - low + 1, np.uint64)
        sums[0] = 0
        np.cumsum((data[low:high].astype(np.uint64) + _U(1)) * up[: high - low], out=sums[1:])
        s = starts[first:last] - low
        out[first:last] = (sums[ends[first:last] - low] - sums[s]) * down[s]
        first = last
    return mix(out)


def word_hashes(column, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a text column, and each row's first word (rows + 1)."""
    data, offsets = buffers(column)
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(FOLD[data] if fold else data, starts, ends), first


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each item, given each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the items of each row."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def gram_hashes(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` items within a row, and each row's first run."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    if begin[-1] == 0:
        return np.zeros(0, np.uint64), begin
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
    out = hashes[at]
    for k in range(1, n):
        out = out * _U(MULTIPLIER) + hashes[at + k]
    return mix(out), begin
