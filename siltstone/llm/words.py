"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than 0x20 and 0x09-0x0D. A word's hash is a polynomial
over a random table of byte values, mixed; it comes from two prefix sums, so a block
of texts is hashed by a few numpy passes. Sequences of words mix their words' hashes
with one multiplier per place.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _TABLE.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _TABLE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < length:
        size = max(length, BLOCK_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection, so equal outputs mean equal inputs."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its int64 offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, ends.astype(np.int64)


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows of about ``size`` bytes."""
    raw, ends = buffers(column)
    row, rows = 0, len(ends) - 1
    while row < rows:
        stop = int(np.searchsorted(ends, ends[row] + size, side="right")) - 1
        stop = min(rows, max(stop, row + 1))
        yield row, stop, raw[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: workers are used again, and share a machine's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def gives_back(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run`` for a Python worker: at its end, when what it held is gone, memory goes back to the system.

    A worker that waits for its next task would keep it, beside the stages that need none.
    """

    @functools.wraps(run)
    def task(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


class Words:
    """Word hashes of a block: ``hashes`` of all words, ``first[i]:first[i + 1]`` those of row i."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, fold: bool):
        space = _SPACE[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[ends] = True
        solid = ~space
        opens = solid.copy()
        opens[1:] &= space[:-1] | edge[1:-1]
        closes = solid.copy()
        closes[:-1] &= space[1:] | edge[1:-1]
        self.starts = np.flatnonzero(opens)
        self.stops = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, ends)
        self.hashes = spans(raw, self.starts, self.stops, fold)


def spans(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, fold: bool = False) -> np.ndarray:
    """One hash of the bytes from each start to its stop."""
    power, inverse = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_FOLDED if fold else _TABLE)[raw] * power[: len(raw)], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * inverse[starts])


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 places have none."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    last = len(hashes) - n + 1
    total = hashes[:last] * _PLACES[0]
    for place in range(1, n):
        total += hashes[place : place + last] * _PLACES[place]
    return mixed(total)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-word shingles of each row, end to end, and their offsets.

    A row of fewer words has one shingle, its whole sequence; a row without words none.
    """
    counts = np.diff(words.first)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    grams = windows(words.hashes, n)
    values = np.empty(ends[-1], dtype=np.uint64)
    begins, bounds = words.first.tolist(), ends.tolist()
    for row, count in enumerate(counts.tolist()):
        a, b = bounds[row], bounds[row + 1]
        if count >= n:
            values[a:b] = grams[begins[row] : begins[row] + b - a]
            values[a:b].sort()
        elif count:
            short = words.hashes[begins[row] : begins[row] + count] * _PLACES[:count]
            values[a] = mixed(short.sum(keepdims=True) + _PLACES[63 - count : 64 - count])[0]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[ends[:-1][sizes > 0]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[ends]


def per_row(values: np.ndarray, ends: np.ndarray, reduce: np.ufunc) -> np.ndarray:
    """``reduce`` over each row's values; 0 for a row without any."""
    out = np.zeros(len(ends) - 1, dtype=values.dtype)
    some = ends[1:] > ends[:-1]
    if some.any():
        out[some] = reduce.reduceat(values, ends[:-1][some])
    return out


def set_hashes(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A signed 64-bit hash of each row's set, whatever the order of its values; 0 for an empty set."""
    total = per_row(mixed(values + np.uint64(_BASE)), ends, np.add)
    other = per_row(mixed(values ^ _PLACES[62]), ends, np.bitwise_xor)
    sizes = np.diff(ends).astype(np.uint64)
    both = mixed(total ^ (other * _PLACES[61] + sizes)).view(np.int64)
    both[sizes == 0] = 0
    return both
