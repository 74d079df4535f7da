"""Vectorised word and shingle hashing over the bytes of an Arrow string column.

A word is a maximal run of bytes outside ``0x20`` and ``0x09-0x0D``.  All helpers work on slices
of a batch with a bounded number of bytes, so that memory follows ``SLICE_BYTES`` and the longest
single text, never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on unsigned 64-bit lanes."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit values made from a rule."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=_U) + _U(seed)) * _U(0x9E3779B97F4A7C15))


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Seeds of the two lanes: what is added to a word's length, and the odd factor of a step.
_SEED = ((_U(0x243F6A8885A308D3), _U(0x9E3779B97F4A7C15)), (_U(0x13198A2E03707345), _U(0xD6E8FEB86659FD93)))
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=_U)
#: Bytes from which a word is hashed alone.
LONG = 2048
_COEF: dict[int, np.ndarray] = {}
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
IS_NEWLINE = np.zeros(256, bool)
IS_NEWLINE[10] = True


def coefficients(lane: int, k: int) -> np.ndarray:
    if lane not in _COEF or len(_COEF[lane]) < k:
        _COEF[lane] = _stream((23, 37)[lane], max(k, 64)) | _U(1)
    return _COEF[lane]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the byte runs ``starts`` to ``ends``; the two lanes are independent of each other.

    Eight bytes at a time are mixed into the state by a finaliser with full avalanche, so neither order
    nor position of bytes cancels out.
    """
    if len(starts) == 0:
        return np.zeros(0, _U)
    seed, factor = _SEED[lane]
    first, last = int(starts[0]), int(ends[-1])
    padded = np.zeros(last - first + 8, np.uint8)
    padded[:-8] = _FOLD[data[first:last]] if lower else data[first:last]
    eight = np.ndarray((last - first + 1,), "<u8", padded, 0, (1,))  # the eight bytes from every place on
    size, at = ends - starts, starts - first
    with np.errstate(over="ignore"):
        state = mix64(size.astype(_U) * factor + seed)
        state = mix64((state ^ (eight[at] & _TAIL[np.minimum(size, 8)])) * factor)
        live, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
        while len(live):
            chunk = eight[at[live] + done] & _TAIL[np.minimum(size[live] - done, 8)]
            state[live] = mix64((state[live] ^ chunk) * factor)
            done += 8
            live = live[size[live] > done]
    for i in np.flatnonzero(size > LONG).tolist():
        body = padded[at[i] : at[i] + size[i]]
        state[i] = int.from_bytes(blake2b(body, digest_size=8, salt=bytes([lane])).digest(), "little")
    return state


class Slice(NamedTuple):
    """Words of consecutive rows; ``bounds[i]:bounds[i + 1]`` are the words of row ``first + i``."""

    first: int
    rows: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, row offsets from 0) for runs of rows of about ``limit`` bytes."""
    raw, offs = text_buffers(column)
    first, n = 0, len(offs) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield first, last - first, raw[offs[first] : offs[last]], offs[first : last + 1] - offs[first]
        first = last


def _pieces(data: np.ndarray, rows: int, limit: int, separators: np.ndarray) -> Iterator[tuple[int, int]]:
    """The bytes of a slice in runs; only a single long row is cut, at separators, every ``limit`` bytes or later."""
    a, n = 0, len(data)
    while a < n:
        b = n if rows > 1 else min(n, a + limit)
        while b < n and not separators[data[b]]:
            ahead = np.flatnonzero(separators[data[b : b + 4096]])
            b = b + int(ahead[0]) if len(ahead) else min(n, b + 4096)
        yield a, b
        a = b


def _runs(
    data: np.ndarray, a: int, b: int, offs: np.ndarray, lower: bool, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words in bytes a to b of a slice."""
    part, n = data[a:b], b - a
    word = ~separators[part]
    begins = np.empty(n, bool)
    begins[0] = True
    begins[1:] = ~word[:-1]
    rows = offs[:-1] - a
    begins[rows[(rows >= 0) & (rows < n)]] = True
    closes = np.empty(n, bool)
    closes[:-1] = begins[1:]
    closes[:-1] |= ~word[1:]
    closes[-1] = True
    starts = np.flatnonzero(begins & word)
    ends = np.flatnonzero(closes & word) + 1
    return starts + a, ends + a, word_hashes(part, starts, ends, lower=lower)


def word_slices(
    column: pa.Array, lower: bool = False, limit: int = SLICE_BYTES, separators: np.ndarray = IS_SPACE
) -> Iterator[Slice]:
    """Words with their 64-bit hashes, slice by slice.  ``lower`` folds A-Z only.

    With other ``separators`` (a mask over byte values) the runs are other units, such as lines.
    """
    for first, rows, data, offs in byte_slices(column, limit):
        if len(data) == 0:
            none = np.zeros(0, np.int64)
            yield Slice(first, rows, data, none, none, np.zeros(rows + 1, np.int64), np.zeros(0, _U), offs)
            continue
        parts = [_runs(data, a, b, offs, lower, separators) for a, b in _pieces(data, rows, limit, separators)]
        starts, ends, hashes = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))
        yield Slice(first, rows, data, starts, ends, np.searchsorted(starts, offs), hashes, offs)


def window_hashes(hashes: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of every run of k consecutive words; word hashes of both lanes, each with its own, give 128 bits."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    factors = coefficients(lane, k)
    with np.errstate(over="ignore"):
        out = np.zeros(n, _U)
        for j in range(k):
            out += hashes[j : j + n] * factors[j]
        return mix64(out)


def run_hash(hashes: np.ndarray, lane: int = 0) -> int:
    """Hash of a whole sequence of words."""
    return int(window_hashes(hashes, len(hashes), lane)[0])


def inside(bounds: np.ndarray, k: int, total: int) -> np.ndarray:
    """Mask over window starts: true where the k words lie in one row."""
    ok = np.ones(max(total - k + 1, 0), bool)
    for edge in bounds[1:-1]:
        ok[max(edge - k + 1, 0) : edge] = False
    return ok


def shingle_sets(s: Slice, k: int, lane: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct sorted shingle hashes).  Fewer than k words: the whole sequence as one."""
    wins = window_hashes(s.hashes, k, lane)
    for i in range(s.rows):
        a, b = int(s.bounds[i]), int(s.bounds[i + 1])
        if b - a >= k:
            yield s.first + i, np.unique(wins[a : b - k + 1])
        elif b > a:
            salted = np.array([run_hash(s.hashes[a:b], lane)], _U)
            with np.errstate(over="ignore"):
                yield s.first + i, mix64(salted + _U(b - a))
        else:
            yield s.first + i, np.zeros(0, _U)


def string_at(s: Slice, a: int, b: int) -> str:
    return bytes(s.data[a:b]).decode("utf-8", "replace")
