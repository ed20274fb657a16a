"""Vectorised reading of texts in tasks: words and word shingles as 64-bit hashes, by numpy.

Texts of an Arrow batch are worked on as one byte buffer, in blocks of bounded size. Word classes
here are decided byte by byte, which is exact for UTF-8 when all characters beyond ASCII fall into
one class.
"""

from __future__ import annotations

import ctypes
import ctypes.util

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: ASCII blanks, the characters between words in most operators.
BLANKS = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: ASCII characters that are neither digits nor letters.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_rng = np.random.default_rng(20240501)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])
_VALUES = (_rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
BYTE_VALUES = _VALUES
VALUES_LOWER = _VALUES[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_JOIN = np.uint64(0xD6E8FEB86659FD93)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """First ``n`` powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in ((0, _BASE), (1, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return [_powers[0][:n], _powers[1][:n]]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * _JOIN
    h = (h ^ (h >> np.uint64(32))) * _JOIN
    return h ^ (h >> np.uint64(32))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]] if len(at) else data, at - (at[0] if len(at) else 0)


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES):
    """(first, last) document indices of blocks of about ``limit`` bytes; one long text is a block."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray):
    """(starts, ends, words): byte bounds of the words, and each text's first word, with the total.

    ``apart`` marks the bytes between words; no word reaches over the end of a text.
    """
    word = ~apart[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    filled = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    start[first], end[last] = word[first], word[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                values: np.ndarray = VALUES_LOWER) -> np.ndarray:
    """64-bit hash of each word, letters A-Z in lower case."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words (of all words given, across texts too)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for k in range(1, size):
        h = h * _JOIN + words[k:k + n]
    return mixed(h)


def shingle_sets(column: pa.Array, shingle: int):
    """Sorted distinct shingle hashes of every text of a string column."""
    data, offsets = text_buffer(column)
    for a, b in blocks(offsets):
        part = data[offsets[a]:offsets[b]]
        starts, ends, first = word_bounds(part, offsets[a:b + 1] - offsets[a], BLANKS)
        words = word_hashes(part, starts, ends)
        grams = shingle_hashes(words, shingle)
        for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
            if j - i >= shingle:
                yield np.unique(grams[i:j - shingle + 1])
            elif j > i:
                yield shingle_hashes(words[i:j], j - i)
            else:
                yield words[:0]


def give_back() -> None:
    """Returns freed memory to the system, so that a worker kept for later tasks stays small."""
    pa.default_memory_pool().release_unused()
    name = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None
    if trim is not None:
        trim(0)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column over a byte buffer."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)),
        pa.py_buffer(np.ascontiguousarray(data))])
