"""Words and word-window hashes of Arrow string columns, computed with numpy over the UTF-8 buffer.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D inside one text. Hashes have 64
bits and are the same on every machine: words of up to LONG_WORD bytes are polynomials modulo 2**64, longer
ones, for which such polynomials have systematic collisions, are BLAKE2 digests. A text is never cut: a
batch is taken in parts at text boundaries only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PART_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators that leave letters, digits and everything beyond ASCII.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[128:] = False
PUNCTUATION[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_GAMMA = np.uint64(0xD1342543DE82EF95)
_OTHER = np.uint64(0xA0761D6478BD642F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER = _VALUE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
LONG_WORD = 48
_powers: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, from 0 to ``n`` at least; workers keep them, so not many more."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1 + n // 8, PART_BYTES // 16)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            tables.append(np.multiply.accumulate(p))
        _powers[:] = tables
    return _powers[0], _powers[1]


def text_parts(column: pa.Array, most: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them), of at most about ``most`` bytes unless one text is longer. Nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b, raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, and the number of words of each row. ``lower``: A-Z as a-z."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    visible = ~separators[raw]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begins = visible.copy()
    begins[1:] &= ~visible[:-1] | first[1:n]
    ends = visible.copy()
    ends[:-1] &= ~visible[1:] | first[1:n]
    at, to = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = power_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER if lower else _VALUE)[raw] * power[:n], out=total[1:])
    hashes = mixed((total[to] - total[at]) * inverse[at])
    for k in np.flatnonzero(to - at > LONG_WORD).tolist():
        word = raw[at[k] : to[k]].tobytes()
        hashes[k] = int.from_bytes(hashlib.blake2b(word.lower() if lower else word, digest_size=8).digest(), "little")
    return hashes, np.diff(np.searchsorted(at, offsets))


def window_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside one row: hash, row, position of the first word in its row."""
    if len(words) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        h *= _GAMMA
        h += words[k : len(words) - size + 1 + k]
    row = np.repeat(np.arange(len(counts)), counts)
    inside = row[: len(h)] == row[size - 1 :]
    start = np.cumsum(counts) - counts
    at = np.flatnonzero(inside)
    return mixed(h[at]), row[at], at - start[row[at]]


def second_hashes(words: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Another hash of the windows of ``size`` words that begin at words ``start``: of the same word hashes, combined by another rule."""
    words = mixed(words ^ _OTHER)
    h = words[start]
    for k in range(1, size):
        h = mixed(h + _OTHER) ^ words[start + k]
    return mixed(h)
