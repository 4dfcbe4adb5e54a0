"""Vectorised words and word n-gram hashes over Arrow string columns.

A word is a maximal run of "word bytes" of the UTF-8 text; A-Z count as a-z.
Both word classes used here are closed under UTF-8: every byte of a non-ASCII
character is a word byte, so working on bytes equals working on code points.

* ``ALNUM``  words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text
* ``SPACED`` words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text
* ``LETTERS`` words ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of the lower-cased text

Hashes are 64 bits wide.  Two different words or n-grams share a hash with
probability about 2**-64, so equality of hashes stands for equality of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES)

ALNUM = ((_LOWER >= 0x30) & (_LOWER <= 0x39)) | ((_LOWER >= 0x61) & (_LOWER <= 0x7A)) | (_BYTES >= 0x80)
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
LETTERS = ((_LOWER >= 0x61) & (_LOWER <= 0x7A)) | (_BYTES >= 0x80)

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 17  # bytes hashed at once; one table of powers serves every piece


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix((_LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
_VALUES_OF = {id(t): np.where(t, _VALUES, np.uint64(0)) for t in (ALNUM, SPACED)}
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def portions(offsets: np.ndarray, size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text; a longer row stands alone."""
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def _cut(is_word: np.ndarray, edge: np.ndarray, start: int) -> int:
    """Where a piece that begins at start may end: not inside a word."""
    n = len(is_word)
    end = start + _PIECE
    while end < n and is_word[end] and is_word[end - 1] and not edge[end]:
        end += 1
    return min(end, n)


def lowered(raw: np.ndarray) -> np.ndarray:
    """Bytes with a-z for A-Z."""
    return _LOWER.astype(np.uint8)[raw]


def spans(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of every word; rows' ends end words."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = table[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    return starts, np.flatnonzero(inside[:-1] & (~inside[1:] | edge))


def word_hashes(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of its first word per row with the total last)."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    is_word = table[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    before &= ~edge[:-1]
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    after &= ~edge[1:]
    ends = np.flatnonzero(is_word & ~after) + 1
    values = _VALUES_OF[id(table)] if id(table) in _VALUES_OF else np.where(table, _VALUES, np.uint64(0))
    out = np.empty(len(starts), np.uint64)
    done = at = 0
    while at < n:
        end = _cut(is_word, edge, at)
        up, down = _power_tables(max(_PIECE, end - at))
        sums = np.empty(end - at + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[raw[at:end]] * up[: end - at], out=sums[1:])
        last = int(np.searchsorted(starts, end))
        s, e = starts[done:last] - at, ends[done:last] - at
        out[done:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        done, at = last, end
    return mix(out), np.searchsorted(starts, offsets)


def ngrams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words, rows' ends not heeded."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for i in range(1, k):
        out *= np.uint64(0xC6A4A7935BD1E995)
        out += words[i : i + n]
    return mix(out + np.uint64(k))


def sequence_hash(words: np.ndarray) -> int:
    """Hash of one whole run of words, equal to ``ngrams(words, len(words))[0]``."""
    return int(ngrams(words, len(words))[0])
