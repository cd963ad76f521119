"""Vectorised word and gram hashing over Arrow string columns.

A column is worked through in blocks of whole texts; inside a block every step is one
NumPy pass over all bytes or words, so there is no Python loop over words. Hashes are
polynomials modulo 2**64 with odd random multipliers, finished with a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
U = np.uint64
_BASE = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
_pow: list[list[np.ndarray]] = [[], []]


def _table(letters_only: bool, lower: bool) -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    if letters_only:
        t[:128] = 32
        t[48:58] = np.arange(48, 58)
        t[97:123] = np.arange(97, 123)
        t[65:91] = np.arange(97, 123)
    else:
        t[9:14] = 32
        if lower:
            t[65:91] = np.arange(97, 123)
    return t


#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of A-Z lower-cased text; words [^\x20\x09-\x0D]+ of it; the same words unchanged.
LETTERS, LOWER, PLAIN = _table(True, True), _table(False, True), _table(False, False)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers, the same on every machine."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 0xD6E8FEB86659FD93 % (1 << 64))) | U(1)


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if not _pow[which] or len(_pow[which][0]) < n:
        size, out = max(n, BLOCK + 1), []
        inverse = U(pow(int(_BASE[which]), -1, 1 << 64))
        for base in (_BASE[which], inverse):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if size > 4 * BLOCK:
            return out[0][:n], out[1][:n]
        _pow[which] = out
    return _pow[which][0][:n], _pow[which][1][:n]


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of rows in them) of runs of whole texts of about BLOCK bytes; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offs = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BLOCK, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


class Words:
    """The words of a block: byte spans, hash, and each text's range of words."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray):
        d = table[data]
        n = len(d)
        ns = d != 32
        first = np.zeros(n + 1, bool)
        first[offs] = True
        begin, end = ns.copy(), ns.copy()
        if n:
            begin[1:] &= ~ns[:-1] | first[1:n]
            end[:-1] &= ~ns[1:] | first[1:n]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.bytes = d
        self.offs = np.searchsorted(self.starts, offs)  # of texts in words

    def hash(self, which: int = 0) -> np.ndarray:
        n = len(self.bytes)
        up, down = powers(n + 1, which)
        total = np.zeros(n + 1, dtype=U)
        np.cumsum((self.bytes.astype(U) + U(1)) * up[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(U))


def grams(items: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of items[i : i + k] for every i; the last k - 1 are left out."""
    m = len(items) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=U)
    out = np.zeros(m, dtype=U)
    for j, c in enumerate(constants(k, seed)):
        out += items[j : j + m] * c
    return mix(out)


def grams_at(items: np.ndarray, at: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The same as grams(items, k, seed)[at], for few places."""
    out = np.zeros(len(at), dtype=U)
    for j, c in enumerate(constants(k, seed)):
        out += items[at + j] * c
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i : i + w]) for every i with a whole window, by doubling."""
    m, span = x, 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:]) if len(m) > span else m[:0]
        span *= 2
    rest = w - span
    return m if not rest else (np.minimum(m[:-rest], m[rest:]) if len(m) > rest else m[:0])


def room(offs: np.ndarray, length: int) -> np.ndarray:
    """For each item of a block, how many items its text has from it on."""
    return np.repeat(offs[1:], np.diff(offs)) - np.arange(length)


def spread(rows: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """rows[i] for every item of text i."""
    return np.repeat(rows, np.diff(offs))


def long(x: np.ndarray) -> pa.Array:
    """64-bit hashes as signed Arrow longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
