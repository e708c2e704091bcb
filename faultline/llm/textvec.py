"""Vectorised word hashing over Arrow text columns.

A text's words are the maximal runs of ASCII letters (lower-cased), digits and characters from
U+0080 on. Every byte of a slice enters one prefix sum of a polynomial hash modulo 2^64, so the
hash of any substring is a difference of two sums; no Python object is made for a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEEP = np.zeros(256, dtype=bool)
KEEP[48:58] = KEEP[97:123] = KEEP[65:91] = True
KEEP[128:] = True
#: For bytes.translate: lower case, and a space for all that is no part of a word.
TO_WORDS = bytes(int(LOWER[i]) if KEEP[i] else 32 for i in range(256))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit of the input reaches every bit of the result."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(31)
    x *= _U64(0x7FB5D329728EA185)
    x ^= x >> _U64(27)
    x *= _U64(0x81DADEF4BC2DD44D)
    x ^= x >> _U64(33)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=_U64) * _U64(0xD1342543DE82EF95))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses up to n."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = []
        for b in (_BASE, inverse):
            p = np.full(n, b, dtype=_U64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p, dtype=_U64))
    return _POWERS[0], _POWERS[1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each (nulls are empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    n, kind = len(texts), np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not n or texts.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0] : off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def forget() -> None:
    """Drop long tables of powers, which an idle worker would keep; they are soon made again."""
    if _POWERS and len(_POWERS[0]) > 1 << 16:
        _POWERS[:] = []


class Words:
    """Words of a slice of texts: ``doc`` (row), ``start`` and ``end`` (bytes of ``data``), ``hash``; ``first`` has each row's first word."""

    def __init__(self, texts: pa.Array):
        self.data, self.off = data, off = buffers(texts)
        self.low = LOWER[data]
        keep = KEEP[data]
        before, after = np.empty_like(keep), np.empty_like(keep)
        if len(keep):
            before[0], before[1:] = False, keep[:-1]
            after[-1], after[:-1] = False, keep[1:]
            full = off[1:] > off[:-1]
            before[off[:-1][full]] = False
            after[off[1:][full] - 1] = False
        self.start = np.flatnonzero(keep & ~before)
        self.end = np.flatnonzero(keep & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        power, self._inverse = _powers(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, dtype=_U64)
        np.cumsum(_BYTE[self.low] * power[: len(data)], dtype=_U64, out=self._sum[1:])
        self.hash = self.of(self.start, self.end)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges, whatever their place."""
        return mix64((self._sum[end] - self._sum[start]) * self._inverse[start] + (end - start).astype(_U64))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of every run of ``n`` words; a row of fewer words, but not none, has one of all its words."""
        h, first, count = self.hash, self.first[:-1], np.diff(self.first)
        if not len(h):
            return np.zeros(0, np.int64), np.zeros(0, _U64)
        total = max(len(h) - n + 1, 0)
        out = np.zeros(total, dtype=_U64)
        for j in range(n):
            out += h[j : j + total] * _U64((2 * j + 3) * 0xA0761D6478BD642F & (1 << 64) - 1 | 1)
        whole = self.doc[:total] == self.doc[n - 1 : n - 1 + total]
        rows, out = self.doc[:total][whole], mix64(out[whole])
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            extra = np.zeros(len(short), dtype=_U64)
            for j in range(n - 1):
                has = count[short] > j
                extra[has] += h[first[short[has]] + j] * _U64((2 * j + 3) * 0xA0761D6478BD642F & (1 << 64) - 1 | 1)
            rows, out = np.concatenate([rows, short]), np.concatenate([out, mix64(extra)])
        return rows, out

    def text(self, first: int, last: int) -> bytes:
        """The words from ``first`` to before ``last``, joined by one space."""
        low = self.low.tobytes()[self.start[first] : self.end[last - 1]] if last - first > 64 else self.low[self.start[first] : self.end[last - 1]].tobytes()
        return b" ".join(low.translate(TO_WORDS).split())
