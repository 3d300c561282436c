"""Arrow / numpy helpers over whole texts: byte views, ASCII words, 64-bit hashes.

All work is on the UTF-8 bytes of an Arrow batch, a few MB at a time; a document is never cut for its result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# bytes handled at once by the vectorised helpers
PIECE = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_R = 0xD6E8FEB86659FD93  # odd base of the polynomial hash
_RINV = pow(_R, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads every input bit over the 64 output bits."""
    x = np.asarray(x, np.uint64) + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def uniform(h: np.ndarray) -> np.ndarray:
    """(0, 1) doubles from 64-bit hashes."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    n = len(col)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off_buf, data_buf = col.buffers()
    if n == 0 or off_buf is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(off_buf, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8)[off[0]:off[-1]] if data_buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def spans(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges [i, j) of about ``limit`` bytes, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def pieces(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, limit: int = PIECE):
    """:func:`spans`, but a document of more than twice ``limit`` bytes comes in pieces that end behind a byte of
    ``separator`` (256 flags).  Yields (i, j, bytes, offsets, more): documents [i, j), and whether the last one goes on."""
    for i, j in spans(offsets, limit):
        a, b = int(offsets[i]), int(offsets[j])
        if j - i > 1 or b - a <= 2 * limit:
            yield i, j, data[a:b], offsets[i:j + 1] - a, False
            continue
        while a < b:
            c = min(a + limit, b)
            while c < b:
                found = np.flatnonzero(separator[data[c:c + 65536]])
                if len(found):
                    c += int(found[0]) + 1
                    break
                c = min(c + 65536, b)
            yield i, j, data[a:c], np.array([0, c - a]), c < b
            a = c


def powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def rebuilt(cls, state: dict):
    """An object of ``cls`` from its attributes (broadcasts carry plain values, not classes of this package)."""
    obj = object.__new__(cls)
    obj.__dict__.update(state)
    return obj


_BYTE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(77))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = True
_WORD[0x80:] = True
WORD_BYTES = _WORD | (_LOWER != np.arange(256))  # before lower-casing


class Hasher:
    """Polynomial hashes of byte ranges by prefix sums; keeps its power tables between calls."""

    def __init__(self):
        self.p = self.q = np.zeros(0, np.uint64)

    def tables(self, n: int):
        if len(self.p) < n:
            self.p, self.q = powers(n, _R), powers(n, _RINV)
        return self.p, self.q

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """c with c[i] = hash sum of data[:i]; see :meth:`span`."""
        p, _ = self.tables(len(data) + 1)
        c = np.empty(len(data) + 1, np.uint64)
        c[0] = 0
        np.cumsum(_BYTE[data] * p[:len(data)], out=c[1:])
        return c

    def span(self, c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]; equal bytes give equal hashes wherever they stand."""
        return (c[end] - c[start]) * self.q[start]


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, hasher: Hasher):
    """Words of every document: runs of 0-9, a-z (A-Z lower-cased) and bytes from 0x80.

    Returns (start, end, hash, first): byte range and 64-bit hash of each word, and the index of each document's
    first word (n + 1 entries).  A long text is taken in pieces that end between words, so memory follows ``PIECE``.
    """
    starts, ends, hashes = [], [], []
    a, n = 0, len(data)
    low_all = lower_bytes(data)
    bounds = offsets[(offsets > 0) & (offsets < n)]
    while a < n:
        b = min(a + PIECE, n)
        if b < n:  # end the piece behind a byte that is in no word
            k = b
            while k > a and _WORD[low_all[k - 1]]:
                k -= 1
            if k == a:  # one word fills the piece: go on to its end
                k = b
                while k < n and _WORD[low_all[k]]:
                    k += 1
            b = k
        low = low_all[a:b]
        isw = _WORD[low]
        cut = bounds[np.searchsorted(bounds, a, side="right"):np.searchsorted(bounds, b)] - a
        first = isw.copy()
        first[1:] &= ~isw[:-1]
        last = isw.copy()
        last[:-1] &= ~isw[1:]
        if len(cut):
            first[cut] |= isw[cut]
            last[cut - 1] |= isw[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        c = hasher.prefix(low)
        hashes.append(mix64(hasher.span(c, s, e)))
        starts.append(s + a)
        ends.append(e + a)
        a = b
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    s, e, h = cat(starts, np.int64), cat(ends, np.int64), cat(hashes, np.uint64)
    return s, e, h, np.searchsorted(s, offsets)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words inside documents; a document of 1 .. k-1 words is one shingle.

    Returns (hashes, first index per document, n + 1 entries)."""
    n_words = np.diff(first)
    count = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(out_first[-1]) - out_first[doc] + first[doc]
    out = np.zeros(len(at), np.uint64)
    size = np.minimum(n_words, k)[doc]
    for j in range(k):
        live = j < size
        idx = np.where(live, at + j, 0)
        term = h[idx] if len(h) else np.zeros(len(at), np.uint64)
        out = np.where(live, (out ^ term) * np.uint64(_R) + np.uint64(j + 1), out)
    return mix64(out), out_first
