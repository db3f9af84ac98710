"""Vectorised word and shingle hashing over Arrow string buffers (numpy, no loop over words).

A word's hash is a polynomial in its bytes over 64-bit integers, read off a prefix sum for all words
at once and then mixed; two different words get one hash with a chance of about 2**-64.
"""

import numpy as np
import pyarrow as pa

_U = np.uint64
_P, _PINV = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_pow, _inv = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(29))) * _U(0xA0761D6478BD642F)
        return x ^ (x >> _U(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        n = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            _pow, _inv = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, k, np.uint64))]) for k in (_P, _PINV))
    return _pow, _inv


def chunks(texts: pa.Array, most: int = 1_000_000):
    """(first row, past the last, bytes, offsets) of runs of rows of about `most` bytes each; nulls read as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


class Words:
    """The words of one chunk: starts and ends (bytes), ptr (document i has words ptr[i]:ptr[i + 1]), hash.

    cuts: bytes before which a word ends and another begins, beside those that white space parts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool = True, cuts: np.ndarray | None = None):
        n = len(data)
        white = _WHITE[data]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = white[:-1], white[1:]
        before[offs[:-1][offs[:-1] < n]] = True
        after[offs[1:][offs[1:] > 0] - 1] = True
        if cuts is not None and len(cuts):
            before[cuts[cuts < n]] = True
            after[cuts[cuts > 0] - 1] = True
        self.starts, self.ends = np.flatnonzero(~white & before), np.flatnonzero(~white & after) + 1
        self.ptr = np.searchsorted(self.starts, offs)
        up, down = _powers(n + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[:n], out=sums[1:])
            self.hash = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, document, first word) of each run of n words within a document."""
        total = len(self.hash)
        if total < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            out = np.zeros(total - n + 1, np.uint64)
            for k in range(n):
                out = out * _U(0xC2B2AE3D27D4EB4F) + self.hash[k : total - n + 1 + k]
        doc = self.doc()
        ok = np.flatnonzero(doc[: total - n + 1] == doc[n - 1 :])
        return mix(out[ok]), doc[ok], ok


def shingles(data: np.ndarray, offs: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes of each document's runs of `size` words, one document after the other; where each begins, and the end).

    Fewer words: the whole sequence as one. No word: none."""
    w = Words(data, offs)
    h, doc, _ = w.grams(size)
    n = np.diff(w.ptr)
    for k in range(1, size):
        h2, d2, _ = w.grams(k)
        short = n[d2] == k
        if short.any():
            h, doc = np.concatenate([h, mix(h2[short] + _U(k))]), np.concatenate([doc, d2[short]])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


def set_ids(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set: of its size, and of two sums over its members."""
    with np.errstate(over="ignore"):
        one, two = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (mix(h + _U(1)), mix(h ^ _U(0x5851F42D4C957F2D))))
        a, b = one[ptr[1:]] - one[ptr[:-1]], two[ptr[1:]] - two[ptr[:-1]]
        return mix(a + mix(b + mix(np.diff(ptr).astype(np.uint64))))
