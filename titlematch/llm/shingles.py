"""Hashes of word shingles, over whole Arrow string batches at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Bytes hashed at a time; a longer text is hashed alone.
CHUNK_BYTES = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            size = max(n, CHUNK_BYTES)
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(size, b, dtype=np.uint64))) for b in (_BASE, inverse))
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``data``: UTF-8 bytes of texts one after the other, ``starts``: where each
    begins.  Returns a hash per word (A-Z folded) and the index of its text."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = starts[(starts > 0) & (starts < len(data))]
    first[inner] |= word[inner]
    last[inner - 1] |= word[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _POWERS.upto(len(data) + 1)
    total = np.cumsum(_BYTE[data] * up[: len(data)])
    before = np.where(begin > 0, total[begin - 1], np.uint64(0))
    hashes = mixed((total[end] - before) * down[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(starts, begin, side="right") - 1


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: every ``words``
    consecutive words, or the whole text where it has fewer.  Null and empty
    texts have an empty set."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    out: list[np.ndarray] = []
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, side="right")) - 1)
        b = min(b, len(texts))
        out.extend(_sets(data[offsets[a] : offsets[b]], offsets[a:b] - offsets[a], words))
        a = b
    return out


def _sets(data: np.ndarray, starts: np.ndarray, words: int) -> list[np.ndarray]:
    hashes, text = word_hashes(data, starts)
    n = np.bincount(text, minlength=len(starts))
    begin = np.cumsum(n) - n
    rolled = hashes.copy()
    full = len(hashes) - words + 1
    if full > 0 and words > 1:
        rolled = hashes[:full].copy()
        for j in range(1, words):
            rolled = mixed(rolled * _BASE + hashes[j : full + j])
    sets = []
    for a, k in zip(begin.tolist(), n.tolist(), strict=True):
        if k >= words:
            sets.append(np.unique(rolled[a : a + k - words + 1]))
        elif k:
            h = hashes[a : a + 1] ^ np.uint64(k)
            for j in range(1, k):
                h = mixed(h * _BASE + hashes[a + j : a + j + 1])
            sets.append(h)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
