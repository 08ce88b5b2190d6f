"""Hashed word shingles of whole texts, many texts at once.

Words are the runs of anything but [\x20\x09-\x0D]; A-Z count as a-z.  A text's set holds its distinct
shingles of ``width`` words; a text of fewer words is one shingle, the whole sequence; a text without
words has an empty set.  Shingles are 64-bit hashes: a polynomial over a random value a byte for words,
another over words, then a mix.
"""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (shift, multiply, twice)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_VALUE[65:91] = _VALUE[97:123]
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Shingler:
    def __init__(self, width: int):
        self.width = width
        self.up, self.down = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)
        self.step = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(width)]

    def words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Each word's start and hash."""
        b = np.frombuffer(raw, np.uint8)
        n = len(b)
        if n + 1 > len(self.up):
            self.up, self.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        dark = np.zeros(n + 2, bool)
        np.logical_not(_WHITE[b], out=dark[1:-1])
        edge = np.flatnonzero(dark[1:] != dark[:-1])
        start, end = edge[::2], edge[1::2]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[b] * self.up[:n], out=total[1:])
        return start, (total[end] - total[start]) * self.down[start]

    def shingles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' shingles, one after the other, repeats included, and how many each text has."""
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        start, word = self.words(b"\n".join(raws))
        ends = np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws)))
        upto = np.searchsorted(start, ends)
        n_words = np.diff(upto, prepend=0)
        w = self.width
        count = np.where(n_words >= w, n_words - w + 1, np.minimum(n_words, 1))
        at = np.repeat(upto - n_words - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        padded = np.concatenate([word, np.zeros(w, np.uint64)])
        mixed = np.zeros(len(at), np.uint64)
        for k in range(w):
            mixed += mix(padded[at + k]) * self.step[k]
        short = np.flatnonzero((n_words > 0) & (n_words < w))
        place = (np.cumsum(count) - count)[short]
        for i, p in zip(short.tolist(), place.tolist(), strict=True):
            own = mix(word[upto[i] - n_words[i] : upto[i]])
            mixed[p] = np.uint64((sum(int(x) * int(s) for x, s in zip(own, self.step, strict=False)) + n_words[i].item() * _BASE) & _MASK)
        return mix(mixed), count
