"""MinHash signatures of shingled texts, in numpy."""

from __future__ import annotations

import numpy as np

from .textblocks import SPACED, U64, grams, hash_spans, word_spans

SHINGLE = 5
_CHUNK = 1 << 14


class MinHash:
    """``size`` universal hash functions (a x + b modulo 2^64, of which the high half counts) over word shingles."""

    def __init__(self, size: int = 128, shingle: int = SHINGLE, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.size, self.shingle = size, shingle
        self.a = rng.integers(0, 1 << 63, size, dtype=U64) * U64(2) + U64(1)
        self.b = rng.integers(0, 1 << 63, size, dtype=U64) * U64(2)

    def shingles(self, data: np.ndarray, offsets: np.ndarray, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The shingle hashes of each text, repeats included, and where each text's begin; signatures need the same key throughout."""
        begin, end, at = word_spans(data, offsets, SPACED)
        return grams(hash_spans(data, begin, end, key), at, self.shingle)

    def signatures(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One row of ``size`` 32-bit minima for each text; a text without shingles has the largest value throughout."""
        out = np.full((len(at) - 1, self.size), 0xFFFFFFFF, dtype=np.uint32)
        some = np.flatnonzero(np.diff(at))
        if not len(some):
            return out
        cuts = np.unique(np.concatenate([at[some], np.arange(0, len(hashes), _CHUNK)]))
        least = np.empty((self.size, len(cuts)), dtype=U64)
        x = np.empty(_CHUNK, dtype=U64)
        for first in range(0, len(hashes), _CHUNK):
            part = hashes[first : first + _CHUNK]
            a, b = np.searchsorted(cuts, [first, first + len(part)])
            local, y = cuts[a:b] - first, x[: len(part)]
            for k in range(self.size):
                np.multiply(part, self.a[k], out=y)
                np.add(y, self.b[k], out=y)
                np.minimum.reduceat(y, local, out=least[k, a:b])
        out[some] = (np.minimum.reduceat(least, np.searchsorted(cuts, at[some]), axis=1) >> U64(32)).T
        return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The estimated Jaccard similarity of rows of equally long byte signatures: matches by chance are taken off."""
    same = (x == y).mean(axis=1)
    return np.clip((same - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)
