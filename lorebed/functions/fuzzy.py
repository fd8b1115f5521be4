"""Similarity of strings from 0 to 100, by their longest common subsequence, as pandas UDFs."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _common(a: str, windows: np.ndarray) -> np.ndarray:
    """The length of the longest common subsequence of ``a`` and each row of code points (0: no character)."""
    width = -(-len(a) // 63)
    points = np.frombuffer(a.encode("utf-32-le"), dtype=np.uint32)
    masks: dict[int, np.ndarray] = {}
    for i, p in enumerate(points.tolist()):
        masks.setdefault(p, np.zeros(width, np.uint64))[i // 63] |= np.uint64(1 << (i % 63))
    known = np.array(sorted(masks), dtype=np.uint32)
    table = np.concatenate([np.stack([masks[k] for k in known.tolist()]), np.zeros((1, width), np.uint64)])
    place = np.searchsorted(known, windows)
    place = np.where((place < len(known)) & (known[np.minimum(place, len(known) - 1)] == windows), place, len(known))
    full = np.uint64((1 << 63) - 1)
    state = np.full((len(windows), width), full, dtype=np.uint64)
    for j in range(windows.shape[1]):
        hit = table[place[:, j]]
        carry = np.zeros(len(windows), dtype=np.uint64)
        for w in range(width):
            s, u = state[:, w], state[:, w] & hit[:, w]
            total = s + u + carry
            carry = total >> np.uint64(63)
            state[:, w] = (total & full) | (s & ~hit[:, w])
    return len(a) - sum(np.bitwise_count(state[:, w] & np.uint64((1 << min(63, len(a) - 63 * w)) - 1)).astype(int) for w in range(width))


def _common_few(a: str, windows: np.ndarray) -> np.ndarray:
    """As ``_common``, window by window in whole numbers, which is quicker for few of them."""
    masks: dict[int, int] = {}
    for i, c in enumerate(a):
        masks[ord(c)] = masks.get(ord(c), 0) | 1 << i
    full = (1 << len(a)) - 1
    out = []
    for window in windows.tolist():
        state = full
        for c in window:
            hit = state & masks.get(c, 0)
            state = (state + hit | state - hit) & full
        out.append(len(a) - state.bit_count())
    return np.array(out, dtype=np.int64)


def ratio(a: str, b: str) -> float:
    """200 common / (|a| + |b|); two empty strings are alike."""
    if not a or not b:
        return 100.0 * (a == b)
    row = np.frombuffer(b.encode("utf-32-le"), dtype=np.uint32)[None, :]
    return 200.0 * int(_common(a, row)[0]) / (len(a) + len(b))


@lru_cache(maxsize=2)
def _bigrams(text: str) -> np.ndarray:
    """A number below 2 ** 16 for each two neighbouring characters; different pairs may share one."""
    p = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    return ((p[:-1] * np.uint64(0x9E3779B1) + p[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7) & np.uint64(0xFFFF)).astype(np.uint16)


_SEEN = np.zeros(1 << 16, dtype=bool)


def _may_reach(a: str, b: str, begin: np.ndarray, size: np.ndarray, cutoff: float) -> np.ndarray:
    """Whether the stretches of b have enough bigrams of a for a ratio of ``cutoff``.

    With c characters in common, each of the |a| - c others breaks two bigrams of a at most, and each of the stretch's own others one; so
    3 c - |a| - size - 1 bigrams of a are in the stretch, and c is cutoff (|a| + size) / 200 at least.
    """
    own = _bigrams(a)
    _SEEN[own] = True
    found = np.concatenate([[0], np.cumsum(_SEEN[_bigrams(b)])])
    _SEEN[own] = False
    there = found[begin + np.maximum(size, 1) - 1] - found[begin]
    return there >= (1.5 * cutoff / 100 - 1) * (len(a) + size) - 1 - 1e-9


def partial_ratio(a: str, b: str, cutoff: float = 0.0) -> float:
    """The best ratio of the shorter string with a stretch of the longer of its length, or a shorter one at either end.

    0 if that is below the cutoff, which saves looking at most stretches: those with too few of its bigrams are never compared.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 * (not b)
    if a in b:
        return 100.0
    m = len(a)
    points = np.frombuffer(b.encode("utf-32-le"), dtype=np.uint32)
    padded = np.concatenate([np.zeros(m - 1, np.uint32), points, np.zeros(m - 1, np.uint32)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, m)
    places = np.arange(len(windows))
    size = np.minimum(np.minimum(places + 1, m), len(windows) - places)
    # Windows one place apart have common subsequences that differ by one at most, so a coarse grid bounds what lies between.
    bound = np.minimum(size, m)
    if cutoff > 200 / 3:
        possible = _may_reach(a, b, np.maximum(places - m + 1, 0), size, cutoff)
        if not possible.any():
            return 0.0
        # The others have less in common than the cutoff asks for.
        bound = np.where(possible, bound, np.minimum(bound, np.ceil(cutoff * (m + size) / 200 - 1e-9).astype(bound.dtype) - 1))
    known = np.zeros(len(windows), dtype=bool)
    best, found, stride = max(0.0, cutoff - 1e-9), 0.0, 1 << max(0, (m // 2).bit_length() - 1)
    while stride:
        open_ = np.flatnonzero(~known[::stride] & (200.0 * bound[::stride] > best * (m + size[::stride]))) * stride
        for part in np.array_split(open_, max(1, len(open_) * m >> 21)):
            if len(part):
                bound[part] = (_common_few if len(part) < 100 else _common)(a, windows[part])
                known[part] = True
                found = max(found, float((200.0 * bound[part] / (m + size[part])).max()))
                best = max(best, found)
        bound = np.minimum(np.minimum.accumulate(bound - places) + places, np.minimum.accumulate((bound + places)[::-1])[::-1] - places)
        stride >>= 1
    return found if found >= cutoff else 0.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


#: Lanes that are compared at once, and different stretches among them; characters of a stretch; lanes that are made at once; lanes that aren't worth it.
_LANES, _COLUMNS, _STRETCH, _MOST, _FEW = 16384, 4096, 512, 1 << 16, 256


def _buckets(text: str) -> np.ndarray:
    """Each character as a number from 1 to 127; two that share one can only make texts more alike."""
    p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(p < 128, np.maximum(p, 1), p % 31 + 1).astype(np.uint8)


def _least_edits(masks: np.ndarray, sizes: np.ndarray, piece: np.ndarray, stretches: list[np.ndarray], stretch: np.ndarray) -> np.ndarray:
    """For each lane the least edit distance of its piece (up to 64 characters) to any part of its stretch: Myers' bit vectors, one character of all lanes at a time.

    A piece stands in the high bits of its masks; the bits below match everything, so that they add nothing. Lanes are in order of their stretches, the longest first.
    """
    columns, place = np.unique(stretch, return_inverse=True)
    lengths = np.array([len(stretches[c]) for c in columns.tolist()])
    longest, ends = int(lengths.max()), lengths[place]
    table = np.zeros((longest, len(columns)), np.int64)
    for i, c in enumerate(columns.tolist()):
        table[: lengths[i], i] = stretches[c]
    flat, base, one, high = masks.reshape(-1), piece * 128, np.uint64(1), np.uint64(63)
    best = sizes[piece].astype(np.int64)
    score = best.copy()
    vp = ~np.uint64(0) << (np.uint64(64) - sizes[piece].astype(np.uint64))
    vn = np.zeros(len(piece), np.uint64)
    n = len(piece)
    at, eq, t, d0, hp, hn = np.empty(n, np.int64), *(np.empty(n, np.uint64) for _ in range(5))
    all_best = best
    for j in range(longest):
        if j % 64 == 0 and (left := int(np.searchsorted(-ends, -j))) < n:
            n = left
            place, base, best, score, vp, vn, at, eq, t, d0, hp, hn = (x[:n] for x in (place, base, best, score, vp, vn, at, eq, t, d0, hp, hn))
        np.take(table[j], place, out=at, mode="clip")
        np.add(at, base, out=at)
        np.take(flat, at, out=eq, mode="clip")
        np.bitwise_or(eq, vn, out=eq)
        np.bitwise_and(eq, vp, out=t)
        np.add(t, vp, out=t)
        np.bitwise_xor(t, vp, out=t)
        np.bitwise_or(t, eq, out=d0)
        np.bitwise_and(vp, d0, out=hn)
        np.bitwise_or(vp, d0, out=t)
        np.invert(t, out=t)
        np.bitwise_or(vn, t, out=hp)
        np.right_shift(hp, high, out=t)
        np.add(score, t.view(np.int64), out=score)
        np.right_shift(hn, high, out=t)
        np.subtract(score, t.view(np.int64), out=score)
        np.minimum(best, score, out=best)
        np.left_shift(hp, one, out=hp)
        np.left_shift(hn, one, out=hn)
        np.bitwise_or(d0, hp, out=vp)
        np.invert(vp, out=vp)
        np.bitwise_or(vp, hn, out=vp)
        np.bitwise_and(hp, d0, out=vn)
    return all_best


def _open(pairs: list[tuple[str, str]], share: float) -> np.ndarray:
    """Whether the pieces of each first text, the shorter one, are so close to parts of the second that ``share`` of its length covers their edits."""
    known, stretches, at = {}, [], []
    for _, b in pairs:
        if b not in known:
            points, cuts = _buckets(b), range(0, max(1, len(b) - 128), _STRETCH)
            known[b] = (len(stretches), len(cuts))
            stretches += [points[k : k + _STRETCH + 128] for k in cuts]
        at.append(known[b])
    first, many = np.array(at, dtype=np.int64).T
    length = np.array([len(s) for s in stretches])
    size = np.array([len(a) for a, _ in pairs], dtype=np.int64)
    count = -(-size // 64)
    owner = np.repeat(np.arange(len(pairs)), count)
    own = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    sizes = size[owner] * (own + 1) // count[owner] - size[owner] * own // count[owner]
    low = (64 - sizes).astype(np.uint64)
    masks = np.repeat(np.where(low > 0, ~(~np.uint64(0) << low), np.uint64(0))[:, None], 128, axis=1)
    number = np.repeat(np.arange(len(owner)), sizes)
    bit = (np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 64 - sizes[number]).astype(np.uint64)
    np.bitwise_or.at(masks, (number, np.concatenate([_buckets(a) for a, _ in pairs]).astype(np.int64)), np.uint64(1) << bit)
    open_, edits = np.ones(len(pairs), dtype=bool), np.zeros(len(pairs))
    # Over half of the pieces are mostly enough to tell; the others are looked at where they aren't.
    soon = own <= (0.55 * count[owner]).astype(np.int64)
    for turn in (soon, ~soon):
        asked = np.flatnonzero(turn & open_[owner])
        times = many[owner[asked]]
        piece = np.repeat(asked, times)
        if len(piece) < _FEW:
            break
        stretch = first[owner[piece]] + np.arange(len(piece)) - np.repeat(np.cumsum(times) - times, times)
        order = np.lexsort((stretch, -length[stretch]))
        piece, stretch = piece[order], stretch[order]
        column = np.cumsum(np.diff(stretch, prepend=stretch[0]) != 0)
        least, begin = np.full(len(owner), 64), 0
        while begin < len(piece):
            end = min(begin + _LANES, int(np.searchsorted(column, column[begin] + _COLUMNS)))
            np.minimum.at(least, piece[begin:end], _least_edits(masks, sizes, piece[begin:end], stretches, stretch[begin:end]))
            begin = end
        edits += np.bincount(owner[asked], weights=least[asked], minlength=len(pairs))
        open_ &= edits <= share * size + 1e-9
    return open_


def may_be_close(pairs: list[tuple[str, str]], cutoff: float) -> np.ndarray:
    """False for pairs of texts whose partial ratio is below ``cutoff`` for sure; many pairs cost a small part of what comparing them does.

    A ratio of ``cutoff`` leaves 2 m (1 - cutoff / 100) insertions and deletions at most between the shorter text, of m characters, and a stretch of the longer one.
    Cut in pieces, the shorter one's edit distances to whatever each piece is closest to in the longer one can't be more together. No such part is longer than two
    pieces, so long texts are cut in stretches that overlap by as much.
    """
    maybe = np.ones(len(pairs), dtype=bool)
    if cutoff <= 50 or not pairs:
        return maybe
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    lanes = np.cumsum([(len(a) // 64 + 1) * (len(b) // _STRETCH + 1) for a, b in pairs])
    for group in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(lanes // _MOST)) + 1):
        maybe[group] = _open([pairs[i] for i in group.tolist()], 2 * (1 - cutoff / 100))
    return maybe


def partial_at_least(threshold: float):
    """A UDF of two texts: whether their partial ratio is the threshold or more."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a), dtype=bool)
        given = np.flatnonzero(a.notna() & b.notna())
        pairs = list(zip(a.iloc[given], b.iloc[given]))
        for i in np.flatnonzero(may_be_close(pairs, threshold)).tolist():
            out[given[i]] = partial_ratio(*pairs[i], threshold) >= threshold
        return pd.Series(out)

    return F.pandas_udf(run, T.BooleanType())


def _pairwise(function):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else function(x, y) for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(run, T.DoubleType())


ratio_udf, partial_ratio_udf, token_sort_ratio_udf = map(_pairwise, (ratio, partial_ratio, token_sort_ratio))
