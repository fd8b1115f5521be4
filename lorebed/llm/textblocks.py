"""Vectorised words, word hashes and n-gram hashes over Arrow batches of texts.

Every function works on one block of texts at a time. A block is the UTF-8 bytes of
some texts laid end to end and the offset at which each begins, so that a whole block
is tokenised and hashed by a few numpy calls. Blocks hold about ``BLOCK_BYTES``, or one
text if that is longer; the temporary arrays of hashing are bounded whatever the text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
HASH_BYTES = 1 << 16
U64 = np.uint64

#: Spans are hashed in a prime field, in which unlike bytes differ for all but a few keys, whatever the bytes.
_PRIME = (1 << 31) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Scatters the bits of 64-bit values, one to one."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


@lru_cache(maxsize=2)
def _fields(key: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The powers of the key's two bases and of their inverses, modulo the prime, for the bytes of a stretch."""
    out = []
    for base in np.random.default_rng(key).integers(1 << 20, _PRIME - 1, 2).tolist():
        both = []
        for b in (base, pow(base, -1, _PRIME)):
            steps = np.ones(HASH_BYTES, dtype=U64)
            size, power = 1, b
            while size < HASH_BYTES:
                steps[size : 2 * size] = steps[:size] * U64(power) % U64(_PRIME)
                size, power = 2 * size, power * power % _PRIME
            both.append(steps)
        out.append(tuple(both))
    return out


def _reduced(x: np.ndarray) -> np.ndarray:
    """Modulo the prime, of values below 2 ** 62."""
    x = (x & U64(_PRIME)) + (x >> U64(31))
    x = (x & U64(_PRIME)) + (x >> U64(31))
    return np.where(x >= U64(_PRIME), x - U64(_PRIME), x)


def byte_table(is_word) -> np.ndarray:
    """A lookup table over the 256 byte values."""
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words that white space separates: [^\x20\x09-\x0D]+.
SPACED = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words of letters and digits; all of Unicode beyond ASCII counts: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
LETTERED = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: A-Z to a-z.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


#: A column of fewer bytes leaves little behind, and there may be thousands of them.
_WORTH_GIVING = 1 << 20


def give_back() -> None:
    """Returns to the system what this process has freed: Spark keeps idle Python workers, and their memory, through all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of block after block. A null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + block_bytes, "right")) - 1)
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last
    if at[-1] - at[0] >= _WORTH_GIVING:
        give_back()


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end) of each word in bytes, and the first word of each text with the number of words at the end."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = table[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] = inside[cut + 1]
    ends[cut - 1] = inside[cut]
    begin = np.flatnonzero(begins)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, offsets)


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, key: int = 0) -> np.ndarray:
    """A hash of each span of bytes, of 62 bits scattered over 64; spans are in order and don't overlap.

    The bytes are the coefficients of a polynomial that is taken at two points of a prime field, which the key chooses: two spans of n bytes
    collide for at most one key in (2 ** 31 / n) ** 2.
    """
    out = np.empty(len(begin), dtype=U64)
    fields = _fields(key)
    i = 0
    while i < len(begin):
        a = begin[i]
        j = max(i + 1, int(np.searchsorted(end, a + HASH_BYTES, "right")))
        b = end[j - 1]
        if b - a > HASH_BYTES:
            out[i] = _hash_long(data[a:b], key)
            i = j
            continue
        part = data[a:b].astype(U64)
        part += U64(1)
        total = np.zeros(b - a + 1, dtype=U64)
        s, e = begin[i:j] - a, end[i:j] - a
        h = np.zeros(j - i, dtype=U64)
        for powers, inverses in fields:
            np.cumsum(part * powers[: b - a], out=total[1:])
            h = (h << U64(31)) | _reduced(_reduced(total[e] - total[s]) * inverses[np.minimum(s, HASH_BYTES - 1)])
        out[i:j] = h
        i = j
    return mix(out)


def _hash_long(span: np.ndarray, key: int) -> np.uint64:
    """The same hash of one span longer than a stretch, put together from its stretches."""
    h = 0
    for powers, _ in _fields(key):
        total, step, weight = 0, int(powers[-1]) * int(powers[1]) % _PRIME, 1
        for a in range(0, len(span), HASH_BYTES):
            part = span[a : a + HASH_BYTES].astype(U64) + U64(1)
            total = (total + weight * int((part * powers[: len(part)]).sum())) % _PRIME
            weight = weight * step % _PRIME
        h = h << 31 | total
    return U64(h)


def same_spans(x: np.ndarray, x_begin: np.ndarray, x_end: np.ndarray, y: np.ndarray, y_begin: np.ndarray, y_end: np.ndarray) -> np.ndarray:
    """Whether each span of x has the same bytes as that of y."""
    size = x_end - x_begin
    same = size == y_end - y_begin
    some = np.flatnonzero(same & (size > 0))
    ends = np.cumsum(size[some])
    for part in np.split(some, np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1) if len(some) else []:
        first = np.cumsum(size[part]) - size[part]
        step = np.arange(size[part].sum()) - np.repeat(first, size[part])
        alike = x[step + np.repeat(x_begin[part], size[part])] == y[step + np.repeat(y_begin[part], size[part])]
        same[part] = np.logical_and.reduceat(alike, first)
    return same


_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=U64)


def grams(hashes: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one text, and the first gram of each text with the count at the end.

    A text of 1 to n - 1 words has one gram of all of them; a text without words has none.
    """
    lengths = np.diff(words)
    full = np.zeros(max(0, len(hashes) - n + 1), dtype=U64)
    factor = U64(1)
    for k in range(n):
        factor = U64((int(factor) * int(_ODD[0]) + 2 * k + 2) & 0xFFFFFFFFFFFFFFFF | 1)
        full += hashes[k : k + len(full)] * factor
    full = mix(full)
    count = np.where(lengths >= n, lengths - n + 1, np.minimum(lengths, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    take = np.arange(at[-1]) - np.repeat(at[:-1] - words[:-1], count)
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    if not len(short):
        return full[take], at
    out = np.empty(at[-1], dtype=U64)
    inside = np.ones(at[-1], dtype=bool)
    inside[at[short]] = False
    out[inside] = full[take[inside]]
    for i in short:
        h = 0x51ED270B27B4B1F5
        for w in hashes[words[i] : words[i + 1]].tolist():
            h = (h * int(_ODD[1]) + w) & 0xFFFFFFFFFFFFFFFF
        out[at[i]] = mix(np.array([h], dtype=U64))[0]
    return out, at


def text_of(data: np.ndarray, begin: int, end: int) -> str:
    return data[begin:end].tobytes().decode("utf-8")
