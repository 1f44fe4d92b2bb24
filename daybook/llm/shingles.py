"""Vectorised words and word shingles of Arrow string arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_KIND = np.random.default_rng(20240229)
_VALUES = _KIND.integers(1, 2**63, 256, dtype=np.uint64)
_VALUES[65:91] = _VALUES[97:123]  # A-Z count as a-z
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes that are hashed at a time; a longer text is taken whole.
SLICE = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; a null is empty."""
    texts = texts.cast(pa.large_utf8()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def slices(at: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def _word_hashes(at: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and how many words come before each text."""
    low = data[at[0] : at[-1]]
    at = at - at[0]
    if not len(low):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    solid = ~_WHITE[low]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = at[(at > 0) & (at < len(low))]  # a text ends the word before it
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    sums = np.cumsum(_VALUES[low] * _powers(_STEP, len(low)), dtype=np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), sums])
    hashes = (before[ends + 1] - before[starts]) * _powers(_BACK, len(low))[starts]
    length = (ends - starts).astype(np.uint64)
    return mixed(hashes + length * _MIX2), np.searchsorted(starts, at)


def shingle_hashes(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text, the 64-bit hash of every run of ``width`` words, in order.

    Upper-case A-Z count as lower case. A text with fewer words is one shingle
    of all of them; one without words has none.
    """
    at, data = buffers(texts)
    for first, last in slices(at, SLICE):
        word, index = _word_hashes(at[first : last + 1], data)
        run = np.zeros(max(0, len(word) - width + 1), np.uint64)
        for k in range(width):
            run = run * _STEP + word[k : k + len(run)]
        run = mixed(run)
        for i in range(last - first):
            a, b = int(index[i]), int(index[i + 1])
            if b - a >= width:
                yield run[a : b - width + 1]
            elif b > a:
                whole = np.uint64(b - a)
                for h in word[a:b]:
                    whole = np.uint64((int(whole) * int(_STEP) + int(h)) & (2**64 - 1))
                yield mixed(np.array([whole], np.uint64))
            else:
                yield np.empty(0, np.uint64)
