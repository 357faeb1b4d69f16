"""Fingerprints of the word shingles of texts, for whole blocks at once."""

from __future__ import annotations

import functools

import numpy as np

from casebook.llm.common import unsigned_mix

#: Bytes that separate words, and what A-Z become.
SEPARATORS = [0x20, *range(0x09, 0x0E)]
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[SEPARATORS] = False
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

#: Values of bytes, and factors of the words of a shingle, from the mix of their numbers.
BYTE_VALUES = unsigned_mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@functools.lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    up, down = np.full(n, BASE), np.full(n, INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every lower-cased word of all texts, and how many words each text has."""
    if not len(body):
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    up, down = powers(1 << int(len(body) - 1).bit_length() if len(body) > 1 else 1)
    letters = IS_WORD[body]
    before = np.empty_like(letters)
    before[0], before[1:] = False, letters[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(body))]
    before[inner] = False
    starts = np.flatnonzero(letters & ~before)
    after = np.empty_like(letters)
    after[-1], after[:-1] = False, letters[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(letters & ~after) + 1
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[LOWERED[body]] * up[: len(body)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * BASE
    return unsigned_mix(hashes), np.diff(np.searchsorted(starts, bounds))


def shingle_sets(body: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, ascending by text and value, and the bounds of the texts.

    A text with fewer than ``n`` words has its whole sequence as one, one without words none.
    """
    words, counts = word_hashes(body, bounds)
    first = np.concatenate([[0], np.cumsum(counts)])
    factors = unsigned_mix(np.arange(1000, 1000 + n, dtype=np.uint64)) | np.uint64(1)
    padded = np.concatenate([words, np.zeros(n - 1, np.uint64)])
    mixed = np.zeros(len(words), np.uint64)
    for k in range(n):
        mixed += padded[k : k + len(words)] * factors[k]
    mixed = unsigned_mix(mixed)
    number = np.where(counts >= n, counts - (n - 1), (counts > 0).astype(np.int64))
    upto = np.concatenate([[0], np.cumsum(number)])
    source = np.repeat(first[:-1] - upto[:-1], number) + np.arange(upto[-1])
    hashes = mixed[source]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        own = words[first[i] : first[i + 1]]
        total = np.uint64((sum(int(w) * int(f) for w, f in zip(own, factors, strict=False)) + int(counts[i])) % (1 << 64))
        hashes[upto[i]] = unsigned_mix(np.array([total]))[0]
    for a, b in zip(upto[:-1], upto[1:], strict=True):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[upto[:-1][number > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return hashes[fresh], kept[upto]
