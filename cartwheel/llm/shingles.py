"""Word shingles of texts as arrays of 64-bit fingerprints, and their min-max signatures."""

from __future__ import annotations

import numpy as np
import xxhash

from cartwheel.llm.batches import mix

WORDS = 4
#: Bytes of text hashed at once, so that a very long text needs little more than itself.
SEGMENT = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _letters() -> np.ndarray:
    """A random number per byte, A-Z as a-z, and 0 for the white space between words."""
    table = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64)
    table[65:91] = table[97:123]
    table[[9, 10, 11, 12, 13, 32]] = 0
    return table


_LETTERS = _letters()
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int, way: str) -> np.ndarray:
    """The first n powers of the base (``up``) or of its inverse (``down``), modulo 2^64."""
    if len(_powers[way]) < n:
        base = _BASE if way == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(n, base & _MASK, dtype=np.uint64)
        steps[0] = 1
        _powers[way] = np.cumprod(steps, dtype=np.uint64)
    return _powers[way][:n]


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and starts of the words of bytes that begin and end with a separator."""
    letters = _LETTERS[data]
    word = letters != 0
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    sums = np.cumsum(letters * _power(len(data), "up"), dtype=np.uint64)
    found = (sums[ends - 1] - sums[starts - 1]) * _power(len(data), "down")[starts]
    return mix(found ^ ((ends - starts).astype(np.uint64) * _STEP)), starts


def word_fingerprints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of each word of all texts in order, and which text it is in."""
    data = np.frombuffer(b"\n" + b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(data) - 1:
        end = min(at + SEGMENT, len(data) - 1)
        while _LETTERS[data[end]] != 0:  # go on to the end of the word
            end += 1
        found, first = _segment_words(data[at:end + 1])
        hashes.append(found)
        starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    owner = np.searchsorted(np.cumsum(sizes) - sizes + 1, np.concatenate(starts), "right") - 1
    return np.concatenate(hashes), owner


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted different shingles of each text; a shorter text is one shingle of all it has."""
    hashes, owner = word_fingerprints(texts)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    n = len(hashes) - words + 1
    windows, held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        whole = owner[:n] == owner[words - 1:]
        windows = mix(hashes[:n])
        for k in range(1, words):
            windows = mix(windows * _STEP ^ hashes[k:n + k])
        windows, held = windows[whole], owner[:n][whole]
    cuts = np.searchsorted(held, np.arange(len(texts) + 1))
    sets = []
    for i, count in enumerate(counts):
        if 0 < count < words:
            value = hashes[ends[i] - count:ends[i] - count + 1]
            value = mix(value)
            for k in range(1, count):
                value = mix(value * _STEP ^ hashes[ends[i] - count + k:ends[i] - count + k + 1])
            sets.append(value)
        else:
            sets.append(np.unique(windows[cuts[i]:cuts[i + 1]]))
    return sets


def set_key(values: np.ndarray) -> bytes:
    """A 128-bit name of a sorted set."""
    return xxhash.xxh3_128_digest(values.tobytes())


class MinMax:
    """Min-max signatures: each permutation gives its minimum and its maximum.

    A band is two permutations, four values. Two sets agree in the minimum of a
    permutation, and in its maximum, with the probability of their similarity.
    """

    def __init__(self, bands: int, seed: int = 11):
        random = np.random.default_rng(seed)
        self.bands = bands
        self.shift = random.integers(0, 1 << 63, 2 * bands, dtype=np.uint64)
        self.factor = random.integers(0, 1 << 63, 2 * bands, dtype=np.uint64) | np.uint64(1)

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of band keys per non-empty set."""
        starts = np.cumsum([0, *map(len, sets[:-1])])
        values = np.concatenate(sets)
        ends = []
        for shift, factor in zip(self.shift, self.factor):
            order = (values ^ shift) * factor
            order >>= np.uint64(32)
            low = np.minimum.reduceat(order, starts)
            high = np.maximum.reduceat(order, starts)
            ends.append((low << np.uint64(32)) | high)
        keys = [mix(mix(ends[2 * b] + np.uint64(b)) * _STEP ^ ends[2 * b + 1])
                for b in range(self.bands)]
        return np.stack(keys, axis=1).view(np.int64)
