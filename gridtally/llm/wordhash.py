"""Hashes of words and of word windows, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes of text worked on at a time.
BATCH_BYTES = 1 << 22
_U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers that depend on the seed only."""
    return mix((np.arange(n, dtype=_U64) + _U64(1)) * _U64(0x9E3779B97F4A7C15) + _U64(seed)) | _U64(1)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = numbers(256, 11)
_PLACES = numbers(1 << 12, 13)


class Words:
    """Words of a batch of UTF-8 texts: ``hashes`` of all, ``first[d]`` the number of the first word of text d."""

    def __init__(self, texts: Sequence[bytes]):
        global _PLACES
        joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        word = ~_SPACE[joined]
        edge = np.diff(word.view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lengths = ends - starts
        begins = np.cumsum([len(t) + 1 for t in texts]) if len(texts) else np.zeros(0, dtype=np.int64)
        self.first = np.concatenate([[0], np.searchsorted(starts, begins)])
        if len(starts):
            if lengths.max() > len(_PLACES):
                _PLACES = numbers(int(lengths.max()), 13)
            before = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
            self.hashes = mix(np.add.reduceat(_BYTES[joined[word]] * _PLACES[place], before))
        else:
            self.hashes = np.zeros(0, dtype=_U64)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hash of ``length`` words from each place on."""
        total = np.zeros(len(at), dtype=_U64)
        for k, c in enumerate(numbers(length, 17)):
            total += self.hashes[at + k] * c
        return mix(total)


def batches(sizes: Sequence[int], limit: int = BATCH_BYTES) -> Iterator[slice]:
    """Slices of consecutive items with about ``limit`` in sum; a larger item stands alone."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def planes(values: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes before all second ones, which block compression does better with."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(dtype).ravel()


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, length) of the runs of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return first, np.diff(np.append(first, len(sorted_keys)))
