"""64-bit hashes of words, shingles and sets, computed with numpy over whole blocks of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_seeded = np.random.Generator(np.random.PCG64(977))
_BYTE = _seeded.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _seeded.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_SPAN = 1 << 16
_POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(_SPAN - 1, _PLACE[63], np.uint64)]))

BLOCK = 400_000  # bytes hashed together; a longer text is a block of its own


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word in data, its hash); words are maximal runs without ASCII white space."""
    b = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    inner = b[~_SPACE[b]]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(inner)) - np.repeat(first, lengths)
    factor = _POWERS[place & (_SPAN - 1)]
    if lengths.max() > _SPAN:
        factor = factor * _POWERS[(place >> 16) & (_SPAN - 1)] + (place >> 16).astype(np.uint64)
    return starts, mix(np.add.reduceat(_BYTE[inner] * factor, first) + lengths.astype(np.uint64))


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """For each text (already lower-cased where wanted) the sorted hashes of its distinct shingles of `width` words; of a shorter text the whole as one; of none nothing."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= BLOCK):
            size += len(texts[upto]) + 1
            upto += 1
        block = texts[at:upto]
        starts, hashes = words(b"\n".join(block))
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in block])])
        bounds = np.searchsorted(starts, offsets)
        n = len(hashes) - width + 1
        joined = np.zeros(max(n, 0), np.uint64)
        for i in range(width if n > 0 else 0):
            joined += hashes[i : i + n] * _PLACE[i]
        joined = mix(joined)
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if z - a >= width:
                yield np.unique(joined[a : z - width + 1])
            elif z > a:
                whole = (hashes[a:z] * _PLACE[: z - a]).sum(dtype=np.uint64, keepdims=True)
                yield mix(whole + _PLACE[width : width + 1] * np.array([z - a], np.uint64))
            else:
                yield np.empty(0, np.uint64)
        at = upto
