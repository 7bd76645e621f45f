"""Words of a batch as arrays: hashes of byte runs, numbers by hash, and gathering what belongs to them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Random odd multipliers for bytes and for places in a word, two tables of each. Every process draws its own: they never leave it, and no
#: input can be made to collide.
_BYTES, _PLACES, _BYTES_2, _PLACES_2 = (np.random.default_rng().integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (256, 4096, 256, 4096))


def hashed(body: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of 64 bits of each word; body: the words' bytes one after another."""
    if not len(lengths):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(body)) - np.repeat(first, lengths)
    far = (place >> 12).astype(np.uint64) if lengths.max() > 4096 else np.uint64(0)
    place &= 4095
    one = _BYTES[body] * (_PLACES[place] + far)
    return np.add.reduceat(one, first), np.add.reduceat(_BYTES_2[body] * (_PLACES_2[place] + far), first)


class Numbers:
    """Open addressing from a word's two hashes to its number, in the order of arrival; -1 for those not there."""

    def __init__(self, bits: int = 21):
        self.count = 0
        self.clear(bits)

    def clear(self, bits: int) -> None:
        self.bits, self.last = bits, (1 << bits) - 1
        self.one, self.two = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.number = np.full(1 << bits, -1, np.int32)

    def slot(self, one: np.ndarray) -> np.ndarray:
        return ((one * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        slot = self.slot(one)
        out = self.number[slot]
        rest = np.nonzero((out >= 0) & ((self.one[slot] != one) | (self.two[slot] != two)))[0]
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.last
            at = slot[rest]
            out[rest] = self.number[at]
            rest = rest[(out[rest] >= 0) & ((self.one[at] != one[rest]) | (self.two[at] != two[rest]))]
        return out

    def add(self, one: np.ndarray, two: np.ndarray) -> None:
        number = np.arange(self.count, self.count + len(one), dtype=np.int32)
        self.count += len(one)
        if 2 * self.count > self.last:
            there = np.nonzero(self.number >= 0)[0]
            one, two, number = (np.concatenate(x) for x in ((self.one[there], one), (self.two[there], two), (self.number[there], number)))
            self.clear((4 * self.count).bit_length())
        slot = self.slot(one)
        while len(one):
            free = np.zeros(len(one), bool)
            free[np.unique(slot, return_index=True)[1]] = True
            free &= self.number[slot] < 0
            at = slot[free]
            self.one[at], self.two[at], self.number[at] = one[free], two[free], number[free]
            one, two, number, slot = one[~free], two[~free], number[~free], (slot[~free] + 1) & self.last


def gathered(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of flat that `at` names, one after another, and their lengths."""
    n = lengths[at]
    place = np.repeat(offsets[at] - (np.cumsum(n) - n), n)
    place += np.arange(len(place))
    return flat[place], n


def runs(texts: pa.Array, most: int = 4 << 20) -> Iterator[pa.Array]:
    """The texts in runs of some bytes."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    k = 0
    while k < len(texts):
        e = max(k + 1, int(np.searchsorted(sizes, (sizes[k - 1] if k else 0) + most, "right")))
        yield texts.slice(k, e - k)
        k = e


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
