"""What a worker remembers of the pre-tokens it has met: their ids, found by hash."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from stayscope.llm.pretokens import cut

#: Pre-tokens that a worker keeps; beyond it starts anew.
KEPT_PIECES = 500_000

Encoder = Callable[[list[bytes]], list[np.ndarray]]


class KnownPieces:
    """A hash table with open addressing from a pre-token's hash to its ids."""

    def __init__(self, kept: int = 0):
        self.kept = kept or KEPT_PIECES
        self.clear()

    def clear(self) -> None:
        size = 1 << max(10, (self.kept * 2 - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, dtype=np.uint64)
        self.places = np.full(size, -1, dtype=np.int32)
        self.begin = np.zeros(1 << 16, dtype=np.int64)
        self.ids = np.empty(1 << 17, dtype=np.int32)
        self.count = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        slot = hashes & self.mask
        out = self.places[slot]
        other = np.flatnonzero((self.keys[slot] != hashes) & (out >= 0))
        slot = slot[other]
        while len(other):
            slot = (slot + np.uint64(1)) & self.mask
            place = self.places[slot]
            out[other] = place
            again = (self.keys[slot] != hashes[other]) & (place >= 0)
            other, slot = other[again], slot[again]
        return out

    def add(self, hashes: np.ndarray, ids: list[np.ndarray]) -> None:
        """Take in distinct hashes that are not held yet."""
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        first = self.count
        self.begin = _room(self.begin, first + len(ids) + 1)
        held = int(self.begin[first])
        self.begin[first + 1:first + len(ids) + 1] = held + np.cumsum(sizes)
        self.ids = _room(self.ids, held + len(flat))
        self.ids[held:held + len(flat)] = flat
        self.count += len(ids)
        slot = hashes & self.mask
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.places[slot[left]] < 0]
            _, winner = np.unique(slot[free], return_index=True)
            won = free[winner]
            self.keys[slot[won]] = hashes[won]
            self.places[slot[won]] = first + won
            left = left[self.places[slot[left]] != first + left]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask

    def places_of(self, hashes: np.ndarray, encode: Callable[[np.ndarray], list[np.ndarray]]) -> np.ndarray:
        """The place of each piece; those not met before are encoded first (given by position)."""
        at = self.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            distinct, sample = np.unique(hashes[new], return_index=True)
            if self.count + len(distinct) > self.kept:
                self.kept = max(self.kept, len(hashes))
                self.clear()
                distinct, sample = np.unique(hashes, return_index=True)
                new = np.arange(len(hashes))
            self.add(distinct, encode(new[sample]))
            at[new] = self.find(hashes[new])
        return at

    def sizes(self, at: np.ndarray) -> np.ndarray:
        return self.begin[at + 1] - self.begin[at]

    def gather(self, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of many pieces one after another."""
        total = int(sizes.sum())
        shift = np.repeat(self.begin[at] - (np.cumsum(sizes) - sizes), sizes)
        shift += np.arange(total)
        return self.ids[shift]

    def encode_column(
        self, column: pa.Array, encoder: Encoder, special: tuple[bytes, ...] = ()
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and where those of each text begin (with the end)."""
        pieces = cut(column, special)
        at = self.places_of(pieces.hashes, lambda which: encoder(pieces.bytes_of(which)))
        sizes = self.sizes(at)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return self.gather(at, sizes), ends[pieces.first]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    out[:len(array)] = array
    return out
