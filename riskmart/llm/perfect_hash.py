"""A minimal perfect hash over a shard of byte strings, with the strings stored by slot.

Built level by level: every key still without a place takes a bit of the level's array;
bits that exactly one key takes are kept, the other keys go on to the next level. A key's
slot is the number of kept bits before its own, so n keys have the slots 0 to n-1. A
string that is no key may reach a slot too, so a lookup compares it with the string that
is stored there. Keys whose 64-bit hashes are equal cannot be told apart by levels; they
are listed with their slots.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import textvec
from .packing import binary, parts

GAMMA = 2                                # bits of a level for each key that is left
_U = np.uint64


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (textvec.mix(hashes + _U((level + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)) % _U(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """``size`` keys; ``levels`` are (array size, sorted kept bits, slot of the first one)."""

    size: int
    levels: list = field(default_factory=list)
    data: bytes = b""                    # the keys by slot,
    offsets: np.ndarray = None           # and where they begin
    listed: dict = field(default_factory=dict)

    @property
    def nbytes(self) -> int:
        return len(self.data) + self.offsets.nbytes + sum(kept.nbytes + before.nbytes for _, kept, before, _ in self.levels)

    def keys(self) -> pa.Array:
        return binary(self.data, self.offsets)

    def slots(self, values: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The slot of every value, -1 where it is no key."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for level, (size, kept, before, first) in enumerate(self.levels):
            if not len(left):
                break
            place = _places(hashes[left], level, size)
            word, bit = place >> 6, (place & 63).astype(_U)
            taken = (kept[word] >> bit) & _U(1) > 0
            below = np.bitwise_count(kept[word] & ((_U(1) << bit) - _U(1))).astype(np.int64)
            out[left[taken]] = (first + before[word] + below)[taken]
            left = left[~taken]
        found = np.flatnonzero(out >= 0)
        if len(found):
            stored = self.keys().take(pa.array(out[found]))
            same = pc.equal(stored, values.take(pa.array(found)).cast(pa.large_binary())).to_numpy(zero_copy_only=False)
            out[found[~same]] = -1
        if self.listed:
            for i in np.flatnonzero(np.isin(hashes, np.array(list({h for h, _ in self.listed.values()}), dtype=_U))).tolist():
                out[i] = self.listed.get(values[i].as_py(), (0, -1))[1]
        return out


def build(values: pa.Array, hashes: np.ndarray) -> PerfectHash:
    """The perfect hash of distinct ``values`` (byte strings)."""
    n = len(hashes)
    _, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
    alike = np.flatnonzero(count[inverse] > 1) if n else np.zeros(0, np.int64)
    left = np.setdiff1d(np.arange(n), alike)
    slot, levels, used = np.empty(n, dtype=np.int64), [], 0
    while len(left):
        size = max(64, GAMMA * len(left))
        place = _places(hashes[left], len(levels), size)
        alone = np.bincount(place, minlength=size) == 1
        kept = np.packbits(alone, bitorder="little")
        kept = np.append(kept, np.zeros(-len(kept) % 8, np.uint8)).view(_U)
        before = np.append(0, np.cumsum(np.bitwise_count(kept).astype(np.int64))[:-1])
        settled = alone[place]
        slot[left[settled]] = used + (np.cumsum(alone) - 1)[place[settled]]
        levels.append((size, kept, before, used))
        used += int(settled.sum())
        left = left[~settled]
    slot[alike] = used + np.arange(len(alike))
    order = np.empty(n, dtype=np.int64)
    order[slot] = np.arange(n)
    raw, offsets = parts(values.take(pa.array(order)))
    listed = {values[i].as_py(): (int(hashes[i]), int(slot[i])) for i in alike.tolist()}
    return PerfectHash(n, levels, raw.tobytes(), offsets.copy(), listed)
