"""Vectorised word hashing over Arrow string buffers (used inside Arrow tasks).

A word is a maximal run of bytes other than space and TAB..CR, with A-Z
lower-cased; all other bytes stay as they are. Words become 64-bit hashes, so a
batch of whole texts is tokenised by a few numpy passes over its byte buffer,
without a Python object per word. Two different words share a hash with a
probability of about 2**-58 or less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_P = 0x9E3779B97F4A7C1B | 3              # odd multiplier, 3 modulo 8
_CHUNK = 1 << 16                         # bytes hashed at a time: their 8-byte work arrays stay in the cache


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a bijection on 64-bit integers)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    lower = np.arange(256, dtype=np.int64)
    lower[0x41:0x5B] += 0x20
    exact = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15))
    exact[space] = 0
    return space, exact[lower], exact


_SPACE, _FOLDED, _EXACT = _byte_tables()
_MARK = np.zeros(256, dtype=bool)        # every ASCII byte but letters and digits
_MARK[:128] = [not chr(i).isalnum() for i in range(128)]
_BARE = np.where(_MARK, np.uint64(0), _FOLDED)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least n of each."""
    if len(_POW.get("up", ())) < n:
        size = max(n, _CHUNK + 1)
        inverse = pow(_P, -1, 1 << 64)
        for name, base in (("up", _P), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POW[name] = np.cumprod(steps, dtype=np.uint64)
    return _POW["up"], _POW["down"]


def buffers(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) over slices of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words(raw: np.ndarray, offsets: np.ndarray,
          fold: bool = True, bare: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word of the slice: start byte, end byte, 64-bit hash. Texts never share a word.

    With ``fold`` (the default) A-Z hash like a-z; with ``bare`` words are also cut at ASCII marks.
    """
    value, cut = (_BARE, _MARK) if bare else (_FOLDED if fold else _EXACT, _SPACE)
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = ~cut[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    first[cuts] |= inside[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, starts.copy(), np.zeros(0, np.uint64)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):               # sub-slices keep the 8-byte-per-byte work arrays small
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _powers(b - a)
        local = starts[i:j] - a
        summed = np.add.reduceat(value[raw[a:b]] * up[:b - a], local)
        hashes[i:j] = summed * down[local]
        i = j
    return starts, ends, mix(hashes ^ (ends - starts).astype(np.uint64))


def word_counts(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words per text."""
    return np.diff(np.searchsorted(starts, offsets, side="left"))


def lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line of the slice: first byte, text, number within the text; a text has one line more than line ends."""
    ends = np.flatnonzero(raw == 0x0A) + 1
    # at equal places a text's last (empty) line comes before the next text's first
    order = np.argsort(np.concatenate([ends, offsets[:-1]]), kind="stable")
    starts = np.concatenate([ends, offsets[:-1]])[order]
    head = order >= len(ends)
    text = np.cumsum(head) - 1
    first = np.flatnonzero(head)
    return starts, text, np.arange(len(starts)) - first[text]


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every k-word shingle; a shorter text is one shingle, an empty one has none."""
    row = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes)
    if n >= k:
        acc = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            acc = mix(acc + hashes[i:n - k + 1 + i] + _U(i + 1))
        whole = row[:n - k + 1] == row[k - 1:]
        rows, values = row[:n - k + 1][whole], acc[whole]
    else:
        rows, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        acc = np.zeros(len(short), dtype=np.uint64)
        for i in range(k - 1):
            have = counts[short] > i
            at = np.minimum(begin[short] + i, n - 1)
            acc = np.where(have, mix(acc + hashes[at] + _U(i + 1)), acc)
        rows = np.concatenate([rows, short])
        values = np.concatenate([values, mix(acc ^ counts[short].astype(np.uint64) * _U(0xD6E8FEB86659FD93))])
    return rows, values


def by_row(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Indices that sort by row, then key; rows are counted from 0."""
    order = np.argsort(keys)
    if len(rows) and rows.max() < 1 << 16:        # 16-bit rows sort in linear time
        return order[np.argsort(rows[order].astype(np.uint16), kind="stable")]
    return order[np.argsort(rows[order], kind="stable")]


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, sorted by row, then value."""
    order = by_row(rows, values)
    rows, values = rows[order], values[order]
    if len(rows):
        keep = np.ones(len(rows), dtype=bool)
        keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
        rows, values = rows[keep], values[keep]
    return rows, values
