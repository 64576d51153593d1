"""Words of a slice of texts as packed binary values: exact, without a Python object per word.

``spaced`` writes the words of a slice one after the other with a blank behind each;
``numbered`` gives equal words equal numbers by Arrow's own dictionary, so words are
compared as bytes, never by hash. ``pack`` compresses an array for a shuffle or a stored
table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textvec

_RAW = 64                                # shorter arrays are not compressed


def byte_class(*parts: int | range) -> np.ndarray:
    """256 flags: the bytes given."""
    out = np.zeros(256, dtype=bool)
    for part in parts:
        out[list(part) if isinstance(part, range) else part] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)   # only A-Z change
LOWER[0x41:0x5B] += 0x20


def runs(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the maximal runs of bytes of the class ``inside``; texts never share one."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    within = inside[raw]
    first = within.copy()
    first[1:] &= ~within[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    first[cuts] |= within[cuts]
    last = within.copy()
    last[:-1] &= ~within[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def spaced(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, a blank behind each, and the words' offsets (one more than words)."""
    stop = np.cumsum(ends - starts + 1)
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, dtype=np.uint8)
    word = np.ones(len(out), dtype=bool)
    word[stop - 1] = False
    out[word] = raw[inside[raw]]
    return out, np.append(0, stop)


def binary(data: np.ndarray | bytes, offsets: np.ndarray) -> pa.Array:
    """An Arrow array of the byte strings between the offsets."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(data)])


def parts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of an Arrow array of byte strings."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each value's group of equal values, and the distinct values in that order."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def firsts(number: np.ndarray) -> np.ndarray:
    """The first place of each number, for numbers 0, 1, ... that all occur."""
    out = np.zeros(int(number.max()) + 1 if len(number) else 0, dtype=np.int64)
    out[number[::-1]] = np.arange(len(number))[::-1]
    return out


def numbered_pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal pairs of numbers (below 2**32 each) get equal numbers."""
    return numbered(pa.array((x.astype(np.uint64) << np.uint64(32)) | y.astype(np.uint64)))[0]


def hashes_of(values: pa.Array) -> np.ndarray:
    """64-bit hashes of byte strings that end in a blank and hold no other white space."""
    raw, offsets = parts(values)
    return textvec.words(raw, offsets, fold=False)[2]


def pack(array: np.ndarray) -> bytes:
    data = np.ascontiguousarray(array).tobytes()
    if len(data) < _RAW:
        return b"\x00" * 8 + data
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    body = pa.Codec("zstd").decompress(data[8:], size, asbytes=True) if size else data[8:]
    return np.frombuffer(body, dtype=dtype)
