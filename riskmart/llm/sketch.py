"""Counts of 64-bit hashes in a fixed number of cells, over a whole table.

The array has 2**bits cells whatever the input, so it may be broadcast. Tasks
emit it in slices, which are summed in two steps, so no task sees more than a few
hundred copies of a slice. A cell's count is never below the count of a hash in it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SLICES = 1 << 9
SUMMED = 256                             # copies of a slice per task of the first step


def cell(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _emit(hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.uint32)
        held, size = [], 0

        def count() -> None:
            nonlocal size
            if held:
                total[:] += np.bincount(np.concatenate(held), minlength=1 << bits).astype(np.uint32)
            held.clear()
            size = 0

        for batch in batches:
            for hashes in hashes_of(batch):
                held.append(cell(hashes, bits))
                size += len(hashes)
                if size >= 1 << 21:
                    count()
        count()
        slices = total.reshape(min(SLICES, 1 << bits), -1)
        used = np.flatnonzero(slices.any(axis=1))
        part = TaskContext.get().partitionId() // SUMMED
        for some in np.array_split(used, 1 + len(used) * slices.shape[1] // (1 << 19)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(np.full(len(some), part), pa.int32()),
                 pa.array([slices[i].tobytes() for i in some], pa.binary())], names=["slice", "part", "counts"])
    return run


def _sum(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    total = None
    for counts in table["counts"].to_pylist():
        values = np.frombuffer(counts, dtype=np.uint32).astype(np.uint64)
        total = values if total is None else total + values
    total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
    return pa.table({"slice": [key[0].as_py()], "counts": [total.tobytes()]},
                    schema=pa.schema([("slice", pa.int32()), ("counts", pa.binary())]))


def _emit_flags(hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            for hashes in hashes_of(batch):
                seen[cell(hashes, bits)] = True
        slices = seen.reshape(min(SLICES, 1 << bits), -1)
        used = np.flatnonzero(slices.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([slices[i].tobytes() for i in used], pa.binary())],
            names=["slice", "flags"])
    return run


def _either(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    total = None
    for flags in table["flags"].to_pylist():
        values = np.frombuffer(flags, dtype=bool)
        total = values if total is None else total | values
    return pa.table({"slice": [key[0].as_py()], "flags": [np.packbits(total).tobytes()]},
                    schema=pa.schema([("slice", pa.int32()), ("flags", pa.binary())]))


def hash_flags(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """2**bits flags: whether any hash falls in the cell. The driver sees one bit per cell."""
    found = (df.mapInArrow(_emit_flags(hashes_of, bits), "slice int, flags binary")
             .groupBy("slice").applyInArrow(_either, "slice int, flags binary"))
    out = np.zeros((min(SLICES, 1 << bits), (1 << bits) // min(SLICES, 1 << bits)), dtype=bool)
    for row in found.toArrow().to_pylist():
        out[row["slice"]] = np.unpackbits(np.frombuffer(row["flags"], dtype=np.uint8), count=out.shape[1])
    return out.ravel()


def hash_counts(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """The 2**bits counts of the hashes that ``hashes_of`` yields for the batches of ``df``."""
    schema = "slice int, counts binary"
    parts = df.mapInArrow(_emit(hashes_of, bits), "slice int, part int, counts binary")
    sums = (parts.groupBy("slice", "part").applyInArrow(_sum, schema)
            .groupBy("slice").applyInArrow(_sum, schema))
    total = np.zeros((min(SLICES, 1 << bits), (1 << bits) // min(SLICES, 1 << bits)), dtype=np.uint32)
    for row in sums.toArrow().to_pylist():
        total[row["slice"]] = np.frombuffer(row["counts"], dtype=np.uint32)
    return total.ravel()
