"""Mix sources to target weights: Pfair windows, earliest deadline first.

The rows of a source, in seeded hash order, are cut into blocks of
``block_bytes`` (a document belongs to the block in which it starts). A source
of weight w gets its k-th block within the window [floor(k/w), ceil((k+1)/w)) of
slots; of the blocks that are released, the one with the earliest deadline takes
the slot. Weights are taken as they are given (whole numbers with the same ratios,
nothing is rounded), so in every prefix of the stream, however long, each source is
less than one block from its share. The state before a slot (blocks served, for each
source) follows from arithmetic: every task finds the state at the start of its frames
of ``period`` slots by itself (``served_before``) and fills in their slots, so nothing
steps through the whole stream; documents meet their block's slots in a join.

``cover`` (the default) runs until the source that is largest for its weight has
been used up once; a source that ends earlier starts again (``epoch`` 1, 2 ...),
so no document is lost. ``supply`` stops where a source would start again.

Rows with the same source and doc_id move as one unit. Defined results: null or
empty text counts one byte; null sources are a source; an empty table gives an
empty result; a source without a given weight, or with one that is not a positive
number, is an error, a given weight whose source has no rows is ignored; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from .running import running_sum

BLOCK_BYTES = 1 << 16
PERIOD = 1 << 12
FRAME_CACHE = 1 << 25
NO_SLACK = 1 << 62


def exact_parts(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the ratios of the weights."""
    exact = [Fraction(w) for w in weights]
    whole = math.lcm(*(x.denominator for x in exact))
    parts = [int(x * whole) for x in exact]
    common = math.gcd(*parts) or 1
    return [q // common for q in parts]


def pfair(parts: list[int], slot: int, served: list[int]) -> Iterator[int]:
    """The source of ``slot`` and all later ones, by earliest deadline among released blocks.

    ``served`` holds every source's blocks before ``slot``; it is kept up to date.
    """
    period = sum(parts)

    def window(source: int) -> tuple[int, int, int]:
        k, q = served[source], parts[source]
        return k * period // q, -(-(k + 1) * period // q), source

    later = [window(i) for i in range(len(parts))]         # each source's next block
    heapq.heapify(later)
    ready: list[tuple[int, int]] = []
    while True:
        while later and later[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(later)[1:])
        deadline, source = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a block missed its window")
        served[source] += 1
        heapq.heappush(later, window(source))
        slot += 1
        yield source


def slack(parts: list[int], low: int, high: int) -> np.ndarray:
    """For u = low + 1 .. high: the blocks released before slot u, less u. Never negative."""
    whole, before, at = sum(parts), 0, []
    for q in parts:
        first, end = -(-q * low // whole), -(-q * high // whole)
        before += first
        at.extend(k * whole // q - low for k in range(first, end))
    released = np.bincount(np.array(at, dtype=np.int64), minlength=high - low)
    return before - low + np.cumsum(released) - np.arange(1, high - low + 1)


class LeastSlack:
    """The least slack over any range of slots, from the least one of every whole frame.

    Slack inside the frames at a range's two ends is computed again; the last ones are kept.
    """

    GROUP = 512                                            # frames with a common minimum

    def __init__(self, parts: list[int], period: int, least: np.ndarray):
        self.period, self.least = period, least
        self.groups = np.minimum.reduceat(least, range(0, len(least), self.GROUP)) if len(least) else least
        self.frame = lru_cache(max(4, FRAME_CACHE // (8 * period)))(
            lambda m: slack(parts, m * period, (m + 1) * period))

    def frames(self, first: int, end: int) -> int:
        """The least slack of the whole frames first .. end - 1."""
        inner, outer = -(-first // self.GROUP), end // self.GROUP
        if inner >= outer:
            return int(self.least[first:end].min())
        return int(min(self.least[first:inner * self.GROUP].min(initial=NO_SLACK), self.groups[inner:outer].min(),
                       self.least[outer * self.GROUP:end].min(initial=NO_SLACK)))

    def over(self, low: int, high: int) -> int:
        """The least slack of low < u <= high."""
        if low >= high:
            return NO_SLACK
        first, last = low // self.period, (high - 1) // self.period
        start, stop = low - first * self.period, high - last * self.period
        if first == last:
            return int(self.frame(first)[start:stop].min())
        ends = min(int(self.frame(first)[start:].min()), int(self.frame(last)[:stop].min()))
        return min(ends, self.frames(first + 1, last)) if first + 1 < last else ends


def served_before(parts: list[int], slot: int, least: LeastSlack) -> list[int]:
    """Every source's blocks before ``slot``, without stepping through the slots before it.

    Source i has had floor(w_i * slot) blocks, and perhaps the one whose window holds the
    border. The work that earliest-deadline-first does before ``slot`` on the blocks down to
    a priority p depends on those blocks alone: slot + min over u <= slot of (slack at u,
    less the open blocks beyond p that are released before u). An open block has had its
    slot if that work grows by one when p reaches it.
    """
    whole = sum(parts)
    served = [q * slot // whole for q in parts]
    opened = sorted((k * whole // q, -(-(k + 1) * whole // q), i)          # (release, deadline, source)
                    for i, (q, k) in enumerate(zip(parts, served)) if q * slot % whole)
    if not opened:
        return served
    releases = [release for release, _, _ in opened] + [slot]
    room = np.array([least.over(a, b) for a, b in zip(releases, releases[1:])]) - np.arange(1, len(opened) + 1)
    work = min(0, int(room.min()))
    for _, source, place in sorted((deadline, i, place) for place, (_, deadline, i) in enumerate(opened)):
        room[place:] += 1
        more = min(0, int(room.min()))
        served[source] += more - work
        work = more
    return served


def stream_slots(parts: list[int], blocks: list[int], mode: str) -> int:
    """A number of slots within which the stream ends: a deadline of the block that ends it."""
    whole = sum(parts)
    if mode == "cover":
        return max((-(-b * whole // q) for b, q in zip(blocks, parts)), default=0)
    return min((-(-(b + 1) * whole // q) for b, q in zip(blocks, parts)), default=0)


def _least(parts: list[int], period: int):
    """For mapInArrow over frame numbers: (frame, its least slack)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frames = batch.column(0).to_pylist()
            lows = [int(slack(parts, m * period, (m + 1) * period).min()) for m in frames]
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.int64()), pa.array(lows, pa.int64())],
                                             names=["frame", "least"])
    return run


def _slots(parts: list[int], blocks: list[int], period: int, slots: int, lows: np.ndarray, mode: str):
    """For mapInArrow over frame numbers: (number of the source, block, epoch, slot, edge) of every slot.

    ``edge`` marks a source's last new block (cover) or its first repeated one (supply).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = LeastSlack(parts, period, lows)
        edges = blocks if mode == "cover" else [b + 1 for b in blocks]
        for batch in batches:
            for frame in batch.column(0).to_pylist():
                start, end = frame * period, min((frame + 1) * period, slots)
                served = served_before(parts, start, least)
                stream = pfair(parts, start, served)
                source, block, epoch, edge = [], [], [], []
                for _ in range(start, end):
                    i = next(stream)
                    source.append(i)
                    block.append((served[i] - 1) % blocks[i])
                    epoch.append((served[i] - 1) // blocks[i])
                    edge.append(served[i] == edges[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(source, pa.int32()), pa.array(block, pa.int64()), pa.array(epoch, pa.int32()),
                     pa.array(range(start, end), pa.int64()), pa.array(edge, pa.bool_())],
                    names=["_number", "_block", "epoch", "slot", "_edge"])
    return run


def schedule(spark: SparkSession, parts: list[int], blocks: list[int], period: int, mode: str,
             scratch: Scratch) -> DataFrame:
    """(_number, _block, epoch, slot) of the whole stream: frames of ``period`` slots, each on its own.

    One number of 8 bytes for each frame passes the driver (3 MB for 100 TB in blocks of 64 KB).
    """
    slots = stream_slots(parts, blocks, mode)
    frames = spark.range(-(-slots // period))
    lows = sorted(tuple(r) for r in frames.mapInArrow(_least(parts, period), "frame long, least long").collect())
    least = np.array([low for _, low in lows], dtype=np.int64)
    plan = scratch.store(frames.mapInArrow(_slots(parts, blocks, period, slots, least, mode),
                                           "_number int, _block long, epoch int, slot long, _edge boolean"), "plan")
    edges = plan.where("_edge").agg(F.max("slot").alias("last"), F.min("slot").alias("first")).first()
    if edges.last is not None:
        plan = plan.where(F.col("slot") <= edges.last if mode == "cover" else F.col("slot") < edges.first)
    return plan.drop("_edge")


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, exponent: float = 0.9,
                mode: str = "cover", block_bytes: int = BLOCK_BYTES, period: int = PERIOD, seed: int = 7,
                id_col: str = "doc_id", source_col: str = "source", text: str = "text",
                scratch: Scratch | None = None) -> DataFrame:
    """One row per scheduled unit and epoch: id_col, source_col, bytes, epoch, block, slot, offset.

    The stream's order is (slot, offset, id). Without ``weights``, a source's
    weight is its bytes, one block at least, to the power ``exponent``: a source
    of a few bytes takes a whole slot and must not stretch the stream until a slot
    is due to so few. ``period`` is the number of
    slots that a task fills in at a time; it grows to four times the number of
    sources where that is more. No result depends on it.
    """
    if mode not in ("cover", "supply"):
        raise ValueError(f"mode must be cover or supply, not {mode!r}")
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "mix", until_exit=True)
    size = F.greatest(F.coalesce(F.octet_length(F.col(text)), F.lit(0)), F.lit(1)).cast("long")
    units = scratch.store(
        docs.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("id"), size.alias("bytes"))
        .groupBy("source", "id").agg(F.sum("bytes").alias("bytes"))
        .withColumn("h", F.xxhash64(F.lit(seed), "id", "source")), "units")
    totals = sorted(((r.source, r.bytes) for r in units.groupBy("source").agg(F.sum("bytes").alias("bytes")).collect()),
                    key=lambda t: (t[0] is not None, t[0] or ""))
    if weights is None:
        shares = [max(b, block_bytes) ** exponent for _, b in totals]
    else:
        missing = [s for s, _ in totals if s not in weights]
        if missing:
            raise ValueError(f"no target weight for sources {missing[:5]}")
        shares = [weights[s] for s, _ in totals]
    wrong = [s for (s, _), w in zip(totals, shares) if not (w > 0 and math.isfinite(w))]
    if wrong:
        raise ValueError(f"weights of sources {wrong[:5]} are not positive numbers")
    period = max(period, 4 * len(totals))
    parts = exact_parts(shares)
    blocks = [-(-b // block_bytes) for _, b in totals]
    plan = schedule(spark, parts, blocks, period, mode, scratch)
    numbers = spark.createDataFrame([(name, i) for i, (name, _) in enumerate(totals)], "_source string, number int")
    placed = running_sum(units, ["source"], "h", ["id"], F.col("bytes"), "at")
    numbered = (placed.join(F.broadcast(numbers), placed["source"].eqNullSafe(numbers["_source"]))   # a row for each source
                .withColumn("block", F.floor(F.col("at") / block_bytes).cast("long")))
    with_plan = numbered.join(plan, (F.col("number") == F.col("_number")) & (F.col("block") == F.col("_block")))
    return with_plan.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "bytes",
                            "epoch", "block", "slot", (F.col("at") % block_bytes).alias("offset"))


def mixed_documents(docs: DataFrame, scratch: Scratch | None = None, **how) -> DataFrame:
    """The documents of the mixed stream in its order, repeated as scheduled, with the columns of ``docs``.

    Partitions are ranges of (slot, offset, id) and sorted by it, so stored files follow the stream by their names.
    """
    key, source = how.get("id_col", "doc_id"), how.get("source_col", "source")
    plan = mix_sources(docs, scratch=scratch, **how).select(
        F.col(key).alias("_mix_id"), F.col(source).alias("_mix_source"), F.col("slot").alias("_mix_slot"),
        F.col("offset").alias("_mix_offset"))
    joined = docs.join(plan, docs[key].eqNullSafe(plan["_mix_id"])
                       & docs[source].cast("string").eqNullSafe(plan["_mix_source"]))
    place = ["_mix_slot", "_mix_offset", "_mix_id"]
    ordered = joined.select(*[docs[c] for c in docs.columns], *place).repartitionByRange(*place).sortWithinPartitions(*place)
    return ordered.drop(*place)
