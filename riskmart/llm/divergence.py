"""Source divergence audit: exact term counts per group by a minimal-perfect-hash recount.

1. Frequency filter: every slice of documents sends its distinct (language, term) pairs
   once, with the number of its documents that hold them, packed by shard (a hash of the
   term). A shard's task adds up, keeps the terms of at least ``least`` documents of
   their language, and builds for each language a minimal perfect hash that holds the
   kept strings by slot.
2. Recount: the shards are broadcast in waves of at most ``WAVE_BYTES``, and for each
   wave the texts are read again. A task looks up a slice's distinct terms, compares
   them with the stored strings, and increments the slots of each (language, source)
   group, dense over its language's slots; above ``HELD_BYTES`` they are sent off packed.
   A larger vocabulary is more waves, never a larger broadcast.
3. Blocks of slots add the counts up, and from the groups' and languages' totals give
   the smoothed shares p, the divergence of each pair of a language's sources summed
   over all its kept terms, and each group's terms above the language's share.

Group totals (one row for each group) are broadcast; the pairs of sources that the audit
returns are their square, so they are small against the result. All arithmetic is in
integers; shares are exact for groups of up to 9 * 10**15 counted terms.

Null text, language and source are empty strings; a group without terms has counts of 0
everywhere; a language without kept terms has divergences of 0 and no terms; equal rows
count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from . import perfect_hash, textvec
from .packing import LOWER, binary, byte_class, firsts, hashes_of, numbered, numbered_pairs, pack, parts, runs, spaced, unpack

LEAST = 10                               # documents of a language that hold a kept term
TOP = 10
SLICE_BYTES = 8 << 20                    # text of a slice
SHARD_BYTES = 4 << 20                    # text of the corpus for each shard
MOST_SHARDS = 1 << 18                    # a row of three numbers each reaches the driver
WAVE_BYTES = 64 << 20                    # perfect hashes broadcast together
HELD_BYTES = 64 << 20                    # dense slots that a task holds
BLOCK = 1 << 11                          # slots of a block, 2**16 at most
SCALE = 1_000_000_000
_TERM = byte_class(range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100))
_U = np.uint64
_COUNTS = ("lang string, block long, sources array<string>, n array<long>, sizes array<int>, slots binary, counts binary")


def _sliced(batch: pa.RecordBatch, text: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for lo, hi, raw, offsets in textvec.buffers(batch.column(text), SLICE_BYTES):
        yield batch.slice(lo, hi - lo), raw, offsets


def _terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and term number of every occurrence, and the distinct terms (a blank behind each)."""
    raw = LOWER[raw]
    starts, ends = runs(raw, offsets, _TERM)
    data, at = spaced(raw, starts, ends, _TERM)
    number, terms = numbered(binary(data, at))
    return np.searchsorted(offsets, starts, side="right") - 1, number, terms


def _document_counts(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in _sliced(batch, 1):
                text, number, terms = _terms(raw, offsets)
                if not len(terms):
                    continue
                once = np.sort((text.astype(_U) << _U(32)) | number.astype(_U))         # a document's term, once
                once = once[np.append(True, once[1:] != once[:-1])]
                lang_of, langs = numbered(rows.column(0))
                lang, number = lang_of[(once >> _U(32)).astype(np.int64)], (once & _U(0xFFFFFFFF)).astype(np.int64)
                pair = numbered_pairs(lang, number)
                first, count = firsts(pair), np.bincount(pair)
                lang, number = lang[first], number[first]
                shard = (hashes_of(terms) % _U(shards)).astype(np.int64)[number]
                order = np.lexsort((lang, shard))
                new = np.append(True, (np.diff(shard[order]) != 0) | (np.diff(lang[order]) != 0))
                begin = np.append(np.flatnonzero(new), len(order))
                pieces = [order[i:j] for i, j in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[p[0]]) for p in pieces], pa.int32()), langs.take(pa.array([lang[p[0]] for p in pieces])),
                     pa.array([pack(parts(terms.take(pa.array(number[p])))[0]) for p in pieces], pa.binary()),
                     pa.array([pack(count[p].astype(np.uint32)) for p in pieces], pa.binary())],
                    names=["shard", "lang", "terms", "counts"])
    return run


def _kept_terms(least: int):
    """For applyInArrow over a shard: each language's number of kept terms and their perfect hash."""
    def run(table: pa.Table) -> pa.Table:
        counts = [unpack(c, np.uint32) for c in table["counts"].to_pylist()]
        data = np.concatenate([unpack(t, np.uint8) for t in table["terms"].to_pylist()])
        terms = binary(data, np.append(0, np.flatnonzero(data == 0x20) + 1))
        lang, names = numbered(table["lang"].combine_chunks())
        lang = np.repeat(lang, [len(c) for c in counts])
        key = numbered_pairs(lang, numbered(terms)[0])
        total = np.bincount(key, weights=np.concatenate(counts)).astype(np.int64)
        kept = firsts(key)[total >= least]
        built = []
        for i, name in enumerate(names.to_pylist()):
            values = terms.take(pa.array(kept[lang[kept] == i]))
            if len(values):
                built.append((name, perfect_hash.build(values, hashes_of(values))))
        return pa.table({"shard": pa.array([table["shard"][0].as_py()] * len(built), pa.int32()),
                         "lang": pa.array([name for name, _ in built], pa.string()), "n": pa.array([h.size for _, h in built], pa.int64()),
                         "n_bytes": pa.array([h.nbytes for _, h in built], pa.int64()),
                         "hash": pa.array([pickle.dumps(h) for _, h in built], pa.binary())})
    return run


class _Wave:
    """Some shards' perfect hashes, as a task holds them: for each language its range of slots and its shards."""

    def __init__(self, shared: Broadcast):
        self.shards, hashes = shared.value
        self.langs: dict[str, list] = {}
        for lang, shard, first, n, data in hashes:               # in order of the slots
            span = self.langs.setdefault(lang, [first, first, {}])
            span[1] = first + n
            span[2][shard] = (first, pickle.loads(data))

    def slots(self, lang: str, terms: pa.Array) -> np.ndarray:
        """The slot of every term in its language's range, from 0; -1 for others."""
        hashes = hashes_of(terms)
        out = np.full(len(hashes), -1, dtype=np.int64)
        low, _, tables = self.langs[lang]
        shard = (hashes % _U(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)) if len(order) else order
        for some in np.split(order, begin[1:]):
            if len(some) and int(shard[some[0]]) in tables:
                first, table = tables[int(shard[some[0]])]
                slot = table.slots(terms.take(pa.array(some)), hashes[some])
                out[some] = np.where(slot >= 0, slot + first - low, -1)
        return out


def _recount(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = _Wave(shared)
        at: dict[tuple[str, str], int] = {}              # where a group's dense slots begin
        dense = np.zeros(0, dtype=np.int64)

        def emit() -> pa.RecordBatch:
            blocks: dict[tuple[str, int], list] = {}
            for (lang, source), first in at.items():
                low, high, _ = wave.langs[lang]
                slots = np.flatnonzero(dense[first:first + high - low])
                counts, slots = dense[first + slots], slots + low
                block = slots // BLOCK
                begin = np.flatnonzero(np.append(True, np.diff(block) != 0)) if len(slots) else slots
                for i, j in zip(begin, np.append(begin[1:], len(slots))):
                    blocks.setdefault((lang, int(block[i])), []).append((source, slots[i:j], counts[i:j]))
            rows = [(lang, block, [s for s, _, _ in found], [int(c.sum()) for _, _, c in found], [len(c) for _, _, c in found],
                     pack((np.concatenate([x for _, x, _ in found]) - block * BLOCK).astype(np.uint16)),
                     pack(np.concatenate([c for _, _, c in found]))) for (lang, block), found in blocks.items()]
            types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
            columns = list(zip(*rows)) or [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["lang", "block", "sources", "n", "sizes", "slots", "counts"])

        for batch in batches:
            for rows, raw, offsets in _sliced(batch, 2):
                text, number, terms = _terms(raw, offsets)
                lang_of, langs = numbered(rows.column(0))
                source_of, sources = numbered(rows.column(1))
                group_of = numbered_pairs(lang_of, source_of)
                pair = numbered_pairs(lang_of[text], number)               # distinct (language, term) pairs of the slice
                first = firsts(pair)
                pair_lang, slot_of = lang_of[text[first]], np.full(len(first), -1, dtype=np.int64)
                for i, lang in enumerate(langs.to_pylist()):
                    some = np.flatnonzero(pair_lang == i)
                    if lang in wave.langs and len(some):
                        slot_of[some] = wave.slots(lang, terms.take(pa.array(number[first[some]])))
                members = firsts(group_of).tolist()
                names = [(langs[int(lang_of[r])].as_py(), sources[int(source_of[r])].as_py()) for r in members]
                names = [name if name[0] in wave.langs else None for name in names]
                new = [name for name in names if name is not None and name not in at]
                size = sum(wave.langs[lang][1] - wave.langs[lang][0] for lang, _ in new)
                if at and (len(dense) + size) * 8 > HELD_BYTES:
                    yield emit()
                    at, dense, new = {}, np.zeros(0, dtype=np.int64), [name for name in names if name is not None]
                    size = sum(wave.langs[lang][1] - wave.langs[lang][0] for lang, _ in new)
                end = len(dense)
                for lang, source in new:
                    at[lang, source] = end
                    end += wave.langs[lang][1] - wave.langs[lang][0]
                dense = np.append(dense, np.zeros(size, dtype=np.int64))
                base = np.array([at[name] if name is not None else 0 for name in names], dtype=np.int64)
                slot = slot_of[pair]
                counted = slot >= 0
                dense += np.bincount(base[group_of[text[counted]]] + slot[counted], minlength=len(dense))
        yield emit()
    return run


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * counts / total) in integers, for counts <= total < 9.2 * 10**15."""
    whole, rest = np.zeros_like(counts), counts
    for _ in range(3):                                   # three decimal digits at a time
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return 1 + whole


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _terms_by_block(starts: Broadcast):
    """(language, block, slots, terms, n) of the kept terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, shard, data in zip(*(c.to_pylist() for c in batch.columns)):
                keys = [key[:-1] for key in pickle.loads(data).keys().to_pylist()]
                slot = starts.value[lang, shard] + np.arange(len(keys))
                begin = np.flatnonzero(np.append(True, np.diff(slot // BLOCK) != 0))
                pieces = list(zip(begin.tolist(), np.append(begin[1:], len(keys)).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(pieces), pa.string()), pa.array([int(slot[i]) // BLOCK for i, _ in pieces], pa.int64()),
                     pa.array([int(slot[i]) for i, _ in pieces], pa.int64()), pa.array([b" ".join(keys[i:j]) for i, j in pieces], pa.binary()),
                     pa.array([j - i for i, j in pieces], pa.int64())], names=["lang", "block", "first", "terms", "n"])
    return run


def _block_parts(groups: Broadcast, top: int):
    """For a cogroup by language and block of slots: partial sums of the pairs of sources, and each group's highest terms."""
    def run(kept: pa.Table, table: pa.Table) -> pa.Table:
        lang, low = kept["lang"][0].as_py(), kept["block"][0].as_py() * BLOCK
        totals = groups.value[lang]                      # source -> (n, v)
        counts: dict[str, np.ndarray] = {}
        for names, sizes, slots, n in zip(*(table[c].to_pylist() for c in ("sources", "sizes", "slots", "counts"))):
            slots, n, stop = unpack(slots, np.uint16), unpack(n, np.int64), np.cumsum(sizes).tolist()
            for source, size, j in zip(names, sizes, stop):
                dense = counts.setdefault(source, np.zeros(BLOCK, dtype=np.int64))
                dense[slots[j - size:j]] += n[j - size:j]
        here, names = [], []
        for first, data in zip(kept["first"].to_pylist(), kept["terms"].to_pylist()):
            found = data.split(b" ")
            here += range(first - low, first - low + len(found))
            names += found
        here, item = np.array(here), np.array(names, dtype=object)
        sources = sorted(totals)
        n, v = (np.array(x, dtype=np.int64) for x in zip(*(totals[s] for s in sources)))
        none = np.zeros(BLOCK, dtype=np.int64)
        count = np.stack([counts.get(s, none)[here] for s in sources])
        p = shares(count + 2, (n + 2 * v)[:, None])
        q = shares(count.sum(axis=0) + 2, n.sum() + 2 * v[:1])
        out = []
        for i, s in enumerate(sources):
            if i + 1 < len(sources):
                sums = _divergence(p[i][None, :], p[i + 1:]).sum(axis=1)
                out += [(lang, s, "pair", t, value) for t, value in zip(sources[i + 1:], sums.tolist())]
            more = np.flatnonzero((count[i] > 0) & (p[i] > q))
            value = _divergence(p[i][more], q[more])
            best = sorted(zip((-value).tolist(), item[more].tolist()))[:top]
            out += [(lang, s, "term", t.decode(), -x) for x, t in best]
        columns = list(zip(*out)) or [()] * 5
        types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "source", "part", "item", "value"])
    return run


def _waves(sizes: list) -> Iterator[list]:
    """(row, first slot) of the shards, by language, cut where their perfect hashes together exceed WAVE_BYTES."""
    wave, held, first, lang = [], 0, 0, None
    for row in sizes:
        if wave and held + row.n_bytes > WAVE_BYTES:
            yield wave
            wave, held = [], 0
        first = first if row.lang == lang else 0
        wave.append((row, first))
        held, first, lang = held + row.n_bytes, first + row.n, row.lang
    if wave:
        yield wave


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST,
          top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a language (part ``pair``), and each group's
    ``top`` terms (part ``term``), both by value, highest first, then item (a stored table)."""
    spark = docs.sparkSession
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(name)
                         for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    broadcast = spark.sparkContext.broadcast
    out = Scratch(spark, "divergence", until_exit=True)
    with Scratch(spark, "divergence-work") as work:
        n_bytes = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
        shards = min(n_bytes // SHARD_BYTES + 1, MOST_SHARDS)
        kept = work.store(
            rows.select("lang", "text")
            .mapInArrow(_document_counts(shards), "shard int, lang string, terms binary, counts binary").groupBy("shard")
            .applyInArrow(_kept_terms(least), "shard int, lang string, n long, n_bytes long, hash binary"), "shards")
        sizes = kept.drop("hash").orderBy("lang", "shard").collect()       # three numbers for each shard of a language
        counts, starts = None, {}
        for wave in _waves(sizes):
            low, high = (F.struct(F.lit(r.lang), F.lit(r.shard)) for r in (wave[0][0], wave[-1][0]))
            found = {(r.lang, r.shard): r.hash for r in
                     kept.where(F.struct("lang", "shard").between(low, high)).select("lang", "shard", "hash").collect()}
            starts.update({(r.lang, r.shard): first for r, first in wave})
            shared = broadcast((shards, [(r.lang, r.shard, first, r.n, found[r.lang, r.shard]) for r, first in wave]))
            part = work.store(rows.select("lang", "source", "text").mapInArrow(_recount(shared), _COUNTS), "counts")
            counts = part if counts is None else counts.unionByName(part)
            shared.destroy()
        return out.store(_parts(rows, kept, counts, starts, top, work), "audit")


def _parts(rows: DataFrame, kept: DataFrame, counts: DataFrame | None, starts: dict, top: int, work: Scratch) -> DataFrame:
    """The audit's rows from the stored counts of all waves."""
    spark = rows.sparkSession
    groups = work.store(rows.select("lang", "source").distinct(), "groups")
    schema = "lang string, source string, part string, item string, value long"
    if counts is None:                                   # no term is kept
        sums = spark.createDataFrame([], schema)
    else:
        terms = kept.select("lang", "shard", "hash").mapInArrow(
            _terms_by_block(spark.sparkContext.broadcast(starts)), "lang string, block long, first long, terms binary, n long")
        kept_of = kept.groupBy("lang").agg(F.sum("n").alias("v")).withColumnRenamed("lang", "_lang")
        counted = (counts.select("lang", F.explode(F.arrays_zip("sources", "n")).alias("g"))
                   .groupBy(F.col("lang").alias("_l"), F.col("g.sources").alias("_s")).agg(F.sum("g.n").alias("n")))
        totals: dict[str, dict[str, tuple[int, int]]] = {}
        for r in (groups.join(counted, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
                  .join(kept_of, F.col("lang") == F.col("_lang")).select("lang", "source", "n", "v")).collect():
            totals.setdefault(r.lang, {})[r.source] = (r.n or 0, r.v)
        both = terms.groupBy("lang", "block").cogroup(counts.groupBy("lang", "block"))
        sums = work.store(both.applyInArrow(_block_parts(spark.sparkContext.broadcast(totals), top), schema)
                          .groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")), "sums")
    pair = sums.where("part = 'pair'").select("lang", "source", "item", "value")
    pair = pair.unionByName(pair.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    others = groups.select(F.col("lang").alias("_l"), F.col("source").alias("item"))       # the result's own pairs
    every = groups.join(others, (F.col("lang") == F.col("_l")) & (F.col("source") != F.col("item"))).select("lang", "source", "item")
    pair = (every.join(pair, ["lang", "source", "item"], "left")
            .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    term = sums.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.withColumn("rank", F.row_number().over(order)).unionByName(term).withColumn("rank", F.col("rank").cast("int"))
