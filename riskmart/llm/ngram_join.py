"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct k-word shingles (64-bit hashes; fewer words
than k are one shingle). All shingles have one order: by the number of occurrences
in the corpus (a fixed-size array of cell counts over all texts), then by hash.
If two sets reach the threshold, their prefixes of length
n - ceil(t n) + m share at least m shingles, for any m. Each document chooses its
m: a longer prefix meets more sets, but asks more common shingles of a candidate,
so m minimises the estimated cost (occurrences of the prefix's shingles beyond the
expected noise of a cell, plus a verification for every such occurrence over m).
A pair is judged at the smaller m of the two; the length and positional filters
apply to every shared shingle, and all shingles shared by the prefixes together
bound the overlap that is still possible behind them.

A shingle in the prefixes of at most ``crowd`` sets gives its pairs; one with
more makes its sets a crowd, compared block against block without emitting the
pairs. All candidates are verified on their whole sets. Copies (equal sets) are
one node from the start. Links give components by star steps on stored edges; they
are counted where they are verified, one row for each set of a block pair.

Defined results: a null text, or one without words, has no shingles and no links and
is its own component; repeated rows are copies; an empty table gives an empty result; extra
columns are ignored; a null id is the component id only of documents alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from . import textvec
from .blocks import edges_and_links, gathered, placed, similar_enough
from .components import components
from .sketch import cell, hash_counts, hash_flags

BITS = 21                                # cells of the occurrence counts: 2**21
FILTER_BITS = 22                         # cells of the filter on documents to fetch again
CROWD = 64
MOST_MATCHES = 6                         # largest m considered
_U = np.uint64


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row, shingle) with distinct shingles sorted by row."""
    for lo, hi, raw, offsets in textvec.buffers(column):
        starts, _, hashes = textvec.words(raw, offsets)
        rows, values = textvec.distinct(*textvec.shingles(hashes, textvec.word_counts(starts, offsets), k))
        yield lo, hi, rows, values


def _occurrences(k: int):
    def run(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, raw, offsets in textvec.buffers(batch.column(0)):
            starts, _, hashes = textvec.words(raw, offsets)
            yield textvec.shingles(hashes, textvec.word_counts(starts, offsets), k)[1]
    return run


def matches_needed(extra: np.ndarray, n: int, num: int, den: int) -> int:
    """The m of least estimated cost; ``extra`` are the occurrences beyond noise, in shingle order."""
    least = -(-num * n // den)           # common shingles that any partner must have
    base = n - least
    most = min(MOST_MATCHES, least)
    met = np.cumsum(extra[:base + most])[base:]
    m = np.arange(1, len(met) + 1)
    return int(np.argmin(met + met / m * max(1.0, n / 8))) + 1


def set_hash(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each set that does not depend on the order; ``begin`` are the sets' first indices."""
    one = np.add.reduceat(textvec.mix(values), begin)
    two = np.add.reduceat(textvec.mix(values ^ _U(0xA0761D6478BD642F)), begin)
    return textvec.mix(one + textvec.mix(two))


def _prefixes(k: int, num: int, den: int, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = counts.value
        noise = cells.sum(dtype=np.float64) / len(cells)
        bits = len(cells).bit_length() - 1
        for batch in batches:
            for lo, hi, rows, values in shingle_sets(batch.column(1), k):
                n = np.bincount(rows, minlength=hi - lo)
                seen = cells[cell(values, bits)].astype(np.uint64)
                # order by occurrences, then by hash
                rank = (np.minimum(seen, 0xFFFFFF) << _U(40)) | (values >> _U(24))
                order = textvec.by_row(rows, rank)
                some = np.flatnonzero(n)
                end = np.cumsum(n[some])
                h = np.zeros(hi - lo, np.uint64)
                if len(some):
                    h[some] = set_hash(values, end - n[some])
                values, extra = values[order], np.maximum(seen[order].astype(np.float64) - 1 - noise, 0)
                m, size = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                parts = []
                for i, e in zip(some, end):
                    m[i] = matches_needed(extra[e - n[i]:e], n[i], num, den)
                    size[i] = n[i] - -(-num * n[i] // den) + m[i]
                    parts.append(values[e - n[i]:e - n[i] + size[i]])
                prefix = np.concatenate(parts) if parts else values[:0]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()),
                                                 pa.array(prefix.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(h.view(np.int64)),
                     pa.array(m.astype(np.int32)), lists], names=["id", "text_hash", "n", "h", "m", "prefix"])
    return run


def _fetch(k: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = wanted.value
        bits = len(cells).bit_length() - 1
        for batch in batches:
            keys = textvec.mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            some = pa.array(np.flatnonzero(cells[cell(keys, bits)]))
            for lo, hi, rows, values in shingle_sets(batch.column(1).take(some), k):
                n = np.bincount(rows, minlength=hi - lo)
                has = np.flatnonzero(n)
                if not len(has):
                    continue
                end = np.cumsum(n[has])
                h = set_hash(values, end - n[has])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.append(0, end), pa.int32()), pa.array(values.view(np.int64)))],
                    names=["h", "tokens"])
    return run


def _text_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield textvec.mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))


def candidates(sets: DataFrame, num: int, den: int, crowd: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of set hashes to verify, and crowds (token, h), from distinct sets with prefixes."""
    rows = (sets.select("h", "n", "m", F.posexplode("prefix").alias("pos", "token"))
            .select("token", "h", F.col("n").cast("int").alias("n"), F.col("m").cast("short").alias("m"),
                    F.col("pos").cast("int").alias("pos")))
    shared = rows.groupBy("token").agg(F.count("*").alias("met")).where("met > 1")
    rows = scratch.store(rows.join(shared, "token"), "shared")
    few = rows.where(F.col("met") <= crowd)
    level = F.greatest(F.lit(1), F.col("pos") - (F.col("n") - F.ceil(F.col("n") * num / den)) + 1).cast("int")
    few = few.withColumn("level", level)
    left = few.select("token", *[F.col(c).alias(f"{c}_a") for c in ("h", "n", "m", "pos", "level")])
    right = few.select("token", *[F.col(c).alias(f"{c}_b") for c in ("h", "n", "m", "pos", "level")])
    m = F.least("m_a", "m_b")        # a pair that shares a crowd's shingle is a candidate by it
    n_a, n_b, i, j = F.col("n_a"), F.col("n_b"), F.col("pos_a"), F.col("pos_b")
    possible = F.least(i, j) + 1 + F.least(n_a - i - 1, n_b - j - 1)
    pairs = (left.join(right, "token").where(
        (F.col("h_a") < F.col("h_b")) & similar_enough(n_a, n_b, num, den)
        & (possible * (num + den) >= num * (n_a + n_b)))
        .groupBy(F.col("h_a").alias("a"), F.col("h_b").alias("b"))
        .agg(F.count("*").alias("common"), F.sum((F.greatest("level_a", "level_b") <= m).cast("int")).alias("judged"),
             F.max(m).alias("m"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"),
             F.max("m_a").alias("m_a"), F.max("m_b").alias("m_b")))
    # shingles shared beyond the prefixes lie behind the prefix that ends first in the common order
    behind = F.greatest(*[F.ceil(F.col(n) * num / den) - F.col(k) for n, k in (("n_a", "m_a"), ("n_b", "m_b"))])
    pairs = pairs.where((F.col("judged") >= F.col("m"))
                        & ((F.col("common") + behind) * (num + den) >= num * (n_a + n_b))).select("a", "b")
    return scratch.store(pairs, "pairs"), rows.where(F.col("met") > crowd).select("token", "h", "n")


def near_duplicates(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id",
                    text: str = "text", crowd: int = CROWD, bits: int = BITS,
                    scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col, text_hash, n_shingles, component_id (the least id reachable by links),
    n_links (the other rows that it is linked to).

    Documents are linked when overlap / union of their shingle sets is at least num / den.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "ngram")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"),
                         F.xxhash64(F.col(text)).alias("text_hash"))
    counts = spark.sparkContext.broadcast(hash_counts(narrow.select("text"), _occurrences(k), bits))   # 2**bits cells
    every = scratch.store(narrow.mapInArrow(_prefixes(k, num, den, counts),
                                            "id long, text_hash long, n long, h long, m int, prefix array<long>"), "sets")
    sets = (every.where("n > 0").groupBy("h")
            .agg(F.min_by(F.struct("n", "m", "prefix", "id"), F.struct("id")).alias("s")).select("h", "s.*"))
    pairs, crowds = candidates(sets, num, den, crowd, scratch)
    hub = crowds.groupBy("token").agg(F.min("h").alias("b"))
    hints = pairs.unionByName(crowds.join(hub, "token").where("h <> b").select(F.col("h").alias("a"), "b").distinct())
    nodes = (pairs.select(F.explode(F.array("a", "b")).alias("h")).unionByName(crowds.select("h")).distinct())
    known = every.where("n > 0").groupBy("h").agg(F.min("text_hash").alias("text_hash"), F.max("n").alias("n"),
                                                   F.count("*").alias("copies"))
    nodes = scratch.store(nodes.join(known, "h"), "nodes")
    blocks = scratch.store(placed(nodes.select("h", "n"), hints), "blocks")
    groups = gathered(pairs, crowds.select("token", "h"), blocks)
    counts.destroy()                     # both are read by stored tables only
    wanted = spark.sparkContext.broadcast(hash_flags(nodes.select("text_hash"), _text_hashes, FILTER_BITS))
    tokens = narrow.select("text_hash", "text").mapInArrow(_fetch(k, wanted), "h long, tokens array<long>")
    tokens = scratch.store(tokens.join(nodes.select("h"), "h", "left_semi").groupBy("h")
                           .agg(F.any_value("tokens").alias("tokens")), "tokens")
    wanted.destroy()
    sets = tokens.join(blocks.select("h", "block"), "h").join(nodes.select("h", "copies"), "h")
    found = scratch.store(groups.join(sets, "h").groupBy("x", "y")
                          .applyInArrow(edges_and_links(num, den), "a long, b long, links long"), "links")
    roots = components(found.where("b is not null").select("a", "b"), scratch)
    others = (found.where("b is null").select(F.col("a").alias("h"), "links")
              .unionByName(every.where("n > 0").groupBy("h").agg((F.count("*") - 1).alias("links")).where("links > 0"))
              .groupBy("h").agg(F.sum("links").alias("links")))
    # every set of an edge has links
    alike = others.join(roots, F.col("h") == F.col("node"), "left").select(F.col("h").alias("_h"), "links", "root")
    keyed = (every.join(alike, (F.col("h") == F.col("_h")) & (F.col("n") > 0), "left")
             .select("id", "text_hash", "n", F.coalesce("links", F.lit(0)).cast("long").alias("links"),
                     F.when(F.col("n") > 0, F.coalesce("root", "h")).alias("key")))
    keyed = scratch.store(keyed, "keyed")
    least = keyed.where("key is not null").groupBy("key").agg(F.min("id").alias("least"))
    return (keyed.join(least, "key", "left")
            .select(F.col("id").alias(id_col), "text_hash", F.col("n").alias("n_shingles"),
                    F.coalesce("least", "id").alias("component_id"), F.col("links").alias("n_links")))


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` with the least id of their component, columns unchanged.

    Equal rows (id and text) are one; rows without an id stay unless linked to one with an id.
    """
    found = near_duplicates(docs, k, num, den, id_col, text, scratch=scratch)
    kept = (found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
            .select(F.col(id_col).alias("_kept"), F.col("text_hash").alias("_kept_hash")).distinct())
    keyed = docs.withColumn("_text_hash", F.xxhash64(F.col(text)))
    return (keyed.join(kept, keyed[id_col].cast("long").eqNullSafe(kept["_kept"])
                       & (keyed["_text_hash"] == kept["_kept_hash"]), "left_semi")
            .dropDuplicates([id_col, "_text_hash"]).drop("_text_hash"))
