"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap checks.

The test items are the indexed collection; every passage of every document is a
query. Impacts are divided by the item's score for itself, so a score is the
share of an item's BM25 weight that a passage holds, and one threshold fits all
items. Passages are windows of two steps of words, a step being the longest item,
so an item lies whole in at least one window. The items are cut into ITEM_BLOCKS
equal ranges; a window for which the sum of its terms' largest impacts in every
range is below the threshold is dropped by numpy sums over whole batches. The
others run through block-max WAND, which returns every item at or above the
threshold. A hit is verified: the 5-word shingles of the item's
question (all but its last sentence) and of its answer (the last sentence; an
item of one sentence has none) must each be found in the passage to at least
``overlap``. The shorter of the two takes the longest shingles of at most 5 words of
which one changed word leaves that share (``shingle_words``); with fewer than three
words the item's shingles stand for it.

Words are cut at white space and ASCII marks, A-Z as a-z. The index is broadcast
in shards of at most about ``shard_bytes`` of item text, one pass over the
documents for each shard, so its size does not grow with the benchmark. Document
frequencies, the number of items, their mean and greatest length are those of the whole
benchmark, so scores and hits do not depend on the shards.

Defined results: null or empty documents and items have no words and never
match; items with equal texts each match; repeated rows are reported each; empty
tables give an empty result; extra columns pass through ``clean_documents`` and
are ignored by ``contaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec

THRESHOLD = 0.5
OVERLAP = 0.6
SHINGLE = 5
SHARD_BYTES = 4 << 20
ITEM_BLOCKS = 64                         # ranges of items, each with a bound per term
K1, B = 1.2, 0.75
_EDGE = 1e-9
_TINY = 1e-30
_FILTER_BITS = 16

FOUND = "item_id long, passages int, score double, question_overlap double, answer_overlap double"


def _word_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    return textvec.words(raw, np.array([0, len(raw)]), bare=True)[2]


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct k-word shingles of one sequence of at least k words."""
    return np.unique(textvec.shingles(hashes, np.array([len(hashes)]), k)[1])


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last sentence, and the last; one sentence is a question."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def shingle_words(n: int, overlap: float) -> int:
    """The longest shingle, up to SHINGLE words, of which one changed word among ``n`` leaves the share ``overlap``; or 0."""
    return max((k for k in range(1, SHINGLE + 1) if n - 2 * k + 1 >= overlap * (n - k + 1) > 0), default=0)


def verified_parts(text: str, whole: np.ndarray, overlap: float) -> list[tuple[np.ndarray, int]]:
    """Word hashes and shingle length of question and answer; length 0 for an empty part."""
    parts = [_word_hashes(part) for part in question_and_answer(text)]
    out = [(part, min(SHINGLE, len(part))) for part in parts]
    short = int(len(parts[1]) <= len(parts[0]))
    n = len(parts[short])
    if n and len(parts[1 - short]) >= SHINGLE:
        k = shingle_words(n, overlap)
        out[short] = (parts[short], k) if k else (whole, SHINGLE)
    return out


class Statistics(NamedTuple):
    """Of a whole benchmark: number of items, mean and greatest length, and some terms with their document frequencies."""
    items: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


class Index:
    """Postings per term in item order, impacts divided by the item's own score, maxima per block.

    ``known`` holds the statistics of the whole benchmark, with the terms of these items at least;
    without it the items are the benchmark.
    """

    def __init__(self, items: list[tuple[int, str]], overlap: float = OVERLAP, known: Statistics | None = None):
        words = [_word_hashes(t or "") for _, t in items]
        self.ids = [i for i, _ in items]
        self.parts = [verified_parts(t or "", w, overlap) for (_, t), w in zip(items, words)]
        counted = [np.unique(w, return_counts=True) for w in words]
        terms = np.concatenate([c[0] for c in counted]) if counted else np.zeros(0, np.uint64)
        tf = np.concatenate([c[1] for c in counted]).astype(float) if counted else np.zeros(0)
        item = np.repeat(np.arange(len(words)), [len(c[0]) for c in counted])
        length = np.array([len(w) for w in words], dtype=float)
        self.terms, at, df = np.unique(terms, return_inverse=True, return_counts=True)
        if known is None:
            known = Statistics(len(words), length.mean() if len(words) else 0.0, int(max(length, default=0)), self.terms, df)
        self.step = max(1, known.longest)
        df = known.df[np.searchsorted(known.terms, self.terms)]
        idf = np.log1p((known.items - df + 0.5) / (df + 0.5))
        mean = max(1.0, known.mean)
        impact = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / mean)) if len(tf) else tf
        own = np.bincount(item, impact, len(words)) if len(tf) else np.zeros(len(words))
        impact = impact / own[item] if len(tf) else impact
        order = np.lexsort((item, at))
        self.item, self.impact = item[order], impact[order]
        # largest impact of each term in each range of items, rounded up
        ranges = np.zeros((len(self.terms), ITEM_BLOCKS), dtype=np.float32)
        np.maximum.at(ranges, (at[order], self.item * ITEM_BLOCKS // max(1, len(words))), self.impact)
        self.ranges = np.nextafter(ranges, np.float32(2))
        # first posting of each term in each range
        edge = -(-np.arange(ITEM_BLOCKS + 1) * max(1, len(words)) // ITEM_BLOCKS)
        key = at[order] * (len(words) + 1) + self.item
        self.offsets = np.searchsorted(key, np.arange(len(self.terms))[:, None] * (len(words) + 1) + edge[None, :])
        self.present = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.present[(self.terms >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are terms, and their term numbers."""
        some = np.flatnonzero(self.present[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[some]), max(0, len(self.terms) - 1))
        hit = self.terms[at] == hashes[some] if len(self.terms) else np.zeros(len(some), bool)
        return some[hit], at[hit]

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose score for the distinct ``terms`` is at least ``threshold``.

        Ranges of items whose summed maxima stay below the threshold are skipped whole; in each
        other range the lists move by WAND with the range's maxima.
        """
        need, out = threshold - _EDGE, []
        held = self.ranges[terms]
        for r in np.flatnonzero(held.sum(axis=0, dtype=np.float64) >= need):
            some = np.flatnonzero(held[:, r] > _TINY)
            out += self._wand(terms[some], held[some, r], int(r), need)
        return out

    def _wand(self, terms: np.ndarray, best: np.ndarray, r: int, need: float) -> list[tuple[int, float]]:
        """Items of range ``r`` that score at least ``need``."""
        item, impact, out = self.item, self.impact, []
        end = -(-(r + 1) * len(self.ids) // ITEM_BLOCKS)
        lists = [[int(a), int(b), float(m)] for a, b, m in zip(self.offsets[terms, r], self.offsets[terms, r + 1], best)]
        while True:
            lists = sorted((c for c in lists if c[0] < c[1]), key=lambda c: item[c[0]])
            total, pivot = 0.0, end
            for c in lists:
                total += c[2]
                if total >= need:
                    pivot = int(item[c[0]])
                    break
            if pivot >= end:
                return out
            score = 0.0
            for c in lists:
                while c[0] < c[1] and item[c[0]] < pivot:       # a range's list is a few postings
                    c[0] += 1
                if c[0] < c[1] and item[c[0]] == pivot:
                    score += float(impact[c[0]])
                    c[0] += 1
            if score >= need:
                out.append((pivot, score))

    def overlaps(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        """Shares of the question's and the answer's shingles found in the passage; 1 for an empty answer."""
        out = []
        for words, k in self.parts[item]:
            if not k:
                out.append(1.0)
            elif len(passage) < k:
                out.append(0.0)
            else:
                wanted = grams(words, k)
                out.append(float(np.isin(wanted, textvec.shingles(passage, np.array([len(passage)]), k)[1]).mean()))
        return out[0], out[1]


def _range_bounds(index: Index, term: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Per step and range of items: the sum of the largest impacts of the step's terms."""
    out = np.zeros((len(begin), ITEM_BLOCKS), dtype=np.float32)
    stop = np.append(begin[1:], len(term))
    lo = 0
    while lo < len(begin):               # about 32,768 terms at a time
        hi = max(lo + 1, int(np.searchsorted(stop, begin[lo] + (1 << 15), side="right")))
        some = np.flatnonzero(stop[lo:hi] > begin[lo:hi]) + lo
        if len(some):
            out[some] = np.add.reduceat(index.ranges[term[begin[lo]:stop[hi - 1]]], begin[some] - begin[lo], axis=0)
        lo = hi
    return out


def _matches(index: Index, column: pa.Array, threshold: float, overlap: float) -> Iterator[tuple]:
    """(row, item, score, question overlap, answer overlap) of every verified passage."""
    step = index.step
    for lo, _, raw, offsets in textvec.buffers(column):
        starts, _, hashes = textvec.words(raw, offsets, bare=True)
        counts = textvec.word_counts(starts, offsets)
        steps = -(-counts // step)                       # steps of each text
        first_step = np.append(0, np.cumsum(steps))
        first_word = np.append(0, np.cumsum(counts))
        at, term = index.lookup(hashes)
        if not len(at):
            continue
        row = np.searchsorted(first_word, at, side="right") - 1
        place = first_step[row] + (at - first_word[row]) // step
        key = np.unique(place * len(index.terms) + term)  # distinct terms of each step
        place, term = key // len(index.terms), key % len(index.terms)
        begin = np.searchsorted(place, np.arange(int(first_step[-1]) + 2))
        bound = _range_bounds(index, term, begin[:-1])
        of = np.repeat(np.arange(len(counts)), steps)
        last = np.append(of[1:] != of[:-1], True)
        pair = np.where(last[:, None], bound[:-1], bound[:-1] + bound[1:]).max(axis=1)
        for s in np.flatnonzero(pair >= threshold - 1e-4):     # sums of single precision
            if last[s] and s > 0 and of[s - 1] == of[s]:
                continue                                  # the last step is part of the window before
            stop = s + 1 if last[s] else s + 2
            terms = np.unique(term[begin[s]:begin[stop]])
            text = of[s]
            a = first_word[text] + (s - first_step[text]) * step
            passage = hashes[a:min(first_word[text + 1], a + 2 * step)]
            for item, score in index.search(terms, threshold):
                question, answer = index.overlaps(item, passage)
                if question >= overlap and answer >= overlap:
                    yield lo + int(text), item, round(score, 9), question, answer   # sums in the order of the shard


def _report(index, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple[int, int], list] = {}
            for row, item, score, question, answer in _matches(index.value, batch.column(1), threshold, overlap):
                entry = best.setdefault((row, item), [0, 0.0, 0.0, 0.0])
                entry[0] += 1
                entry[1:] = max(tuple(entry[1:]), (score, question, answer))
            rows = pa.array([r for r, _ in best], pa.int64())
            columns = [[index.value.ids[i] for _, i in best], *(([e[k] for e in best.values()]) for k in range(4))]
            types = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "item_id", "passages", "score", "question_overlap", "answer_overlap"])
    return run


def _keep(index, text_at: int, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[m[0] for m in _matches(index.value, batch.column(text_at), threshold, overlap)]] = False
            yield batch.filter(pa.array(clean))
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shard, number of words and distinct terms of each item."""
    for batch in batches:
        words = [_word_hashes(t) for t in batch.column(1).to_pylist()]
        terms = pa.array([np.unique(w).view(np.int64) for w in words], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(w) for w in words], pa.int64()), terms],
                                         names=["shard", "n_words", "terms"])


def index_shards(benchmark: DataFrame, item_col: str = "item_id", text: str = "text",
                 shard_bytes: int = SHARD_BYTES, overlap: float = OVERLAP) -> Iterator[Index]:
    """One index after another, each over at most about ``shard_bytes`` of item text."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    shards = int(total // shard_bytes) + 1
    items = items.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)).cast("int"))
    counted = items.select("shard", "text").mapInArrow(_item_terms, "shard int, n_words long, terms array<long>")
    sums = counted.agg(F.count("*").alias("items"), F.sum("n_words").alias("words"), F.max("n_words").alias("longest")).head()
    each = counted.select("shard", F.explode("terms").alias("term"))
    frequency = each.groupBy("term").agg(F.count("*").alias("df"))
    for shard in range(shards):
        # bounded by the shard's text: its rows, and one row for each of its terms
        own = each.where(F.col("shard") == shard).select("term").distinct().join(frequency, "term").toArrow()
        term = own.column("term").to_numpy().view(np.uint64)
        order = np.argsort(term)
        known = Statistics(sums.items, (sums.words or 0) / max(1, sums.items), sums.longest or 0,
                           term[order], own.column("df").to_numpy()[order])
        rows = sorted((r.id if r.id is not None else -1, r.id, r.text) for r in items.where(F.col("shard") == shard).collect())
        yield Index([(i, t) for _, i, t in rows], overlap, known)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
                 id_col: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document and item found in it: id_col, item_id, passages, score, overlaps."""
    narrow = docs.select(F.col(id_col), F.col(text))
    schema = T.StructType([T.StructField("doc_id", narrow.schema[0].dataType), *T._parse_datatype_string(FOUND).fields])
    out = None
    for index in index_shards(benchmark, shard_bytes=shard_bytes, overlap=overlap):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        part = narrow.mapInArrow(_report(shared, threshold, overlap), schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("doc_id", id_col)


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
                    text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no test item, columns unchanged."""
    for index in index_shards(benchmark, shard_bytes=shard_bytes, overlap=overlap):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.mapInArrow(_keep(shared, docs.columns.index(text), threshold, overlap), docs.schema)
    return docs
