"""Quality classifier: a generalised additive model with pairwise interactions.

Features describe the text alone (shape of words, symbols, repetition). Each is
cut into bins at training quantiles. Boosting goes round the features in cycles:
in each step a shallow tree over one feature's bins is fitted to the log-loss
gradient and added, shrunk, to that feature's lookup table, so the sum of all
trees of a feature is one table. The feature pairs with the largest remaining
gain then get two-dimensional tables in the same way. A score is the sigmoid of
the intercept plus one table entry per feature and pair: vectorised additions.

Training uses labelled rows only, at most about ``sample_rows`` of them, chosen
by a hash of the id (a documented bound; their features are what the driver
collects). Scoring covers every whole text in one pass.

Defined results: a null or empty text has zero features and a score; without any
labelled row the score is 0.5, with one class alone it is 0.98 or 0.02;
labels that are null or name no document are ignored; repeated rows are scored
each; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec
from .running import uniform

SAMPLE_ROWS = 40_000
THRESHOLD = 0.3

FEATURES = ["log_bytes", "log_words", "word_bytes", "word_bytes_sd", "upper", "digit", "symbol", "pipe", "high",
            "line_words", "sentence_words", "mark_end", "caps_words", "distinct_words", "top_word",
            "repeat_words", "distinct_shingles", "short_words"]


def _classes() -> dict[str, np.ndarray]:
    def of(chars: bytes) -> np.ndarray:
        table = np.zeros(256, dtype=bool)
        table[list(chars)] = True
        return table
    high = np.zeros(256, dtype=bool)
    high[128:] = True
    return {"upper": of(bytes(range(65, 91))), "lower": of(bytes(range(97, 123))), "digit": of(b"0123456789"),
            "symbol": of(b"!\"#$%&'()*+/<=>@[\\]^_`{}~|"), "pipe": of(b"|"), "high": high,
            "newline": of(b"\n"), "end": of(b".!?")}


_CLASS = _classes()


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    out = np.zeros((len(column), len(FEATURES)))
    for lo, hi, raw, offsets in textvec.buffers(column):
        out[lo:hi] = _slice_features(raw, offsets)
    return out


def _slice_features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    n_bytes = np.diff(offsets)
    before = {}
    for name, table in _CLASS.items():
        total = np.zeros(len(raw) + 1, dtype=np.int32)
        np.cumsum(table[raw], out=total[1:])
        before[name] = total
    count = {name: (total[offsets[1:]] - total[offsets[:-1]]).astype(float) for name, total in before.items()}
    starts, ends, hashes = textvec.words(raw, offsets)
    words = textvec.word_counts(starts, offsets)
    row = np.repeat(np.arange(rows), words)
    length = (ends - starts).astype(float)

    def per_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=values, minlength=rows)

    def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(rows), where=b > 0)

    n, size = words.astype(float), n_bytes.astype(float)
    mean = ratio(per_row(length), n)
    spread = np.sqrt(np.maximum(ratio(per_row(length ** 2), n) - mean ** 2, 0))
    symbol_end = _CLASS["symbol"][raw[ends - 1]] if len(ends) else np.zeros(0)
    uppers = before["upper"][ends] - before["upper"][starts]
    lowers = before["lower"][ends] - before["lower"][starts]
    again = np.zeros(len(row))
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    top = np.zeros(rows)
    np.maximum.at(top, r[first], np.diff(np.append(first, len(r))).astype(float))
    srow, svalue = textvec.shingles(hashes, words, 5)
    drow, _ = textvec.distinct(srow, svalue)
    shingles = np.bincount(srow, minlength=rows).astype(float)
    return np.column_stack([
        np.log1p(size), np.log1p(n), mean, spread, ratio(count["upper"], size), ratio(count["digit"], size),
        ratio(count["symbol"], size), ratio(count["pipe"], size), ratio(count["high"], size),
        ratio(n, count["newline"] + 1), ratio(n, count["end"] + 1), ratio(per_row(symbol_end), n),
        ratio(per_row((uppers > 0) & (lowers == 0)), n), ratio(np.bincount(r[first], minlength=rows).astype(float), n),
        ratio(top, n), ratio(per_row(again), n),
        ratio(np.bincount(drow, minlength=rows).astype(float), shingles), ratio(per_row(length <= 3), n)])


# ---------------------------------------------------------------- the model

class AdditiveModel:
    """Bin edges, one table per feature, one table per chosen pair."""

    def __init__(self, edges, tables, pairs, intercept):
        self.edges, self.tables, self.pairs, self.intercept = edges, tables, pairs, intercept

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for i, t in enumerate(self.tables):
            total += t[b[:, i]]
        for i, j, t in self.pairs:
            total += t[b[:, i], b[:, j]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def _gain(g, h, ridge):
    return g * g / (h + ridge)


def _cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Best gain and position of one cut of a histogram; position 0 for none."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(left_g, left_h, ridge) + _gain(g.sum() - left_g, h.sum() - left_h, ridge) \
        - _gain(g.sum(), h.sum(), ridge)
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, cuts: int, ridge: float) -> np.ndarray:
    """Leaf values per bin of a tree with at most ``cuts`` cuts."""
    parts = [(0, len(g))]
    for _ in range(cuts):
        gain, at, k = max(((*_cut(g[a:b], h[a:b], ridge), k) for k, (a, b) in enumerate(parts)))
        if gain <= 1e-9:
            break
        a, b = parts[k]
        parts[k:k + 1] = [(a, a + at), (a + at, b)]
    value = np.zeros(len(g))
    for a, b in parts:
        value[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return value


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf values of a tree over two features: one cut of the first, one of the second on either side."""
    _, at = _cut(g.sum(1), h.sum(1), ridge)
    value = np.zeros(g.shape)
    for a, b in ((0, at), (at, len(g))):
        if a == b:
            continue
        column_g, column_h = g[a:b].sum(0), h[a:b].sum(0)
        value[a:b] = _shallow_tree(column_g, column_h, 1, ridge)
    return value


def fit(x: np.ndarray, y: np.ndarray, n_bins: int = 48, cycles: int = 120, rate: float = 0.1, n_pairs: int = 6,
        pair_cycles: int = 40, ridge: float = 2.0) -> AdditiveModel:
    """Cyclic boosting of shallow trees on binned features, then on the pairs with the largest gain."""
    k = x.shape[1] if x.ndim == 2 else len(FEATURES)
    positive = float(y.mean()) if len(y) else 0.0
    if not 0 < positive < 1:
        flat = 0.0 if not len(y) else (4.0 if positive else -4.0)        # one class only: nearly sure of it
        return AdditiveModel([np.zeros(0)] * k, [np.zeros(1)] * k, [], flat)
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, n_bins + 1)[1:-1])) for i in range(k)]
    model = AdditiveModel(edges, [np.zeros(len(e) + 1) for e in edges], [], float(np.log(positive / (1 - positive))))
    b = model.bins(x)
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(cycles):
        for i, t in enumerate(model.tables):
            g, h = slopes()
            step = rate * _shallow_tree(np.bincount(b[:, i], g, len(t)), np.bincount(b[:, i], h, len(t)), 3, ridge)
            t += step
            total += step[b[:, i]]
    sizes = [len(t) for t in model.tables]
    g, h = slopes()

    def grid(i, j, w):
        return np.bincount(b[:, i] * sizes[j] + b[:, j], w, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    gains = []
    for i in range(k):
        for j in range(i + 1, k):
            gg, hh = grid(i, j, g), grid(i, j, h)
            v = _quadrants(gg, hh, ridge)
            gains.append((float((v * gg).sum()), i, j))
    for _, i, j in sorted(gains, reverse=True)[:n_pairs]:
        model.pairs.append((i, j, np.zeros((sizes[i], sizes[j]))))
    for _ in range(pair_cycles):
        for i, j, t in model.pairs:
            g, h = slopes()
            step = rate * _quadrants(grid(i, j, g), grid(i, j, h), ridge)
            t += step
            total += step[b[:, i], b[:, j]]
    return model


# ---------------------------------------------------------------- Spark

def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch.column(0))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([flat, batch.column(1)], names=["x", "y"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on at most about ``sample_rows`` labelled documents whose crc32(id) is not 0 modulo 5."""
    usable = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
              .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
              .groupBy("_id").agg(F.max("_label").alias("_label")))
    share = sample_rows / max(1, usable.count())
    if share < 1:
        usable = usable.where(uniform(F.xxhash64(F.lit("train"), "_id")) < share)
    rows = (docs.select(F.col(id_col), F.col(text))
            .join(F.broadcast(usable), F.col(id_col) == F.col("_id"))            # about sample_rows small rows
            .select(F.col(text), F.col("_label")).mapInArrow(_feature_rows, "x array<double>, y int"))
    sample = rows.toArrow()
    x = sample["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = sample["y"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))        # the fit does not depend on the order of rows
    return fit(x[order], y[order])


def _score_rows(shared, text_at: int, least: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            score = model.score(features(batch.column(text_at)))
            if least is None:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)],
                                                 names=[*batch.schema.names, "_score"])
            else:
                yield batch.filter(pa.array(score >= least))
    return run


def with_score(docs: DataFrame, model: AdditiveModel, out: str = "score", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1), which replaces a column of its name."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])
    return docs.mapInArrow(_score_rows(shared, docs.columns.index(text), None), schema).withColumnRenamed("_score", out)


def good_documents(docs: DataFrame, model: AdditiveModel, text: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_score_rows(shared, docs.columns.index(text), threshold), docs.schema)
