"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

A pre-token is a run of bytes between ASCII white space. The tokenizer drops
white space and neither its normaliser, its splitting pattern nor its special
strings reach across it, so the count of a text is the sum over its pre-tokens.

Tier 1: the most frequent pre-tokens of the corpus with their lengths, a sorted
array of fixed size (``table_size`` entries) broadcast to every task. It comes
from one pass over all documents in which a task keeps a bounded summary (its
``summary_size`` most frequent pre-tokens), so no pre-token stream is shuffled:
only summaries are, and the table decides speed alone, never a count.
Tier 2: a miss goes to a bounded cache of the Python worker; what the cache
lacks is encoded once per batch, distinct pre-tokens only.
Pre-tokens are looked up by a 64-bit hash; those that hold a special string's
opening ``<|`` are always encoded.

Defined results: null or empty text has 0 bytes and 0 tokens; repeated rows are
counted each; an empty table gives an empty result; extra columns are ignored
unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec

TABLE_SIZE = 1 << 16
SUMMARY_SIZE = 1 << 13
CACHE_SIZE = 1 << 20
LONGEST = 64                             # bytes of a pre-token in tier 1, which bounds the table's bytes

_TOKENIZERS: dict[str, object] = {}
_CACHES: dict[str, dict[int, int]] = {}


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _TOKENIZERS[path] = tokenizer
    return _TOKENIZERS[path]


def _lengths(path: str, pieces: list[str], batch: int = 4096) -> np.ndarray:
    """Tokens of each piece."""
    tokenizer, out = _tokenizer(path), []
    for i in range(0, len(pieces), batch):
        out += [len(e.ids) for e in tokenizer.encode_batch(pieces[i:i + batch], add_special_tokens=False)]
    return np.array(out, dtype=np.int64)


def _piece(raw: np.ndarray, a: int, b: int) -> str:
    return raw[a:b].tobytes().decode("utf-8", "replace")


def _summaries(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        text: dict[int, str] = {}
        for batch in batches:
            for _, _, raw, offsets in textvec.buffers(batch.column(0)):
                starts, ends, hashes = textvec.words(raw, offsets, fold=False)
                short = ends - starts <= LONGEST
                starts, ends, hashes = starts[short], ends[short], hashes[short]
                new, first, n = np.unique(hashes, return_index=True, return_counts=True)
                top = np.argsort(-n, kind="stable")[:size]
                text.update((int(new[i]), _piece(raw, starts[first[i]], ends[first[i]]))
                            for i in top if int(new[i]) not in text)
                both, inverse = np.unique(np.concatenate([keys, new[top]]), return_inverse=True)
                total = np.bincount(inverse, weights=np.concatenate([counts, n[top]])).astype(np.int64)
                best = np.argsort(-total, kind="stable")[:2 * size]
                keys, counts = both[best], total[best]
                text = {int(k): text[int(k)] for k in keys}
        best = np.argsort(-counts, kind="stable")[:size]
        yield pa.RecordBatch.from_arrays(
            [pa.array([text[int(k)] for k in keys[best]], pa.string()), pa.array(counts[best], pa.int64())],
            names=["piece", "n"])
    return run


def frequent_pieces(docs: DataFrame, text: str = "text", table_size: int = TABLE_SIZE,
                    summary_size: int = SUMMARY_SIZE) -> list[str]:
    """The most frequent pre-tokens, at most ``table_size``, from bounded per-task summaries of all texts."""
    merged = (docs.select(F.col(text)).mapInArrow(_summaries(summary_size), "piece string, n long")
              .groupBy("piece").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "piece").limit(table_size))
    return [r.piece for r in merged.select("piece").collect()]


def _counter(path: str, table, kinds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_length = table.value
        cache = _CACHES.setdefault(path, {})
        for batch in batches:
            n_bytes = np.zeros(batch.num_rows, np.int64)
            n_tokens = np.zeros(batch.num_rows, np.int64)
            for lo, hi, raw, offsets in textvec.buffers(batch.column(kinds)):
                n_bytes[lo:hi] = np.diff(offsets)
                starts, ends, hashes = textvec.words(raw, offsets, fold=False)
                if not len(starts):
                    continue
                # a special string is case-sensitive text between "<|" and "|>": never from a table
                marks = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))
                special = np.zeros(len(starts), bool)
                special[np.searchsorted(starts, marks, side="right") - 1] = True
                length = np.zeros(len(starts), np.int64)
                found = np.zeros(len(starts), bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    found = (known[at] == hashes) & ~special
                    length[found] = known_length[at[found]]
                miss = np.flatnonzero(~found & ~special)
                keys, first, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
                have = [cache.get(k, -1) for k in keys.tolist()]
                have = np.array(have, np.int64) if have else np.zeros(0, np.int64)
                new = np.flatnonzero(have < 0)
                if len(new):
                    at = miss[first[new]]
                    have[new] = _lengths(path, [_piece(raw, starts[i], ends[i]) for i in at])
                    if len(cache) + len(new) > CACHE_SIZE:
                        cache.clear()
                    cache.update(zip(keys[new].tolist()[:CACHE_SIZE], have[new].tolist()))
                length[miss] = have[back]
                odd = np.flatnonzero(special)
                if len(odd):
                    length[odd] = _lengths(path, [_piece(raw, starts[i], ends[i]) for i in odd])
                row = np.searchsorted(offsets, starts, side="right") - 1
                n_tokens[lo:hi] = np.bincount(row, weights=length, minlength=hi - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kinds], pa.array(n_bytes), pa.array(n_tokens)],
                names=[*batch.schema.names[:kinds], "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text",
                 table_size: int = TABLE_SIZE, summary_size: int = SUMMARY_SIZE) -> DataFrame:
    """``keep`` columns of every row, then n_bytes (UTF-8) and n_tokens of the whole text.

    ``tokenizer_path`` is read on every worker (an installed vocabulary file).
    """
    spark = docs.sparkSession
    pieces = frequent_pieces(docs, text, table_size, summary_size)
    column = pa.array([p for p in pieces if "<|" not in p], pa.string())
    hashes = [textvec.words(raw, offsets, fold=False)[2] for _, _, raw, offsets in textvec.buffers(column)]
    keys = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    lengths = _lengths(tokenizer_path, column.to_pylist())
    order = np.argsort(keys)
    table = spark.sparkContext.broadcast((keys[order], lengths[order]))      # at most table_size entries
    narrow = docs.select(*[F.col(c) for c in keep], F.col(text))
    schema = T.StructType([*narrow.schema.fields[:len(keep)], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    return narrow.mapInArrow(_counter(tokenizer_path, table, len(keep)), schema)
