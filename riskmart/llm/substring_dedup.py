"""Substring dedup by super-k-mers: words covered by a window that an earlier document holds are removed.

A window is ``K`` consecutive words. Its minimiser is the least hash among its runs of
``M`` words; consecutive windows of one minimiser value travel as one packed string of
words to the minimiser's bucket. There words are numbered (equal bytes, equal numbers),
windows become exact numbers by doubling (pairs of words, of pairs, ...), and one sort
of them gives every window's least document id.

Documents are dealt by hash into groups of about ``GROUP_BYTES`` of text. A group sends
each distinct string once, with the least id that holds it, so a passage that a third of
all documents share, or a text with any number of copies, is one row a group. The answer
is one bit per window: whether a document with a smaller id holds it. In a group every
later holder of a string loses it anyway.

A run of words that occurs more often than a bucket holds (``FREQUENT``, found by a
sample of positions that only decides where windows travel) is no minimiser as long as
the window has another; a window made of such runs only travels by itself, dealt by its
own hash. So no bucket grows with one frequent run.

Defined results: null and empty texts have no words; texts under ``K`` words lose none;
rows of equal id never remove each other's words; a null id counts as the least long;
equal rows get equal results; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec
from .packing import binary, byte_class, numbered, numbered_pairs, pack, spaced, unpack

K = 13                                   # words of a window
M = 3                                    # words of a minimiser
GROUP_BYTES = 4 << 20                    # text of a group of documents
BUCKET_BYTES = 3 << 20                   # text of the corpus for each bucket
FREQUENT = 1 << 18                       # occurrences of a run of M words that a bucket takes
MOST_FREQUENT = 1 << 20                  # so many runs can be called frequent, at most
_SEEN = 32                               # sampled occurrences that make a run frequent
_LEAST = -(1 << 63)
_U = np.uint64
_WORD = ~byte_class(0x20, range(0x09, 0x0E))


def _runs(hashes: np.ndarray) -> np.ndarray:
    """Hash of the M words from every word on (the last M - 1 are of no use)."""
    out = np.zeros(len(hashes), dtype=_U)
    for i in range(M):
        out[:len(hashes) - i] = textvec.mix(out[:len(hashes) - i] + hashes[i:] + _U(i + 1))
    return out


def _sampled(share: float):
    """Hashes of the runs at sampled positions."""
    limit = _U(min(share, 1.0) * ((1 << 64) - 1025))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(_LEAST).to_numpy().view(_U)
            for lo, hi, raw, offsets in textvec.buffers(batch.column(1)):
                starts, _, hashes = textvec.words(raw, offsets, fold=False)
                row = np.searchsorted(offsets, starts, side="right") - 1
                whole = np.flatnonzero(row[:-M + 1] == row[M - 1:]) if len(row) >= M else np.zeros(0, np.int64)
                at = textvec.mix(textvec.mix(ids[lo:hi])[row[whole]] + (starts[whole] - offsets[row[whole]]).astype(_U))
                yield pa.RecordBatch.from_arrays([pa.array(_runs(hashes)[whole][at <= limit].view(np.int64))], names=["run"])
    return run


def frequent_runs(rows: DataFrame, n_bytes: int) -> np.ndarray:
    """Sorted hashes of the runs of M words above the bound; at most about twice MOST_FREQUENT."""
    bound = max(FREQUENT, n_bytes // MOST_FREQUENT)
    found = (rows.mapInArrow(_sampled(2 * _SEEN / bound), "run long").groupBy("run").agg(F.count("*").alias("n"))
             .where(F.col("n") >= _SEEN).select("run"))
    return np.sort(found.toArrow()["run"].to_numpy().astype(np.int64).view(_U))


@dataclass
class _Group:
    """The super-k-mers of a group of documents, in an order that only depends on its rows."""

    ids: np.ndarray          # per row; null is the least long
    null: np.ndarray
    offsets: np.ndarray      # first word of each row, one more than rows
    data: np.ndarray         # the words, a blank behind each
    at: np.ndarray           # words' offsets in data
    first: np.ndarray        # per occurrence of a string: first window,
    last: np.ndarray         # last window,
    row: np.ndarray          # row,
    string: np.ndarray       # number of the distinct string
    strings: list            # distinct strings, a line end behind the last word
    owner: np.ndarray        # the least id that holds a string,
    windows: np.ndarray      # its windows,
    bucket: np.ndarray       # and bucket


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    out, have = values, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _group(table: pa.Table, frequent: np.ndarray, buckets: int) -> _Group:
    table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending"), ("text", "ascending")], null_placement="at_start"))
    ids = table["id"].combine_chunks()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(_LEAST).to_numpy()
    order = np.argsort(ids, kind="stable")               # a null among rows of the least long
    ids, null, texts = ids[order], null[order], table["text"].take(pa.array(order))
    every = [textvec.words(raw, offsets, fold=False) + (raw, offsets) for _, _, raw, offsets in textvec.buffers(texts, 1 << 40)]
    starts, ends, hashes, raw, cut = every[0]
    data, at = spaced(raw, starts, ends, _WORD)
    offsets = np.searchsorted(starts, cut)
    offsets[-1] = len(starts)
    row = np.repeat(np.arange(len(ids)), np.diff(offsets))
    n = max(len(starts) - K + 1, 0)
    whole = row[:n] == row[K - 1:]
    if not whole.any():
        none = np.zeros(0, np.int64)
        return _Group(ids, null, offsets, data, at, none, none, none, none, [], none, none, none)
    run = _runs(hashes)[:len(hashes) - M + 1]
    often = np.zeros(len(run), dtype=bool)
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, run), len(frequent) - 1)] == run
    least = _sliding_least((run >> _U(1)) | (often.astype(_U) << _U(63)), K - M + 1)
    alone = np.flatnonzero(whole & (least >> _U(63) > 0))                  # only frequent runs: by the whole window
    if len(alone):
        own = np.zeros(len(alone), dtype=_U)
        for i in range(K):
            own = textvec.mix(own + hashes[alone + i] + _U(i + 1))
        least[alone] = own | _U(1 << 63)
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
    new[alone] = True
    first = np.flatnonzero(new)
    end = whole.copy()
    end[:-1] &= ~whole[1:] | new[1:]
    last = np.flatnonzero(end)
    known: dict[bytes, int] = {}
    body = data.tobytes()
    lo, hi = at[first].tolist(), (at[last + K] - 1).tolist()
    string = np.fromiter((known.setdefault(body[i:j], len(known)) for i, j in zip(lo, hi)), np.int64, len(first))
    seen, once = np.unique(string, return_index=True)                      # rows ascend by id: the first holder is the least
    return _Group(ids, null, offsets, data, at, first, last, row[first], string, [s + b"\n" for s in known],
                  ids[row[first[once]]], (last - first + 1)[once],
                  (textvec.mix(least[first[once]]) % _U(buckets)).astype(np.int64))


def _by_bucket(group: _Group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings in order of bucket, and where each bucket begins, with one more at the end."""
    order = np.argsort(group.bucket, kind="stable")
    bucket = group.bucket[order]
    begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
    return order, np.append(begin, len(order)), bucket[begin]


def _sent(frequent, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        group = _group(table, frequent.value, buckets)
        order, begin, bucket = _by_bucket(group)
        pieces = [order[i:j] for i, j in zip(begin[:-1], begin[1:])]
        return pa.table({
            "part": pa.array(np.full(len(pieces), table["part"][0].as_py()), pa.int64()),
            "bucket": pa.array(bucket, pa.int64()),
            "strings": pa.array([pack(np.frombuffer(b"".join(group.strings[i] for i in p.tolist()), np.uint8)) for p in pieces],
                                pa.binary()),
            "owners": pa.array([pack(group.owner[p]) for p in pieces], pa.binary())})
    return run


def _window_keys(word: np.ndarray, of_pair) -> np.ndarray:
    """A key of the K words from every word on: of pairs of words, of pairs of those, and so on."""
    two = of_pair(word[:-1].astype(_U), word[1:].astype(_U)).astype(_U)
    four = of_pair(two[:-2], two[2:]).astype(_U)
    eight = of_pair(four[:-4], four[4:]).astype(_U)
    return of_pair(eight[:-5], eight[5:]).astype(_U)                       # words 0-7 and 5-12


def _counted(table: pa.Table) -> pa.Table:
    """For applyInArrow over a bucket: one bit per window - a smaller id holds it too."""
    strings = [unpack(s, np.uint8) for s in table["strings"].to_pylist()]
    owners = np.concatenate([unpack(s, np.int64) for s in table["owners"].to_pylist()])
    data = np.concatenate(strings)
    stops = np.flatnonzero((data == 0x20) | (data == 0x0A))
    line_end = data[stops] == 0x0A
    string = np.append(0, np.cumsum(line_end)[:-1])
    data = np.where(data == 0x0A, np.uint8(0x20), data)
    word = numbered(binary(data, np.append(0, stops + 1)))[0]
    at = np.flatnonzero(string[:-K + 1] == string[K - 1:])                 # windows by their first words
    owner = owners[string[at]]
    window = _window_keys(word, lambda x, y: textvec.mix(x * _U(0x9E3779B97F4A7C15) + textvec.mix(y + _U(1))))[at]
    order = np.argsort(window)
    same = window[order[1:]] == window[order[:-1]]
    x, y = at[order[1:][same]], at[order[:-1][same]]
    if any((word[x + i] != word[y + i]).any() for i in range(K)):          # two windows of one hash: number them instead
        window = _window_keys(word, numbered_pairs)[at]
        order = np.argsort(window)
        same = window[order[1:]] == window[order[:-1]]
    begin = np.flatnonzero(np.append(True, ~same))
    least = np.minimum.reduceat(owner[order], begin)
    later = np.empty(len(window), dtype=bool)
    later[order] = owner[order] > np.repeat(least, np.diff(np.append(begin, len(window))))
    # windows of each row of the table, in its order
    rows_end = np.cumsum([int(np.count_nonzero(s == 0x0A)) for s in strings])
    cut = np.searchsorted(string[at], np.append(0, rows_end))
    bits = [later[i:j] for i, j in zip(cut[:-1], cut[1:])]
    some = [i for i, b in enumerate(bits) if b.any()]
    return pa.table({"part": table["part"].take(pa.array(some, pa.int64())), "bucket": table["bucket"].take(pa.array(some, pa.int64())),
                     "later": pa.array([pack(np.packbits(bits[i])) for i in some], pa.binary())})


def _kept(frequent, buckets: int):
    """For a cogroup by part: the rows with the words that stay."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _group(table, frequent.value, buckets)
        n_words, rows = len(group.at) - 1, len(group.ids)
        order, begin, bucket = _by_bucket(group)
        later = np.zeros(int(group.windows.sum()), dtype=bool)             # windows of the strings in that order
        stop = np.append(0, np.cumsum(group.windows[order]))
        place = {b: (stop[i], stop[j]) for b, i, j in zip(bucket.tolist(), begin[:-1], begin[1:])}
        for b, bits in zip(answers["bucket"].to_pylist(), answers["later"].to_pylist()):
            lo, hi = place[b]
            later[lo:hi] = np.unpackbits(unpack(bits, np.uint8), count=int(hi - lo))
        begins = np.empty(len(order), dtype=np.int64)
        begins[order] = stop[:-1]
        # windows of all occurrences
        count = group.last - group.first + 1
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        gone = later[np.repeat(begins[group.string], count) + step]
        gone |= np.repeat(group.ids[group.row] > group.owner[group.string], count)
        window = (np.repeat(group.first, count) + step)[gone]
        depth = np.zeros(n_words + 1, dtype=np.int64)
        np.add.at(depth, window, 1)
        np.add.at(depth, window + K, -1)
        out = np.cumsum(depth)[:-1] > 0                                    # removed words
        row = np.repeat(np.arange(rows), np.diff(group.offsets))
        # kept words with one blank between
        size = np.diff(group.at)
        stay = np.repeat(~out, size)
        final = np.full(rows, -1, dtype=np.int64)
        final[row[~out]] = np.flatnonzero(~out)                            # the last write wins: a row's last kept word
        ends = group.at[final[final >= 0] + 1] - 1
        stay[ends] = False
        length = np.bincount(row[~out], weights=size[~out], minlength=rows).astype(np.int64) - (final >= 0)
        text = pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(np.append(0, np.cumsum(length))),
                                                               pa.py_buffer(group.data[stay])])
        edge = np.flatnonzero(out & np.append(True, ~out[:-1] | (row[1:] != row[:-1]))) if n_words else row
        edge_end = np.flatnonzero(out & np.append(~out[1:] | (row[1:] != row[:-1]), True)) + 1 if n_words else row
        owner = row[edge] if n_words else row
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32()),
            pa.StructArray.from_arrays([pa.array(edge - group.offsets[owner], pa.int32()),
                                        pa.array(edge_end - group.offsets[owner], pa.int32())], names=["start", "end"]))
        return pa.table({
            "id": pa.array(group.ids, pa.int64(), mask=group.null), "n_words": pa.array(np.diff(group.offsets), pa.int64()),
            "n_removed": pa.array(np.bincount(row[out], minlength=rows), pa.int64()),
            "kept": text.cast(pa.string()), "removed": spans})
    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_removed, kept (the words that stay, one blank between)
    and removed (word ranges, end exclusive)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = n_bytes // BUCKET_BYTES + 1
    frequent = spark.sparkContext.broadcast(frequent_runs(rows, n_bytes))
    parts = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(n_bytes // GROUP_BYTES + 1)).alias("part"), "id", "text")
    sent = parts.groupBy("part").applyInArrow(_sent(frequent, buckets), "part long, bucket long, strings binary, owners binary")
    later = sent.groupBy("bucket").applyInArrow(_counted, "part long, bucket long, later binary")
    out = parts.groupBy("part").cogroup(later.groupBy("part")).applyInArrow(
        _kept(frequent, buckets),
        "id long, n_words long, n_removed long, kept string, removed array<struct<start:int,end:int>>")
    return out.withColumnRenamed("id", id_col)
