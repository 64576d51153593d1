"""Line dedup: an exact set-similarity join of lines; later matches are removed.

A line's set holds its distinct words (A-Z as a-z). All words have one order: by
the number of occurrences in the corpus (a fixed-size array of cell counts over
all texts), then by hash, so a prefix holds the rarest words. Lines are matched
when overlap / union >= num / den. Candidates share a prefix word (prefix
filter), their sizes allow the threshold (length filter), and the places of the
shared words allow the overlap (positional filter). The prefix that a pair needs
follows from both sizes; it is taken one word longer where the lines' own prefixes
reach that far, and two words in common are asked for then. A row also has one bit
of 64 for every word of its line: a bit that the other line lacks is a word that it
lacks, which bounds the overlap from above. Every candidate is verified on its
whole set. If more than ``crowd`` pairs a set pass for one word, as among near
copies, its sets are a crowd, compared block against block without emitting pairs.

Prefix words travel packed, one binary value for each task and range of words; a
range's task sorts them and emits pairs. Words that occur more than ``FREQUENT``
times in the corpus are stored apart and their prefix rows counted: mostly few lines
have no rarer words, and those rows are dealt by word as well. The sets of a word of
more than ``FREQUENT`` rows form a crowd at once, by rows.

Stored tables and shuffle files of the search are removed before the texts are read
for the result, which may shuffle them.

A line is removed when an earlier line matches it, itself removed or not: the
order is document id, text hash, line number. Equal sets are one node from the
start, known by the place of its first line, so a line that fills a third of the
corpus is one row per task.

Defined results: null or empty texts have one empty line; lines without words are
never removed; equal rows (id and text) are one document and get equal results;
null ids come first in the order; an empty table gives an empty result; extra
columns stay in ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, shuffles_removed
from . import textvec
from .blocks import gathered, linked, placed, similar_enough
from .ngram_join import set_hash
from .sketch import cell, hash_counts, hash_flags

BITS = 21
FILTER_BITS = 22
HELD_BITS = 18                           # cells of frequent words: their prefix rows are few
CROWD = 16
FREQUENT = 1 << 15                       # bounds a word's rows in a range
RANGE_BYTES = 8 << 20                    # text of the corpus for each range of words
SENT_BYTES = 32 << 20                    # removed lines (24 bytes each) that may be broadcast
_PAIRS = 1 << 17                         # pairs of rows looked at together
_REBUILT = 1 << 10                       # texts rebuilt together
_PACKED = 1 << 18                        # prefix words that a task holds before it emits them
_U = np.uint64
_WORD = np.dtype([("range", "u4"), ("key", "u4"), ("h", "u8"), ("bits", "u8"), ("n", "u4"), ("pos", "u4")])
_COLUMNS = ("key", "h", "bits", "n", "pos")                # packed one after the other
_ROW = sum(_WORD[c].itemsize for c in _COLUMNS)


def line_sets(column: pa.Array, cells: np.ndarray):
    """(first row, text, line, row, word) per slice: words of a line distinct, rarest first."""
    bits = len(cells).bit_length() - 1
    for lo, _, raw, offsets in textvec.buffers(column):
        starts, _, hashes = textvec.words(raw, offsets)
        begin, text, number = textvec.lines(raw, offsets)
        counts = np.diff(np.append(np.searchsorted(starts, begin), len(starts)))
        rows = np.repeat(np.arange(len(begin)), counts)
        rank = (np.minimum(cells[cell(hashes, bits)].astype(np.uint64), 0xFFFFFF) << _U(40)) | (hashes >> _U(24))
        order = textvec.by_row(rows, rank)
        r, v, k = rows[order], hashes[order], rank[order]
        tie = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
        if (tie & (v[1:] != v[:-1])).any():              # two words of one rank: let the whole hash decide
            order = np.lexsort((hashes, rank, rows))
            r, v = rows[order], hashes[order]
        new = np.ones(len(r), dtype=bool)
        new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
        yield lo, text, number, r[new], v[new]


def _occurrences(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for _, _, raw, offsets in textvec.buffers(batch.column(0)):
        yield textvec.words(raw, offsets)[2]


def _sets_of(rows: np.ndarray, values: np.ndarray, lines: int):
    """Sizes of all lines, the lines with words, the end of each one's words, and its set hash."""
    n = np.bincount(rows, minlength=lines)
    some = np.flatnonzero(n)
    end = np.cumsum(n[some])
    return n, some, end, (set_hash(values, end - n[some]) if len(some) else np.zeros(0, np.uint64))


def _columns(words: bytes) -> list[np.ndarray]:
    """The columns of packed prefix words, as in ``_COLUMNS``."""
    k, at, out = len(words) // _ROW, 0, []
    for c in _COLUMNS:
        out.append(np.frombuffer(words, dtype=_WORD[c], count=k, offset=at))
        at += k * _WORD[c].itemsize
    return out


_LINE_ROW = "id long, text_hash long, line int, n int, h long, range int, words binary"


def _lines_and_prefixes(num: int, den: int, counts, ranges: int):
    """In one pass over the texts: a row for each line with words, and rows (range, words) of packed prefix words.

    Ranges from ``ranges`` on hold frequent words, spread by set.
    """
    least = -(-num // (den - num))       # a smaller set matches only an equal one
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
    names = ["id", "text_hash", "line", "n", "h", "range", "words"]

    def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts) if parts else np.zeros(0, _WORD)
        # 16-bit numbers sort in linear time
        order = np.argsort(rows["range"].astype(np.uint16 if 2 * ranges <= 1 << 16 else np.uint32), kind="stable")
        to, columns = rows["range"][order], [rows[c][order] for c in _COLUMNS]
        begin = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
        pieces = list(zip(begin, np.append(begin[1:], len(to))))
        packed = [pa.array(to[begin].astype(np.int32)),
                  pa.array([b"".join(c[i:j].tobytes() for c in columns) for i, j in pieces], pa.binary())]
        return pa.RecordBatch.from_arrays([*[pa.nulls(len(pieces), t) for t in types[:5]], *packed], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = counts.value
        bits = len(cells).bit_length() - 1
        parts, held, seen = [], 0, set()
        for batch in batches:
            for lo, text, number, rows, values in line_sets(batch.column(2), cells):
                n, some, end, h = _sets_of(rows, values, len(text))
                ids = pa.array(lo + text[some])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(ids), batch.column(1).take(ids), pa.array(number[some].astype(np.int32)),
                     pa.array(n[some].astype(np.int32)), pa.array(h.view(np.int64)),
                     *[pa.nulls(len(some), t) for t in types[5:]]], names=names)
                size = np.where(n[some] >= least, n[some] - -(-num * n[some] // den) + 1, 0)
                # an equal line of the same task needs no second prefix
                once = np.zeros(len(some), dtype=bool)
                once[np.unique(h, return_index=True)[1]] = True
                known = np.fromiter((x in seen for x in h.tolist()), bool, len(h))
                size[~once | known] = 0
                seen.update(h[size > 0].tolist())
                if len(seen) > _PACKED:
                    seen.clear()
                place = np.arange(len(rows)) - np.repeat(end - n[some], n[some])
                keep = place < np.repeat(size, n[some])
                out = np.zeros(int(keep.sum()), dtype=_WORD)
                token = values[keep]
                out["h"] = np.repeat(h, n[some])[keep]
                flag = _U(1) << (textvec.mix(values ^ _U(0x8EBC6AF09C88C6E3)) >> _U(58))
                either = np.bitwise_or.reduceat(flag, end - n[some]) if len(some) else flag
                out["bits"] = np.repeat(either, n[some])[keep]
                out["n"] = np.repeat(n[some], n[some])[keep]
                out["pos"] = place[keep]
                out["key"] = token & np.uint64(0xFFFFFFFF)
                often = cells[cell(token, bits)] > FREQUENT
                out["range"] = textvec.mix(np.where(often, out["h"], token)) % np.uint64(ranges) + often * ranges
                parts.append(out)
                held += len(out)
                if held > _PACKED:
                    yield emit(parts)
                    parts, held = [], 0
        yield emit(parts)
    return run


def _keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for words in batch.column(0).to_pylist():
        yield textvec.mix(_columns(words)[0].astype(np.uint64))


def _dealt(held, ranges: int):
    """Packed frequent words that ``FREQUENT`` prefixes at most hold (``held``: rows by cell) go to ``ranges`` ranges below 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = held.value
        bits = len(cells).bit_length() - 1
        for batch in batches:
            to, packed = [], []
            for own, words in zip(*(c.to_pylist() for c in batch.columns)):
                columns = _columns(words)
                word = textvec.mix(columns[0].astype(np.uint64))
                at = np.where(cells[cell(word, bits)] > FREQUENT, own, -1 - (word % _U(ranges)).astype(np.int64))
                order = np.argsort(at, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                    to.append(int(at[rows[0]]))
                    packed.append(b"".join(c[rows].tobytes() for c in columns))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(packed, pa.binary())], names=["range", "words"])
    return run


def _pairs_of_range(num: int, den: int, crowd: int, ranges: int):
    """For applyInArrow over a range: (kind, a, b, least) - pairs and the common words they need, or crowds."""
    def run(table: pa.Table) -> pa.Table:
        key, h, bits, n, pos = (np.concatenate(c) for c in zip(*map(_columns, table["words"].to_pylist())))
        order = np.argsort(h)
        order = order[np.argsort(((key.astype(np.uint64) << _U(32)) | n)[order], kind="stable")]
        key, h, bits, n, pos = (x[order] for x in (key, h, bits, n, pos))
        new = np.append(True, (key[1:] != key[:-1]) | (h[1:] != h[:-1]))       # equal sets of other tasks
        # half as wide where the sizes allow it: the filters go over many more pairs than rows
        kind = np.int32 if int(n.max(initial=0)) * 2 * max(num, den) < 1 << 31 else np.int64
        row = _Rows(h[new].view(np.int64), bits[new], n[new].astype(kind), pos[new].astype(kind), num, den)
        key = key[new]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(first, len(key)))
        pairs, members = [], []

        def take(passed: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
            """Keep the pairs of whole lists; a list of more than ``crowd`` pairs a row is a crowd."""
            of = np.searchsorted(first, passed[0], side="right") - 1
            listed, many = np.unique(of, return_counts=True)
            crowded = np.isin(of, listed[many > crowd * count[listed]])
            members.append(np.unique(np.concatenate([p[crowded] for p in passed[:2]])))
            pairs.append(tuple(p[~crowded] for p in passed))

        if table["range"][0].as_py() >= ranges:          # frequent words
            members = [np.arange(len(key))]
        else:
            spread = row.within_length(np.repeat(np.arange(len(first)), count))
            found = np.add.reduceat(spread, first) if len(first) else first
            # lists of few pairs together, the others by themselves
            few = found <= _PAIRS
            for some in np.split(np.flatnonzero(few), np.flatnonzero(np.diff((np.cumsum(found[few]) - 1) // _PAIRS)) + 1):
                at = np.concatenate([np.arange(first[k], first[k] + count[k]) for k in some[found[some] > 0]] or [some[:0]])
                take(row.possible(*_ahead(at, spread[at])))
            for k in np.flatnonzero(~few):
                take(row.possible_in_list(int(first[k]), spread[first[k]:first[k] + count[k]]))
        x, y, least = (np.concatenate(p) for p in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        often = np.concatenate(members) if members else np.zeros(0, np.int64)
        a, b = np.minimum(row.h[x], row.h[y]), np.maximum(row.h[x], row.h[y])
        return pa.table({
            "kind": pa.array(np.repeat([0, 1], [len(x), len(often)]), pa.int32()),
            "a": pa.array(np.append(a, key[often].astype(np.int64)), pa.int64()),
            "b": pa.array(np.append(b, row.h[often]), pa.int64()),
            "least": pa.array(np.append(least, np.zeros(len(often), np.int64)), pa.int32())})
    return run


class _Rows:
    """Prefix rows of a range, sorted by word, then set size; the filters on pairs of them."""

    def __init__(self, h, bits, n, pos, num: int, den: int):
        self.h, self.bits, self.n, self.pos, self.num, self.den = h, bits, n, pos, num, den

    def possible(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of pairs of rows with one word and fitting lengths, those that pass the filters, and the common words they need."""
        num, den, n, pos, bits = self.num, self.den, self.n, self.pos, self.bits
        n_x, n_y, i, j = n[x], n[y], pos[x], pos[y]
        need = -(-num * (n_x + n_y) // (num + den))
        ok = (i + need <= n_x + 1) & (j + need <= n_y + 1)
        ok &= np.minimum(i, j) + 1 + np.minimum(n_x - i - 1, n_y - j - 1) >= need
        x, y, need = x[ok], y[ok], need[ok]
        ok = n[x] - np.bitwise_count(bits[x] & ~bits[y]) >= need
        ok &= n[y] - np.bitwise_count(bits[y] & ~bits[x]) >= need
        x, y, need = x[ok], y[ok], need[ok]
        n_x, n_y = n[x], n[y]
        # the longer prefix holds only where a line's own prefix reaches it
        longer = (need > -(-num * n_x // den)) & (need > -(-num * n_y // den)) & (need > 1)
        return x, y, 1 + longer.astype(np.int64)

    def within_length(self, of: np.ndarray) -> np.ndarray:
        """For each row the rows after it in its list (``of``: the list's number) that the length filter allows."""
        size = (of << 40) + self.n
        return np.searchsorted(size, (of << 40) + self.n.astype(np.int64) * self.den // self.num, side="right") - np.arange(len(of)) - 1

    def possible_in_list(self, at: int, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``possible`` for all pairs of one long list that the length filter allows, by slices."""
        part = np.cumsum(spread) // _PAIRS
        slices = np.split(np.arange(len(spread)), np.flatnonzero(np.diff(part)) + 1)
        x, y, least = zip(*[self.possible(*_ahead(at + rows, spread[rows])) for rows in slices])
        return np.concatenate(x), np.concatenate(y), np.concatenate(least)


def _ahead(rows: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row with each of the ``spread`` rows after it."""
    end = np.cumsum(spread)
    x = np.repeat(rows, spread)
    return x, x + 1 + np.arange(len(x)) - np.repeat(end - spread, spread)


def _fetch(counts, texts, sets):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_bits, set_bits = len(texts.value).bit_length() - 1, len(sets.value).bit_length() - 1
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            kept = np.flatnonzero(texts.value[cell(textvec.mix(key), text_bits)])
            column, hashes = batch.column(1).take(pa.array(kept)), key[kept]
            for lo, text, _, rows, values in line_sets(column, counts.value):
                n, some, end, h = _sets_of(rows, values, len(text))
                wanted = sets.value[cell(textvec.mix(h + textvec.mix(hashes[lo + text[some]])), set_bits)]
                wanted[np.setdiff1d(np.arange(len(some)), np.unique(h, return_index=True)[1])] = False
                if not wanted.any():
                    continue
                size = np.where(wanted, n[some], 0)
                tokens = values[np.repeat(wanted, n[some])]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size[wanted])), pa.int32()),
                                                 pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(h[wanted].view(np.int64)), lists], names=["h", "tokens"])
    return run


def _hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield textvec.mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))


def _places(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    h, text = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
    yield textvec.mix(h + textvec.mix(text))


def _earliest(num: int, den: int):
    """For applyInArrow over (x, y): the first place among a set's matches of the block pair."""
    def run(table: pa.Table) -> pa.Table:
        h, link = linked(table, num, den)
        ids = table["id"].combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        place = np.lexsort((table["line"].to_numpy(), table["text_hash"].to_numpy(), ids.fill_null(0).to_numpy(), known))
        rank = np.empty(len(h), dtype=np.int64)
        rank[place] = np.arange(len(h))
        best = np.where(link, rank[None, :], len(h)).min(axis=1, initial=len(h))
        some = np.flatnonzero(best < rank)
        at = pa.array(place[best[some]])
        return pa.table({"h": pa.array(h[some], pa.int64()), "id": table["id"].take(at),
                         "text_hash": table["text_hash"].take(at), "line": table["line"].take(at)})
    return run


def _candidates(words: DataFrame, num: int, den: int, crowd: int, ranges: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of set hashes to verify, and crowds (token, h)."""
    often = words.where(F.col("range") >= ranges)
    held = hash_counts(often.select("words"), _keys, HELD_BITS)
    few = int(held[held <= FREQUENT].sum(dtype=np.int64))
    held = words.sparkSession.sparkContext.broadcast(held)
    often = often.mapInArrow(_dealt(held, few // _PACKED + 1), "range int, words binary")
    rows = (words.where(F.col("range") < ranges).unionByName(often).groupBy("range")
            .applyInArrow(_pairs_of_range(num, den, crowd, ranges), "kind int, a long, b long, least int"))
    # common words of a pair add up over the ranges; a crowd's member counts by itself
    found = scratch.store(rows.groupBy("kind", "a", "b").agg(F.count("*").alias("common"), F.max("least").alias("least"))
                          .where("common >= least").select("kind", "a", "b"), "found")
    held.destroy()
    crowds = found.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("h"))
    shared = crowds.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1").select("token")
    return found.where("kind = 0").select("a", "b"), crowds.join(shared, "token")


def later_matches(docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text: str = "text",
                  crowd: int = CROWD, bits: int = BITS, scratch: Scratch | None = None) -> DataFrame:
    """The lines to remove: id, text_hash, line (from 0), one row each (a stored table)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "lines", until_exit=True)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"),
                         F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text"))
    with Scratch(spark, "lines-work") as work, shuffles_removed(spark):
        return _later_matches(narrow, num, den, crowd, bits, work, scratch)


def _later_matches(narrow: DataFrame, num: int, den: int, crowd: int, bits: int, work: Scratch, out: Scratch) -> DataFrame:
    """``later_matches`` of (id, text_hash, text); only the result is stored in ``out``."""
    broadcast = narrow.sparkSession.sparkContext.broadcast
    counts = broadcast(hash_counts(narrow.select("text"), _occurrences, bits))       # 2**bits cells
    ranges = int((narrow.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // RANGE_BYTES) + 1
    stored = work.store(narrow.mapInArrow(_lines_and_prefixes(num, den, counts, ranges), _LINE_ROW), "lines")
    lines = stored.where("range is null").select("id", "text_hash", "line", "n", "h")
    pairs, crowds = _candidates(stored.where("range is not null").select("range", "words"), num, den, crowd, ranges, work)
    hub = crowds.groupBy("token").agg(F.min("h").alias("b"))
    hints = pairs.unionByName(crowds.join(hub, "token").where("h <> b").select(F.col("h").alias("a"), "b").distinct())
    place = F.struct("id", "text_hash", "line")
    first = work.store(lines.groupBy("h").agg(F.min(place).alias("first"), F.max("n").cast("long").alias("n")), "first")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("h")).unionByName(crowds.select("h")).distinct()
    nodes = work.store(nodes.join(first, "h").select("h", "n", "first.*"), "nodes")
    blocks = work.store(placed(nodes.select("h", "n"), hints), "blocks")
    texts = broadcast(hash_flags(nodes.select("text_hash"), _hashes, FILTER_BITS))
    wanted = broadcast(hash_flags(nodes.select("h", "text_hash"), _places, FILTER_BITS))
    tokens = narrow.select("text_hash", "text").mapInArrow(_fetch(counts, texts, wanted), "h long, tokens array<long>")
    # every copy of a first place's text sends its lines: one row for each set, or a block pair would hold all of them
    tokens = work.store(tokens.groupBy("h").agg(F.any_value("tokens").alias("tokens")), "tokens")
    sets = nodes.select("h", "id", "text_hash", "line").join(tokens, "h")
    earlier = (gathered(pairs, crowds, blocks).join(sets, "h").groupBy("x", "y")
               .applyInArrow(_earliest(num, den), "h long, id long, text_hash long, line int"))
    earlier = earlier.groupBy("h").agg(F.min(place).alias("match")).withColumnRenamed("h", "_h")
    least = (first.join(earlier, F.col("h") == F.col("_h"), "left")
             .select(F.col("h").alias("_h"), F.coalesce(F.least("first", "match"), "first").alias("least")))
    removed = (lines.select("id", "text_hash", "line", "h").join(least, F.col("h") == F.col("_h"))
               .where(place > F.col("least")).select("id", "text_hash", "line").distinct())
    removed = out.store(removed, "removed")
    for shared in (counts, texts, wanted):
        shared.destroy()
    return removed


def _rebuild(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(lo, _REBUILT) for whole in batches for lo in range(0, whole.num_rows, _REBUILT)):
            column, gone = batch.column(text_at), batch.column(batch.num_columns - 1).to_pylist()
            n_lines = pc.add(pc.fill_null(pc.count_substring(column, "\n"), 0), 1).cast(pa.int32())
            cut = np.array([bool(out) for out in gone], dtype=bool)
            texts = []
            for value, out in zip(column.filter(pa.array(cut)).to_pylist(), [out for out in gone if out]):
                drop = set(out)
                texts.append("\n".join(p for i, p in enumerate((value or "").split("\n")) if i not in drop))
            columns = batch.columns[:-1]
            if texts:
                columns[text_at] = pc.replace_with_mask(column, pa.array(cut), pa.array(texts, column.type))
            yield pa.RecordBatch.from_arrays(
                [*columns, n_lines, pa.array([sorted(x or []) for x in gone], pa.list_(pa.int32()))],
                names=[*batch.schema.names[:-1], "n_lines", "removed_lines"])
    return run


def deduplicated(docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text: str = "text",
                 scratch: Scratch | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the text's later matches removed, then n_lines and removed_lines.

    These two replace columns of their names.
    """
    docs = docs.drop("n_lines", "removed_lines")
    removed = later_matches(docs, num, den, id_col, text, scratch=scratch)
    gone = (removed.groupBy("id", "text_hash").agg(F.collect_set("line").alias("_gone"))     # one document's lines
            .withColumnsRenamed({"id": "_id", "text_hash": "_hash"}))
    # removed lines are few numbers for each document: sent to the texts while they are counted as small,
    # else both sides are shuffled
    if removed.count() * 24 <= SENT_BYTES:
        gone = F.broadcast(gone)
    keyed = docs.withColumn("_text_hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    rows = (keyed.join(gone, keyed[id_col].cast("long").eqNullSafe(gone["_id"]) & (keyed["_text_hash"] == gone["_hash"]),
                       "left").select(*[keyed[c] for c in docs.columns], "_gone"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(_rebuild(docs.columns.index(text)), f"{fields}, n_lines int, removed_lines array<int>")
