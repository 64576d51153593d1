"""Phrase collocations by SETM: sorted occurrence relations, merge-joined to longer and longer phrases.

A relation holds the occurrences of the frequent phrases of one length: (place, phrase),
sorted by place, for each slice of texts. Places count words, with a gap between pieces,
so two occurrences are adjacent in one piece exactly when their places differ by one.
Each length goes through the same steps:

1. merge-join a slice's relation with itself on adjacent places: pairs of phrases that
   overlap in all but one word,
2. group-count: a slice sends each of its distinct pairs once, with its count, packed by
   key range; a range's task adds them up. A pair that fills a third of the corpus is
   one key per slice,
3. semi-join: the frequent pairs' numbers go back to the slices that sent them, and only
   their occurrences make the next relation, a stored table.

Words are compared as bytes and phrases as pairs of numbers, so counts are exact. Numbers
are below 2**32 (an error is raised beyond); an occurrence of a frequent phrase holds
frequent phrases only, so nothing is lost.

Every part is per language; a null language is ``und``. Null and empty texts have no
words; an empty table gives an empty result; repeated rows count as often as they occur;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from . import textvec
from .packing import LOWER, binary, byte_class, hashes_of, numbered, numbered_pairs, pack, parts, runs, spaced, unpack

LEAST = 30
LONGEST = 4
SLICE_BYTES = 8 << 20                    # text of a slice
RANGE_BYTES = 4 << 20                    # text of the corpus for each range of keys
_ENDS = byte_class(*b".,;:!?", range(0x0A, 0x0E))        # bytes that end a piece
_WORD = ~(_ENDS | byte_class(0x20, 0x09))
_U = np.uint64
_SENT = "slice long, seq int, range int, lang string, words binary, counts binary, n long, places binary, numbers binary"
_COUNTED = ("kind int, slice long, seq int, numbers binary, id long, lang string, word string, x long, y long, f long")


def _relation_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Place, word number and text of every word, and the distinct words (a blank behind each)."""
    for _, _, raw, offsets in textvec.buffers(texts, 1 << 40):
        raw = LOWER[raw]
        starts, ends = runs(raw, offsets, _WORD)
        data, at = spaced(raw, starts, ends, _WORD)
        text = np.searchsorted(offsets, starts, side="right") - 1
        piece = np.cumsum(_ENDS[raw], dtype=np.int32)[starts] if len(starts) else starts
        new = np.zeros(len(starts), dtype=bool)
        new[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
        number, words = numbered(binary(data, at))
        return np.arange(len(starts)) + np.cumsum(new), number, words, text
    return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_binary()), np.zeros(0, np.int64)


def _slice_rows(langs: list, texts: pa.Array, ranges: int) -> pa.RecordBatch:
    """The slice's relation (a row without a range), and its distinct words by language and range."""
    name = int.from_bytes(np.random.default_rng().bytes(8), "little") >> 1     # a name; the stored table fixes it
    place, number, words, text = _relation_of(texts)
    lang_of, lang_names = numbered(pa.array(langs, pa.string()))
    lang = lang_of[text]
    pair = numbered_pairs(lang, number)                       # one word of one language
    _, first, count = np.unique(pair, return_index=True, return_counts=True)
    key_lang, key_word = lang[first], number[first]
    key_range = (hashes_of(words) % _U(ranges)).astype(np.int64)[key_word] if len(words) else key_word
    order = np.lexsort((key_range, key_lang))                 # the slice's word numbers follow this order
    renamed = np.empty(len(order), dtype=np.int64)
    renamed[order] = np.arange(len(order))
    new = np.append(True, (np.diff(key_lang[order]) != 0) | (np.diff(key_range[order]) != 0)) if len(order) else order
    begin = np.append(np.flatnonzero(new), len(order))
    rows = [(name, -1, -1, None, None, pack(begin.astype(np.uint32)), 0, pack(np.diff(place, prepend=0).astype(np.uint32)),
             pack(renamed[pair].astype(np.uint32)))]
    for seq, (i, j) in enumerate(zip(begin[:-1], begin[1:])):
        some = order[i:j]
        raw, _ = parts(words.take(pa.array(key_word[some])))
        rows.append((name, seq, int(key_range[some[0]]), lang_names[int(key_lang[some[0]])].as_py(), pack(raw),
                     pack(count[some].astype(np.uint32)), int(count[some].sum()), None, None))
    types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["slice", "seq", "range", "lang", "words", "counts", "n", "places", "numbers"])


def _slices(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, texts, size = [], [], 0
        for batch in batches:
            for lo, hi, raw, _ in textvec.buffers(batch.column(1), SLICE_BYTES):
                if langs and size + len(raw) > SLICE_BYTES:
                    yield _slice_rows(langs, pa.concat_arrays(texts), ranges)
                    langs, texts, size = [], [], 0
                langs += batch.column(0).slice(lo, hi - lo).to_pylist()
                texts.append(batch.column(1).slice(lo, hi - lo).cast(pa.large_string()))
                size += len(raw)
        if langs:
            yield _slice_rows(langs, pa.concat_arrays(texts), ranges)
    return run


def _totals(key: np.ndarray, counts: np.ndarray, least: int, ranges: int, range_: int) -> tuple[np.ndarray, ...]:
    """Of numbered keys: the first place, total and name of each frequent one, and every key's name (0: not frequent)."""
    total = np.bincount(key, weights=counts).astype(np.int64)              # exact below 2**53
    first = np.zeros(len(total), dtype=np.int64)
    first[key[::-1]] = np.arange(len(key))[::-1]
    often = np.flatnonzero(total >= least)
    name = np.zeros(len(total), dtype=np.int64)
    name[often] = np.arange(len(often)) * ranges + range_ + 1              # no other range gives this name
    if len(often) and name[often[-1]] >= 1 << 32:
        raise ValueError("more than 2**32 names of frequent phrases of one length: raise the least count")
    return first[often], total[often], name[often], name[key]


def _counted_table(table: pa.Table, sizes: np.ndarray, names: np.ndarray, found: dict[str, pa.Array]) -> pa.Table:
    """Answers to the slices (kind 0) and the frequent phrases (kind 1)."""
    stop = np.cumsum(sizes)
    answers = [names[j - n:j] for n, j in zip(sizes, stop)]
    some = [i for i, a in enumerate(answers) if a.any()]
    n, m = len(some), len(found["id"])
    at = pa.array(some, pa.int64())

    def column(name: str, kind: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.nulls(n, kind), found[name].cast(kind) if name in found else pa.nulls(m, kind)])
    return pa.table({
        "kind": pa.array(np.repeat([0, 1], [n, m]), pa.int32()),
        "slice": pa.concat_arrays([table["slice"].combine_chunks().take(at), pa.nulls(m, pa.int64())]),
        "seq": pa.concat_arrays([table["seq"].combine_chunks().take(at), pa.nulls(m, pa.int32())]),
        "numbers": pa.concat_arrays([pa.array([pack(answers[i].astype(np.uint32)) for i in some], pa.binary()), pa.nulls(m, pa.binary())]),
        "id": column("id", pa.int64()), "lang": column("lang", pa.string()), "word": column("word", pa.string()),
        "x": column("x", pa.int64()), "y": column("y", pa.int64()), "f": column("f", pa.int64())})


def _count_words(least: int, ranges: int):
    def run(table: pa.Table) -> pa.Table:
        raw = [unpack(w, np.uint8) for w in table["words"].to_pylist()]
        counts = [unpack(c, np.uint32) for c in table["counts"].to_pylist()]
        sizes = np.array([len(c) for c in counts])
        data = np.concatenate(raw)
        at = np.append(0, np.flatnonzero(data == 0x20) + 1)
        word = numbered(binary(data, at))[0]
        lang, names = numbered(table["lang"].combine_chunks())
        key = numbered_pairs(np.repeat(lang, sizes), word)
        first, total, name, every = _totals(key, np.concatenate(counts), least, ranges, table["range"][0].as_py())
        texts = [data[at[i]:at[i + 1] - 1].tobytes().decode() for i in first.tolist()]
        return _counted_table(table, sizes, every, {
            "id": pa.array(name), "f": pa.array(total), "word": pa.array(texts, pa.string()),
            "lang": names.take(pa.array(np.repeat(lang, sizes)[first]))})
    return run


def _count_pairs(least: int, ranges: int):
    def run(table: pa.Table) -> pa.Table:
        keys = [unpack(w, _U) for w in table["words"].to_pylist()]
        counts = [unpack(c, np.uint32) for c in table["counts"].to_pylist()]
        every = np.concatenate(keys)
        first, total, name, names = _totals(numbered(pa.array(every))[0], np.concatenate(counts), least, ranges,
                                            table["range"][0].as_py())
        return _counted_table(table, np.array([len(k) for k in keys]), names, {
            "id": pa.array(name), "f": pa.array(total), "x": pa.array((every[first] >> _U(32)).astype(np.int64)),
            "y": pa.array((every[first] & _U(0xFFFFFFFF)).astype(np.int64))})
    return run


def _joined(places: bytes, numbers: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The merge-join of a relation with itself: first places of adjacent phrases, and the pairs' keys."""
    place, number = np.cumsum(unpack(places, np.uint32).astype(np.int64)), unpack(numbers, np.uint32).astype(_U)
    at = np.flatnonzero(place[1:] == place[:-1] + 1)          # sorted by place: a partner is the next row or none
    return place[at], (number[at] << _U(32)) | number[at + 1]


def _by_range(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, ...]:
    """Distinct keys by range, their counts, each key's place there, the ranges and where they begin."""
    distinct, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    range_ = (textvec.mix(distinct) % _U(ranges)).astype(np.int64)
    order = np.argsort(range_, kind="stable")
    renamed = np.empty(len(order), dtype=np.int64)
    renamed[order] = np.arange(len(order))
    range_ = range_[order]
    begin = np.flatnonzero(np.append(True, range_[1:] != range_[:-1])) if len(order) else order
    return distinct[order], count[order], renamed[inverse], range_[begin], np.append(begin, len(order))


def _send_pairs(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, places, numbers in zip(*(c.to_pylist() for c in batch.columns)):
                distinct, count, _, range_, begin = _by_range(_joined(places, numbers)[1], ranges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(range_), pa.int64()), pa.array(range(len(range_)), pa.int32()), pa.array(range_, pa.int32()),
                     pa.array([pack(distinct[i:j]) for i, j in zip(begin[:-1], begin[1:])], pa.binary()),
                     pa.array([pack(count[i:j].astype(np.uint32)) for i, j in zip(begin[:-1], begin[1:])], pa.binary())],
                    names=["slice", "seq", "range", "words", "counts"])
    return run


def _extended(answers: pa.Table, begin: np.ndarray) -> np.ndarray:
    """The names that came back for the slice's keys, 0 where a range had nothing frequent."""
    out = np.zeros(int(begin[-1]), dtype=np.int64)
    for seq, numbers in zip(answers["seq"].to_pylist(), answers["numbers"].to_pylist()):
        out[begin[seq]:begin[seq + 1]] = unpack(numbers, np.uint32)
    return out


def _next_relation(name: int, place: np.ndarray, number: np.ndarray) -> pa.Table:
    stay = number > 0
    return pa.table({"slice": pa.array([name], pa.int64()),
                     "places": pa.array([pack(np.diff(place[stay], prepend=0).astype(np.uint32))], pa.binary()),
                     "numbers": pa.array([pack(number[stay].astype(np.uint32))], pa.binary())})


def _semi_join_words(relation: pa.Table, answers: pa.Table) -> pa.Table:
    row = relation.to_pylist()[0]
    names = _extended(answers, unpack(row["counts"], np.uint32).astype(np.int64))
    place = np.cumsum(unpack(row["places"], np.uint32).astype(np.int64))
    return _next_relation(row["slice"], place, names[unpack(row["numbers"], np.uint32)])


def _semi_join_pairs(ranges: int):
    def run(relation: pa.Table, answers: pa.Table) -> pa.Table:
        row = relation.to_pylist()[0]
        place, keys = _joined(row["places"], row["numbers"])
        _, _, renamed, _, begin = _by_range(keys, ranges)
        return _next_relation(row["slice"], place, _extended(answers, begin)[renamed])
    return run


def _mined(docs: DataFrame, lang: str, text: str, least: int, longest: int,
           work: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """Word totals (lang, n), and the frequent phrases of each length: (id, lang, word, f), then (id, x, y, f)."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ranges = (rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // RANGE_BYTES + 1
    stored = work.store(rows.mapInArrow(_slices(ranges), _SENT), "words")
    totals = stored.groupBy("lang").agg(F.sum("n").alias("n")).where("lang is not null")
    relation = stored.where("seq < 0").select("slice", "counts", "places", "numbers")
    sent = stored.where("seq >= 0").select("slice", "seq", "range", "lang", "words", "counts")
    found = []
    for length in range(1, longest + 1):
        count = (_count_words if length == 1 else _count_pairs)(least, ranges)
        counted = work.store(sent.groupBy("range").applyInArrow(count, _COUNTED), f"counted-{length}")
        found.append(counted.where("kind = 1").select("id", *(["lang", "word"] if length == 1 else ["x", "y"]), "f"))
        if length == longest:
            break
        answers = counted.where("kind = 0").select("slice", "seq", "numbers")
        join = _semi_join_words if length == 1 else _semi_join_pairs(ranges)
        relation = work.store(relation.groupBy("slice").cogroup(answers.groupBy("slice"))
                              .applyInArrow(join, "slice long, places binary, numbers binary"), f"relation-{length}")
        sent = relation.mapInArrow(_send_pairs(ranges), "slice long, seq int, range int, words binary, counts binary")
    return totals, found


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(2000000 * a / (l + r)) in 38 digits."""
    wide = "decimal(38,0)"
    whole = a.cast("decimal(20,0)") * F.lit(2000000).cast("decimal(10,0)")
    return F.call_function("div", whole.cast(wide), (l + r).cast(wide)).cast("long")


def _cut(a: Column, k: int, l: Column, r: Column) -> Column:
    return F.struct(_score(a, l, r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))


def phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
            inside: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """All kept phrases of 2 to ``longest`` (at most 4) words: lang, phrase, words, a, l, r, n, score (a stored table).

    A phrase whose words lie inside a longer one that has at least ``inside`` per cent of its count is left out.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases of 2 to 4 words")
    spark = docs.sparkSession
    out = scratch or Scratch(spark, "phrases", until_exit=True)
    with Scratch(spark, "phrase-relations") as work:
        totals, found = _mined(docs, lang, text, least, longest, work)
        level = found[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
                                F.col("f").alias("head"), F.col("f").alias("tail"),
                                *[F.lit(0).cast("long").alias(c) for c in ("pre", "suf", "x", "y")])
        candidates, within = [], []
        for length in range(2, longest + 1):
            left = level.select(*[F.col(c).alias("x" if c == "id" else f"x_{c}") for c in level.columns])
            right = level.select(*[F.col(c).alias("y" if c == "id" else f"y_{c}") for c in level.columns])
            both = found[length - 1].join(left, "x").join(right, "y")
            a = F.col("f")
            cuts = [(F.col("x_head"), F.col("y_f")), (F.col("x_f"), F.col("y_tail"))]
            if length == 2:
                cuts = [(F.col("x_f"), F.col("y_f"))]
            elif length == 4:
                cuts.insert(1, (F.col("x_pre"), F.col("y_suf")))
            best = F.array_min(F.array(*[_cut(a, k + 1, l, r) for k, (l, r) in enumerate(cuts)]))
            both = work.store(both.withColumn("best", best), f"phrases-{length}")
            level = both.select("id", F.col("x_lang").alias("lang"), F.concat_ws(" ", "x_phrase", "y_last").alias("phrase"),
                                F.col("y_last").alias("last"), "f", F.col("x_head").alias("head"), F.col("y_tail").alias("tail"),
                                F.col("x_f").alias("pre"), F.col("y_f").alias("suf"), "x", "y")
            candidates.append(level.select(F.lit(length).alias("words"), "id", "lang", "phrase", F.col("f").alias("a"))
                              .join(both.select("id", "best.l", "best.r", "best.score"), "id"))
            shorter = [(length - 1, "x"), (length - 1, "y")] + [(2, c) for c in ("x_x", "x_y", "y_y") if length == 4]
            if length > 2:
                within.append(both.select(F.explode(F.array(*[F.struct(F.lit(w).alias("words"), F.col(c).alias("id"))
                                                              for w, c in shorter])).alias("s"), "f").select("s.*", "f"))
        every = candidates[0]
        for c in candidates[1:]:
            every = every.unionByName(c)
        if within:
            held = within[0]
            for w in within[1:]:
                held = held.unionByName(w)
            held = held.groupBy("words", "id").agg(F.max("f").alias("most"))
            every = (every.join(held, ["words", "id"], "left")
                     .where(F.col("most").isNull() | (F.col("most") < F.ceil(F.col("a") * F.lit(inside).cast("decimal(3,0)") / 100))))
        kept = every.join(totals, "lang").select("lang", "phrase", "words", "a", "l", "r", "n", "score")
        return out.store(kept, "phrases")


def top_phrases(found: DataFrame, top: int = 2000) -> DataFrame:
    """Each language's first ``top`` phrases by score, then count (descending), then phrase, with their rank.

    The limit on the rank is applied in every task before rows meet, so a task takes ``top`` rows of
    a language from each other task at most.
    """
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
