"""Token counts, sharding, mixing, fingerprints, personal data: against plain Python on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import merkle, mixing, pii
from riskmart.llm.kd_shards import kd_shards
from riskmart.llm.queries import op6
from riskmart.llm.token_counts import token_counts
from riskmart.session import Scratch

from .helpers import documents, texts


# ---------------------------------------------------------------- token counts

def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer
    path = tokenizer_path()
    library = Tokenizer.from_file(path)
    values = texts() + ["a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "It's we'll O'Brien's 1234 $%&!!", "H̱ ẖ Å",
                        "nb sp em\u0085nel", "́ leading mark", "ΣΑΣ"]
    docs = documents(spark, values)
    for size in (0, 5, 1 << 10):
        got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(docs, path, ["doc_id"], table_size=max(size, 1)).collect()}
        assert got == {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                       for i, t in enumerate(values)}
    assert token_counts(documents(spark, empty=True), path, ["doc_id"]).count() == 0


# ---------------------------------------------------------------- sharding

def test_shards_hold_all_rows_and_near_equal_bytes(spark):
    values = texts(n=150) + [texts()[3]] * 120               # a large group of copies
    docs = documents(spark, values).unionByName(documents(spark, values[:5]))
    rows = kd_shards(docs, n_shards=8).collect()
    assert sorted(r.doc_id for r in rows) == sorted([*range(len(values)), *range(5)])
    size = lambda t: len((t or "").encode()) + 1
    assert all(r.size == size(values[r.doc_id]) and r.text_crc32 == zlib.crc32((values[r.doc_id] or "").encode()) for r in rows)
    by = {s: [r for r in rows if r.shard == s] for s in range(8)}
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())
    total = [sum(r.size for r in part) for part in by.values()]
    assert max(total) - min(total) <= 2 * max(r.size for r in rows)


def test_shards_by_target_bytes_any_count_and_empty(spark):
    docs = documents(spark, [f"text number {i} " * 5 for i in range(90)])
    rows = kd_shards(docs, target_bytes=1500).collect()
    total = {}
    for r in rows:
        total[r.shard] = total.get(r.shard, 0) + r.size
    assert set(total) == set(range(len(total))) and max(total.values()) <= 1500 + 100
    assert {r.shard for r in kd_shards(docs, n_shards=3).collect()} == {0, 1, 2}
    assert kd_shards(documents(spark, empty=True), n_shards=8).count() == 0


# ---------------------------------------------------------------- mixing

def test_pfair_windows_and_deviation():
    for weights in ([1, 1], [5, 3, 1], [0.5, 0.25, 0.125, 0.125], [1] * 37, [1000, 1]):
        parts = mixing.exact_parts(weights)
        whole, served = sum(parts), [0] * len(parts)
        stream = mixing.pfair(parts, 0, served)
        for slot in range(1, 2100):
            next(stream)
            assert all(abs(k * whole - slot * q) < whole for k, q in zip(served, parts))
            if slot == whole:
                assert served == parts


def test_states_equal_those_of_stepping_through():
    draw = random.Random(5)
    cases = [[1, 1], [1], [1, 1, 2], [1e6, 3, 3, 2, 1], [1] * 37]
    cases += [[draw.choice([draw.random(), draw.random() ** 8 + 1e-6, draw.randint(1, 9)])
               for _ in range(draw.randint(1, 30))] for _ in range(40)]
    for weights in cases:
        parts, period, slots = mixing.exact_parts(weights), draw.choice([7, 16, 64]), 3000
        least = mixing.LeastSlack(parts, period, np.array(
            [mixing.slack(parts, k * period, (k + 1) * period).min() for k in range(slots // period + 1)]))
        served = [0] * len(parts)
        stream = mixing.pfair(parts, 0, served)
        for slot in range(slots):
            if slot % period == 0:
                assert mixing.served_before(parts, slot, least) == served
            next(stream)


def plain_stream(parts, blocks, mode):
    """(source, block, epoch, slot) by stepping through the whole stream."""
    served, rows, unfinished = [0] * len(parts), [], len(parts)
    for slot, source in enumerate(mixing.pfair(parts, 0, served)):
        epoch, block = divmod(served[source] - 1, blocks[source])
        if mode == "supply" and epoch:
            return rows
        rows.append((source, block, epoch, slot))
        unfinished -= served[source] == blocks[source]
        if mode == "cover" and not unfinished:
            return rows


def test_schedule_in_frames_equals_the_plain_one(spark, tmp_dir):
    for weights, blocks in (([3.0, 1.0, 0.01], [700, 100, 2]), ([1.0], [130]), ([1 / 3, 0.2, 0.05, 0.4167], [1, 90, 7, 300])):
        parts = mixing.exact_parts(weights)
        for mode in ("cover", "supply"):
            got = mixing.schedule(spark, parts, blocks, 64, mode, Scratch(spark, "test-mix"))
            rows = sorted(((r._number, r._block, r.epoch, r.slot) for r in got.collect()), key=lambda r: r[3])
            assert rows == plain_stream(parts, blocks, mode)


def test_null_ids_and_texts_are_mixed(spark):
    docs = spark.createDataFrame([(None, "a", "x"), (None, None, "x"), (None, "b", None), (4, "", None), (4, "c", None)],
                                 "doc_id long, text string, source string")
    units = {(r.source, r.doc_id, r.bytes) for r in mixing.mix_sources(docs).collect()}
    assert units == {("x", None, 2), (None, None, 1), (None, 4, 2)}
    assert len({tuple(r) for r in mixing.mixed_documents(docs).collect()}) == 5


def plain_schedule(spark, docs, **how):
    rows = mixing.mix_sources(docs, **how).collect()
    return sorted((r.slot, r.offset, r.doc_id, r.source, r.epoch, r.block) for r in rows)


def test_cover_keeps_every_document_and_follows_weights(spark):
    values = ["x" * 100 for _ in range(120)]
    docs = spark.createDataFrame([(i, t, "big" if i < 90 else None) for i, t in enumerate(values)],
                                 "doc_id long, text string, source string")
    got = plain_schedule(spark, docs, weights={"big": 1.0, None: 1.0}, block_bytes=500, period=64)
    assert {d for _, _, d, *_ in got} == set(range(120))
    blocks = {(slot, source) for slot, _, _, source, _, _ in got}
    assert len({slot for slot, _ in blocks}) == len(blocks)              # one source a slot
    last = max(slot for slot, _ in blocks) + 1
    for upto in range(1, last + 1):
        for source in ("big", None):
            assert abs(sum(s < upto and x == source for s, x in blocks) - upto / 2) < 1
    assert max(e for *_, e, _ in got) >= 1                      # the small source repeats
    less = plain_schedule(spark, docs, weights={"big": 1.0, None: 1.0}, block_bytes=500, period=64, mode="supply")
    assert all(e == 0 for *_, e, _ in less) and len(less) < len(got)


def test_mixed_documents_are_whole_rows(spark):
    docs = documents(spark).unionByName(documents(spark, texts()[:4]))
    plan = mixing.mix_sources(docs).collect()
    out = mixing.mixed_documents(docs).collect()
    copies = {i: 2 if i < 4 else 1 for i in range(len(texts()))}
    assert len(out) == sum(copies[r.doc_id] for r in plan) and {r.doc_id for r in out} == set(copies)
    assert all(r.text == texts()[r.doc_id] and r.n == r.doc_id for r in out)
    assert mixing.mix_sources(documents(spark, empty=True)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, weights={"src0": 1.0})


def test_weights_hold_over_several_periods(spark):
    shares = {"hot": 1 / 3} | {f"s{i}": 2 / 3 / 19 * (0.5 + i / 18) for i in range(19)}
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 19).cast("string"))).alias("source"))
    how = {"weights": shares, "block_bytes": 10, "period": 128}
    order = [(slot, source) for slot, _, _, source, _, _ in plain_schedule(spark, docs, **how)]
    assert [slot for slot, _ in order] == list(range(len(order))) and len(order) > 20 * 128
    total, have = sum(shares.values()), dict.fromkeys(shares, 0)
    for slot, source in order:
        have[source] += 1
        assert all(abs(have[s] - (slot + 1) * w / total) < 1 for s, w in shares.items())
    assert plain_schedule(spark, docs, **(how | {"period": 1000})) == plain_schedule(spark, docs, **how)


def test_scarce_sources_are_repeated_by_their_weight_only(spark):
    docs = spark.range(20_001).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"),
                                      F.when(F.col("id") == 0, "scarce").otherwise("hot").alias("source"))
    got = plain_schedule(spark, docs, block_bytes=10)
    due = len(got) / (1 + 20_000 ** 0.9)                   # about 2.7; one slot of 4,096 would be 5
    assert abs(sum(source == "scarce" for _, _, _, source, _, _ in got) - due) < 1
    tiny = docs.withColumn("text", F.when(F.col("doc_id") == 0, "x").otherwise(F.col("text")))
    assert len(plain_schedule(spark, tiny, block_bytes=10)) == len(got)
    for weight in (0.0, -1.0, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing.mix_sources(docs, weights={"hot": 1.0, "scarce": weight})


def test_stored_documents_follow_the_stream(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"),
                                    (F.col("id") % 7).cast("string").alias("source"))
    how = {"weights": {str(i): 1.0 + i for i in range(7)}, "block_bytes": 500}
    mixing.mixed_documents(docs, **how).write.parquet(f"{tmp_dir}/mixed")
    files = sorted(glob.glob(f"{tmp_dir}/mixed/part-*.parquet"))
    stored = [i for f in files for i in pq.read_table(f)["doc_id"].to_pylist()]
    assert stored == [doc for _, _, doc, *_ in plain_schedule(spark, docs, **how)]


# ---------------------------------------------------------------- fingerprints

def test_fingerprints_and_edited_texts(spark):
    values = texts()
    docs = documents(spark, values).unionByName(
        spark.createDataFrame([(None, "no id")], "doc_id long, text string"), allowMissingColumns=True)
    rows = merkle.fingerprints(docs).select(
        "doc_id", "text", "n_chars", "edited", "a_root", "e_root", merkle.likeness("a_", "e_").alias("near"),
        merkle.likeness("a_", "n_").alias("next"), merkle.first_difference("a_", "e_", "paragraphs").alias("at")).collect()
    order = [t or "" for t in reversed(values)] + ["no id"]
    edited = [t[:len(t) - len(t) // 2] + order[(i + 1) % len(order)][:len(t) // 2] for i, t in enumerate(order)]
    want = sorted((len(t), t, e) for t, e in zip(order, edited))
    assert sorted((r.n_chars, r.text, r.edited) for r in rows) == want
    root = {}
    for r in rows:
        assert root.setdefault(r.text, r.a_root) == r.a_root and (r.a_root == r.e_root) == (r.text == r.edited)
        assert 0 <= r.near <= 1 and 0 <= r.next <= 1 and (r.near == 1) >= (r.text == r.edited)
        if r.text == r.edited:
            assert r.at == -1
        else:
            lines, other = r.text.split("\n"), r.edited.split("\n")
            first = next(i for i in range(max(len(lines), len(other))) if lines[i:i + 1] != other[i:i + 1]
                         or (i + 1 < len(lines)) != (i + 1 < len(other)))
            assert r.at == first
    assert len(set(root.values())) == len(root)


def test_next_rows_cross_buckets_gaps_and_repeats(spark):
    from riskmart.llm.neighbours import with_next
    ids = [0, 1, 2, 5, 5, 9, 1000, 1001, 10 ** 12, -7, 10 ** 12 + 1, *range(2000, 2100)]
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = {r.text: r.next for r in with_next(docs, "doc_id", "text", "next", bucket_rows=3).collect()}
    order = [t for _, t in sorted(((-i, f"t{k}") for k, i in enumerate(ids)))]
    assert got == {t: order[(n + 1) % len(order)] for n, t in enumerate(order)}
    assert with_next(docs.limit(0), "doc_id", "text", "next").count() == 0
    one = with_next(docs.limit(1), "doc_id", "text", "next").collect()
    assert one[0].next == one[0].text


# ---------------------------------------------------------------- personal data

SEEDS = ["mail a.b@x.example.com now", "ip 10.0.0.255 10.0.0.256 1.2.3.4.5", "card 4111 1111 1111 1111 and 4111111111111112",
         "phone +1 (376) 555-1700 or +12", "a@b @c d@e.f g@h.i.j", "é漢 x@y.zz 😀 8.8.8.8", "4111-1111-1111-1111 4.4.4.4"]


def plain_base(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for k, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")) \
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15:
                out.append((m.start(), k, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


def test_personal_data_spans(spark, tmp_path):
    keyed = [f"word{i} of token=ab{i}cd{i * 7}ef99 the" for i in range(12)] + [f"sent of a{10 + i}@mail.example.com the" for i in range(12)]
    values = texts() + SEEDS + keyed + ["9" * 20000, "+" + "1" * 5000, "a" * 3000 + "@"]
    docs = documents(spark, values).unionByName(documents(spark, values[:60]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op6(spark, str(tmp_path)).collect()
    assert len(rows) == len(values) + 60
    for r in rows:
        base = plain_base(values[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("id:")] == [s for s in base.split(",") if s]
        assert r.n_email == base.count("email:") and r.n_ip == base.count("ip:")
    # "of _ the" is learnt from the mail addresses, and finds the tokens behind "token="
    added = {r.doc_id: r.spans for r in rows if "id:" in r.spans}
    for i, t in enumerate(values):
        m = re.search(r"token=(\w+)", t or "")
        assert (i in added) == bool(m)
        if m:
            assert added[i] == f"id:{m.start(1)}:{m.end(1)}"


def test_personal_data_without_rows_or_seeds(spark):
    assert pii.personal_data(documents(spark, empty=True)).count() == 0
    rows = pii.personal_data(documents(spark, ["code ab12cd34ef", None])).select(pii.joined(F.col("spans")).alias("s")).collect()
    assert [r.s for r in rows] == ["", ""]
