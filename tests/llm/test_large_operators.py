"""Decontamination, quality, WARC packages and the pipeline."""

import hashlib
import io
import random
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskmart.llm import decontaminate, quality, textvec, warc_zip
from riskmart.llm.kd_shards import kd_shards  # noqa: F401  (imported as the pipeline does)

from .helpers import documents, sentence, texts


# ---------------------------------------------------------------- decontamination

def benchmark_items(n=80, seed=9):
    rng = random.Random(seed)
    return [(i, " ".join(sentence(rng, rng.randrange(6, 14)) for _ in range(rng.randrange(1, 4)))) for i in range(n)]


def test_search_equals_brute_force():
    items = benchmark_items() + [(900, ""), (901, None), (902, "same words here."), (903, "same words here.")]
    index = decontaminate.Index(items)
    rng = random.Random(3)
    for _ in range(60):
        picked = rng.sample(items[:80], 2)
        words = (picked[0][1] + " " + picked[1][1]).split(" ")
        passage = " ".join(w for w in words if rng.random() < 0.8)
        raw = np.frombuffer(passage.encode(), np.uint8)
        _, term = index.lookup(textvec.words(raw, np.array([0, len(raw)]), bare=True)[2])
        terms = np.unique(term)
        score = np.zeros(len(items))
        for t in terms:
            lo, hi = index.offsets[t, 0], index.offsets[t, -1]
            score[index.item[lo:hi]] += index.impact[lo:hi]
        for threshold in (0.2, 0.5, 0.9):
            want = {i for i in np.flatnonzero(score >= threshold - 1e-9)}
            assert {i for i, _ in index.search(terms, threshold)} == want


def test_contaminated_and_clean_documents(spark):
    items = benchmark_items()
    rng = random.Random(4)
    values, leaks = texts(), {}
    for i in range(12):
        item = items[i * 5]
        values.append(" ".join([sentence(rng, 80), item[1].upper() if i % 3 else item[1].replace(" ", "\n"), sentence(rng, 70)]))
        leaks[len(values) - 1] = item[0]
    docs = documents(spark, values).unionByName(documents(spark, values[-1:]).withColumn("doc_id", F.col("doc_id") + 500))
    bench = spark.createDataFrame([*items, (990, None), (991, "")], "item_id long, text string")
    for shard_bytes in (1 << 20, 3000):                     # one index, or several shards
        got = decontaminate.contaminated(docs, bench, shard_bytes=shard_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {*leaks.items(), (500, leaks[len(values) - 1])}
        clean = decontaminate.clean_documents(docs, bench, shard_bytes=shard_bytes)
        assert clean.columns == docs.columns
        assert sorted(r.doc_id for r in clean.collect()) == [i for i in range(len(values)) if i not in leaks]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.clean_documents(documents(spark, empty=True), bench).count() == 0


# ---------------------------------------------------------------- quality

def labelled(spark, n=600):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        text = "\n".join(sentence(rng, 12) for _ in range(4)) if good else " ".join(["SPAM!!", "|", "buy###"] * 20)
        rows.append((i, text))
        labels.append((i, int(good) if i % 50 else None, 0))
    rows += [(n, None), (n + 1, ""), (n + 2, "x" * 200000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "doc_id AS score", "'k' AS x")
    return docs, spark.createDataFrame([*labels, (10 ** 9, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    scored = quality.with_score(docs, model)
    assert scored.columns == ["doc_id", "text", "x", "score"]
    rows = scored.withColumn("held", quality.held_out("doc_id")).collect()
    import zlib
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 603
    held = [r for r in rows if r.held and r.doc_id < 600]
    assert sum((r.score >= 0.3) == (r.doc_id % 4 > 0) for r in held) >= 0.98 * len(held)
    kept = quality.good_documents(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.score >= 0.3}
    # labels only from rows that are not held out
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs, flipped)
    assert all((a == b).all() for a, b in zip(model.tables, again.tables))


def test_quality_without_labels_or_rows(spark):
    docs, labels = labelled(spark, 20)
    model = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.with_score(docs, model).collect()} == {0.5}
    assert quality.with_score(docs.limit(0), model).count() == 0


def test_tables_add_up():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, len(quality.FEATURES)))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.05)).astype(float)      # a pure interaction
    model = quality.fit(x, y, n_bins=16, cycles=10)
    assert ((model.score(x) > 0.5) == y).mean() > 0.85
    assert (0, 1) in {(i, j) for i, j, _ in model.pairs}
    b, total = model.bins(x[:1])[0], model.intercept
    total += sum(t[b[i]] for i, t in enumerate(model.tables)) + sum(t[b[i], b[j]] for i, j, t in model.pairs)
    assert abs(model.score(x[:1])[0] - 1 / (1 + np.exp(-total))) < 1e-12


# ---------------------------------------------------------------- WARC packages

def test_round_trip(spark):
    big, other = "<p>" + "é" * 800, "<p>" + "z" * 999
    rows = [(1, "u1", big), (2, "u\r\n2%", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None),
            (7, "u", other), (7, "u", other), (None, "u", big), (8, "u", "")] + [(100 + i, "h", other + str(i % 9)) for i in range(200)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = warc_zip.round_trip(pages).collect()
    payload = lambda t: (t or "").encode()
    last = {}
    for i, _, t in rows:
        if i is not None and len(payload(t)) >= 1000:
            last[t] = max(last.get(t, -1), i)
    want = [(i, u, len(payload(t)), hashlib.sha1(payload(t)).hexdigest(),
             *(("revisit", last[t]) if t in last and i != last[t] else ("response", None))) for i, u, t in rows]
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.target_uri, r.payload_bytes, r.payload_digest, r.record_type,
                                                 r.refers_to)) for r in got)
    assert warc_zip.round_trip(pages.limit(0)).count() == 0


def reader(data: bytes) -> warc_zip.PackageReader:
    return warc_zip.PackageReader(lambda offset, n: data[offset:offset + n], len(data))


def package(**how) -> bytes:
    writer = warc_zip.PackageWriter()
    for i in range(50):
        body = f"page {i} ".encode() * 30
        writer.add(i, f"http://h/{i}", body, hashlib.sha1(body).hexdigest(), None)
    sink = io.BytesIO()
    writer.write(sink)
    return sink.getvalue()


def test_zip64_and_comments(monkeypatch):
    data = package()
    assert [r["page_id"] for r in reader(data).records()] == list(range(50))
    with zipfile.ZipFile(io.BytesIO(data)) as z:            # a plain ZIP reader agrees
        assert z.testzip() is None and set(z.namelist()) == {warc_zip.WARC_MEMBER, warc_zip.INDEX_MEMBER}
        parts = {n: z.read(n) for n in z.namelist()}
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)        # sizes and offsets beyond the limit
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as z:
        z.writestr("deflated.txt", b"x" * 500, zipfile.ZIP_DEFLATED)
        for name, value in parts.items():
            z.writestr(name, value)
        z.comment = b"PK\x05\x06 in a comment"
    wide = sink.getvalue()
    assert b"PK\x06\x06" in wide and b"PK\x06\x07" in wide
    found = reader(wide)
    assert set(found.members) == set(parts)                 # stored members only
    assert [r["page_id"] for r in found.records()] == list(range(50))


def test_reader_reads_ranges_only(monkeypatch):
    data, seen = package(), []
    monkeypatch.setattr(warc_zip, "READ_BYTES", 300)

    def read(offset, n):
        seen.append(n)
        return data[offset:offset + n]
    records = list(warc_zip.PackageReader(read, len(data)).records())
    assert len(records) == 50 and len(seen) > 20 and sum(seen[-10:]) < len(data) / 2


# ---------------------------------------------------------------- pipeline

def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline
    from .test_ngram_join import plain_components
    docs, labels = labelled(spark, 120)
    items = benchmark_items(20)
    rng = random.Random(8)
    full = documents(spark, [r.text for r in docs.orderBy("doc_id").collect()] +
                     ["\n".join([sentence(rng, 30), items[3][1], sentence(rng, 30)])]).select("doc_id", "text", "lang", "source", "n_chars")
    base = str(tmp_path)
    full.write.parquet(f"{base}/documents.parquet")
    labels.write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{base}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, base)
        out.write.parquet(f"{base}/{k}")
        now = spark.read.parquet(f"{base}/{k}")
        kept.append([r.doc_id for r in now.collect()])
        if k < 4:
            assert now.columns == full.columns
    text = {r.doc_id: r.text for r in full.collect()}
    assert not any("SPAM" in (text[i] or "") for i in kept[0])
    comps = plain_components([(i, text[i]) for i in kept[0]], 5, 80, 100)
    assert sorted(kept[1]) == sorted(i for i, (_, c) in comps.items() if c == i)
    assert set(kept[1]) - set(kept[2]) == {123} and set(kept[3]) == set(kept[2])
    assert sorted(kept[4]) == sorted(kept[3])
    final = sorted((r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, base).collect())
    assert final == sorted((r.doc_id, r.shard, r.slot) for r in now.collect())


def test_empty_documents_through_features():
    x = quality.features(pa.array([None, "", " ", "a"], pa.string()))
    assert x.shape == (4, len(quality.FEATURES)) and np.isfinite(x).all() and (x[0] == x[1]).all()
