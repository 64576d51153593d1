"""Phrase mining against a plain version over all contiguous word runs."""

import random
import re
from collections import Counter

import pytest

from llm.helpers import documents
from riskmart.llm import phrases as ph
from riskmart.session import Scratch

FOLD = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, longest=4, inside=80):
    """(lang, phrase, a, l, r, n, score) of every kept phrase; rows are (lang, text)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] += 1
    often = {key: f for key, f in counts.items() if f >= least}
    out = []
    for (lang, w), a in often.items():
        if len(w) == 1:
            continue
        score, _, l, r = min((2000000 * a // (often[lang, w[:k]] + often[lang, w[k:]]), k, often[lang, w[:k]], often[lang, w[k:]])
                             for k in range(1, len(w)))
        held = any(lang2 == lang and len(v) > len(w) and 100 * f >= inside * a
                   and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1)) for (lang2, v), f in often.items())
        if not held:
            out.append((lang, " ".join(w), a, l, r, totals[lang], score))
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def corpus(seed=5, n=120):
    rng = random.Random(seed)
    words = "The river Runs past old stone bridges é漢 and x1".split()
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(1, 40)):
            text += rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ", ", ". ", "\n", " - "])
        rows.append((rng.choice(["en", "de", None, "a b"]), text))
    rows += [("en", None), ("en", ""), (None, "..,;"), ("und", "the river runs " * 20), ("en", "go go go go go go. " * 30)]
    return rows


@pytest.mark.parametrize("slice_bytes, range_bytes", [(1 << 20, 1 << 20), (500, 300)])
def test_equal_to_plain(spark, monkeypatch, slice_bytes, range_bytes):
    monkeypatch.setattr(ph, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(ph, "RANGE_BYTES", range_bytes)
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    expected = plain(rows, 5)
    assert len(expected) > 50
    assert result(ph.phrases(df, least=5)) == expected


def test_awkward_documents(spark):
    df = documents(spark)
    rows = [(r.lang, r.text) for r in df.collect()]
    assert result(ph.phrases(df, least=3)) == plain(rows, 3)
    assert result(ph.phrases(documents(spark, empty=True), least=3)) == []
    assert result(ph.phrases(df, least=3, longest=2)) == plain(rows, 3, longest=2)


def test_top_by_rank(spark):
    df = spark.createDataFrame([("en", p, a, s) for p, a, s in [("b c", 5, 9), ("a c", 5, 9), ("é b", 7, 9), ("z z", 1, 10), ("q", 9, 1)]],
                               "lang string, phrase string, a long, score long")
    top = [(r["rank"], r.phrase) for r in ph.top_phrases(df, 4).orderBy("rank").collect()]
    assert top == [(1, "z z"), (2, "é b"), (3, "a c"), (4, "b c")]


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    row = spark.createDataFrame([(9 * 10**17, 10**18, 9 * 10**17)], "a long, l long, r long")
    got = row.select(ph._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).head().s
    assert got == 2000000 * 9 * 10**17 // (10**18 + 9 * 10**17)


def test_relations_are_released(spark, tmp_path):
    before = Scratch(spark, "x").root.rsplit("/", 1)[0]
    df = spark.createDataFrame([("en", "a b a b")], "lang string, text string")
    ph.phrases(df, least=2)
    import os
    assert not [f for f in os.listdir(before) if f.startswith("phrase-relations")]
