"""Substring dedup against a plain version: windows of 13 words, removed where a smaller id holds them."""

import random
import re

import numpy as np
import pytest

from llm.helpers import documents, sentence, texts
from riskmart.llm import substring_dedup as sd


def plain(rows):
    """(id, n_words, n_removed, kept) per row; a null id is the least."""
    words = [(-(1 << 63) if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (raw, _) in zip(words, rows):
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((raw, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone), sorted(gone)))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept, [k for s in r.removed for k in range(s.start, s.end)])
                   for r in df.collect()], key=str)


def passages(seed=3, n=60):
    """Documents that share passages of 5 to 60 words, with repeats inside one document."""
    rng = random.Random(seed)
    shared = [sentence(rng, rng.randrange(5, 60)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [sentence(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(0, 4)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append((i, (" " if i % 3 else "\n\t ").join(parts)))
    rows += [(n, "spam " * 3000), (n + 1, "spam " * 40), (n + 2, None), (n + 3, ""), (n + 4, " \n"), (n + 4, shared[0]),
             (n + 4, shared[0]), (None, shared[1]), (None, "a " * 20), (-5, shared[1] + " " + shared[2]),
             (-(1 << 63), shared[1]), (n + 5, "漢字 é " * 12 + shared[3].upper()), (n + 6, "漢字 é " * 12)]
    return rows


@pytest.mark.parametrize("frequent, group", [(sd.FREQUENT, sd.GROUP_BYTES), (16, 2000)])
def test_equal_to_plain(spark, monkeypatch, frequent, group):
    monkeypatch.setattr(sd, "FREQUENT", frequent)        # with 16 most runs of the passages are frequent
    monkeypatch.setattr(sd, "GROUP_BYTES", group)
    monkeypatch.setattr(sd, "BUCKET_BYTES", group)
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(sd.without_repeats(df)) == plain(rows)


def test_awkward_documents(spark):
    df = documents(spark)                                # extra columns, nulls, long and odd texts, copies
    rows = [(r.doc_id, r.text) for r in df.collect()]
    out = sd.without_repeats(df)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept", "removed"]
    assert result(out) == plain(rows)
    assert result(sd.without_repeats(documents(spark, empty=True))) == []


def test_frequent_runs_bound(spark, monkeypatch):
    monkeypatch.setattr(sd, "FREQUENT", 64)
    df = spark.createDataFrame([(i, f"alpha beta gamma delta{i}") for i in range(400)], "id long, text string")
    found = sd.frequent_runs(df, 1)
    assert len(found) == 1                               # only "alpha beta gamma" is that frequent


def test_sliding_least():
    values = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    for width in (1, 2, 3, 8, 11):
        plain_least = [values[i:i + width].min() for i in range(50 - width + 1)]
        assert sd._sliding_least(values, width).tolist() == plain_least


def test_copies_over_many_parts(spark, monkeypatch):
    """A text with many copies is one row a group, and only its first copy stays."""
    monkeypatch.setattr(sd, "GROUP_BYTES", 4000)
    text = next(t for t in texts() if t and len(t.split()) > 30)
    df = spark.createDataFrame([(i, text) for i in range(300)], "doc_id long, text string").repartition(7)
    out = {r.doc_id: r.n_removed for r in sd.without_repeats(df).collect()}
    assert out.pop(0) == 0 and set(out.values()) == {len(text.split())}
