"""Source divergence audit against a plain version, and the perfect hash it counts with."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm.helpers import documents
from riskmart.llm import divergence as dv
from riskmart.llm import perfect_hash
from riskmart.llm.packing import hashes_of

FOLD = {c: c + 32 for c in range(65, 91)}
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=10, top=10):
    """(lang, source, part, item, value, rank); rows are (lang, source, text)."""
    held, counts = Counter(), defaultdict(Counter)
    for lang, source, text in rows:
        words = [w.decode() for w in TERM.findall((text or "").translate(FOLD).encode())]
        held.update((lang or "", w) for w in set(words))
        counts[lang or "", source or ""].update(words)
    out = []
    for lang in {g for g, _ in counts}:
        kept = [w for (g, w), n in held.items() if g == lang and n >= least]
        groups = {s: c for (g, s), c in counts.items() if g == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def share(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 1000000000 * (c[w] + 2) // (n + 2 * len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s, c in groups.items():
            pairs = sorted((-sum(f(p[s][w], p[t][w]) for w in kept), t.encode()) for t in groups if t != s)
            terms = sorted((-f(p[s][w], q[w]), w.encode()) for w in kept if c[w] and p[s][w] > q[w])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def corpus(seed=2, n=200):
    rng = random.Random(seed)
    words = ["river", "Stone", "x1y", "naïve", "漢字", "a_b", "don't", "lamp"] + [f"word{chr(97 + i)}" for i in range(20)]
    rows = [(rng.choice(["en", "de", None, "a b", "ü"]), rng.choice(["s1", "s2", None, "blog post"]),
             " ".join(rng.choice(words[:rng.randrange(2, 28)]) for _ in range(rng.randrange(0, 30)))) for _ in range(n)]
    return rows + [("en", "empty", None), ("en", "empty", ""), ("zz", "only", "nothing is kept"), ("zz", "other", "here"),
                   ("en", "s1", "river " * 5000)]


@pytest.mark.parametrize("wave, held, size", [(1 << 20, 1 << 20, 1 << 20), (200, 300, 400)])
def test_equal_to_plain(spark, monkeypatch, wave, held, size):
    """Also with many shards, several waves, and slots sent off after almost every group."""
    for name, value in (("WAVE_BYTES", wave), ("HELD_BYTES", held), ("SLICE_BYTES", size), ("SHARD_BYTES", size), ("BLOCK", size // 100)):
        monkeypatch.setattr(dv, name, value)
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    expected = plain(rows, least=5)
    assert len(expected) > 100
    assert result(dv.audit(df, least=5)) == expected


def test_awkward_documents(spark):
    df = documents(spark)
    rows = [(r.lang, r.source, r.text) for r in df.collect()]
    assert result(dv.audit(df, least=3)) == plain(rows, least=3)
    assert result(dv.audit(df, least=10**6)) == plain(rows, least=10**6)       # no term is kept: all pairs at 0
    assert result(dv.audit(documents(spark, empty=True))) == []


def test_shares_are_exact():
    counts = np.array([2, 10**15, 8 * 10**15, 12345678901234], dtype=np.int64)
    total = 9 * 10**15
    assert dv.shares(counts, np.int64(total)).tolist() == [1 + 10**9 * int(c) // total for c in counts]


def test_perfect_hash_slots():
    words = [f"key{i} ".encode() for i in range(5000)]
    values = pa.array(words, pa.large_binary())
    table = perfect_hash.build(values, hashes_of(values))
    assert sorted(table.slots(values, hashes_of(values)).tolist()) == list(range(5000))
    other = pa.array([f"other{i} ".encode() for i in range(5000)], pa.large_binary())
    assert set(table.slots(other, hashes_of(other)).tolist()) == {-1}
    # a string with a key's hash is told apart by the stored string
    assert set(table.slots(other, hashes_of(values)).tolist()) == {-1}
    none = perfect_hash.build(values[:0], hashes_of(values[:0]))
    assert none.size == 0 and none.slots(values[:3], hashes_of(values[:3])).tolist() == [-1] * 3


def test_perfect_hash_of_equal_hashes():
    values = pa.array([b"a ", b"b ", b"c "], pa.large_binary())
    hashes = np.array([7, 7, 9], dtype=np.uint64)
    table = perfect_hash.build(values, hashes)
    assert sorted(table.slots(values, hashes).tolist()) == [0, 1, 2]
    assert table.slots(pa.array([b"x "], pa.large_binary()), hashes[:1]).tolist() == [-1]
