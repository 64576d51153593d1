import numpy as np
import pyarrow as pa

from riskmart.llm import textvec

from .helpers import shingle_set, texts, words_of


def hashed(values, **how):
    out = []
    for _, _, raw, offsets in textvec.buffers(pa.array(values, pa.string()), limit=300):
        starts, ends, h = textvec.words(raw, offsets, **how)
        n = textvec.word_counts(starts, offsets)
        at = np.append(0, np.cumsum(n))
        out += [(h[a:b].tolist(), [raw[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])])
                for a, b in zip(at[:-1], at[1:])]
    return out


def test_words_and_hashes_match_plain_python():
    values = texts()
    fold = {c: c + 32 for c in range(65, 91)}
    name = {}
    for value, (h, found) in zip(values, hashed(values)):
        assert [w.translate(fold) for w in found] == words_of(value)
        for word, x in zip(words_of(value), h):
            assert name.setdefault(x, word) == word       # equal hash, equal word
    assert len(set(name.values())) == len(name)


def test_shingles_match_plain_python():
    values = texts()
    for k in (1, 4, 5):
        sets = []
        for _, _, raw, offsets in textvec.buffers(pa.array(values, pa.string()), limit=500):
            starts, _, h = textvec.words(raw, offsets)
            n = textvec.word_counts(starts, offsets)
            rows, v = textvec.distinct(*textvec.shingles(h, n, k))
            sets += [frozenset(v[rows == i].tolist()) for i in range(len(n))]
        plain = [shingle_set(t, k) for t in values]
        assert [len(s) for s in sets] == [len(s) for s in plain]
        for a in range(0, len(values), 3):
            for b in range(len(values)):
                assert len(sets[a] & sets[b]) == len(plain[a] & plain[b])


def test_a_long_word_spans_hash_chunks(monkeypatch):
    monkeypatch.setattr(textvec, "_CHUNK", 64)
    textvec._POW.clear()
    long = "ab" * 500
    (a, _), (b, _) = hashed([f"x {long} y", f"z {long}"])
    textvec._POW.clear()
    assert a[1] == b[1]
    assert hashed([f"q {long}"])[0][0][1] == a[1]


def test_lines():
    values = ["a\nb\n", "", None, "c", "\n", "d\n\ne"]
    (_, _, raw, offsets), = textvec.buffers(pa.array(values, pa.string()))
    _, text, number = textvec.lines(raw, offsets)
    want = [(i, j) for i, t in enumerate(values) for j, _ in enumerate((t or "").split("\n"))]
    assert list(zip(text.tolist(), number.tolist())) == want


def test_sliced_column_and_nulls():
    column = pa.array(["skip", None, "One two", "", "three"], pa.string()).slice(1, 3)
    got = [(lo, hi, bytes(raw), offsets.tolist()) for lo, hi, raw, offsets in textvec.buffers(column)]
    assert got == [(0, 3, b"One two", [0, 0, 7, 7])]
