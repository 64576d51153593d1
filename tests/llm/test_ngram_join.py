import random

import pytest

from riskmart.llm.blocks import forest, overlaps
from riskmart.llm.ngram_join import matches_needed, near_duplicates, one_of_each

from .helpers import documents, shingle_set, texts, words_of


def plain_components(rows, k, num, den):
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(n, seed=3, size=60, edits=4):
    """One base text and n copies with different small edits: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(1, edits)):
            copy[rng.randrange(size)] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k,num,den,crowd", [(4, 85, 100, 64), (5, 80, 100, 4)])
def test_matches_brute_force(spark, k, num, den, crowd):
    values = texts() + near_copies(60) + near_copies(9, seed=5)
    docs = documents(spark, values)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_duplicates(docs, k, num, den, crowd=crowd, bits=12).collect()}
    assert got == plain_components(list(enumerate(values)), k, num, den)


def test_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(120)]
    values = [" ".join(words[i:i + 100]) for i in range(0, 20, 2)]       # neighbours alike, ends not
    got = near_duplicates(documents(spark, values), bits=10).collect()
    assert {r.component_id for r in got} == {0}


def plain_links(values, k, num, den):
    sets = [shingle_set(t, k) for t in values]
    linked = lambda a, b: (both := len(a & b)) and den * both >= num * (len(a) + len(b) - both)
    return {i: sum(bool(linked(a, b)) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}


@pytest.mark.parametrize("block,crowd", [(1 << 17, 64), (1 << 11, 4), (1 << 11, 64)])
def test_links_are_counted_once(spark, monkeypatch, block, crowd):
    from riskmart.llm import blocks
    monkeypatch.setattr(blocks, "BLOCK", block)            # small blocks: many block pairs for one group
    copies = near_copies(40)
    values = texts() + copies + copies[:3] * 2
    got = {r.doc_id: r.n_links for r in near_duplicates(documents(spark, values), 5, 80, 100, crowd=crowd, bits=12).collect()}
    want = plain_links(values, 5, 80, 100)
    assert got == want and max(want.values()) > 10


def test_a_chain_is_not_a_clique(spark):
    words = [f"w{i}" for i in range(120)]
    values = [" ".join(words[i:i + 100]) for i in (0, 6, 12)]
    got = near_duplicates(documents(spark, values), bits=10).collect()
    assert {r.doc_id: (r.component_id, r.n_links) for r in got} == {0: (0, 1), 1: (0, 2), 2: (0, 1)}


def test_empty_table_and_nulls(spark):
    assert near_duplicates(documents(spark, empty=True), bits=8).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (None, "z"), (7, "a b c d e"), (8, None)],
                                 "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(rows, bits=8).collect()),
                 key=str)
    assert got == sorted([(True, None, 2, 7), (False, 7, 2, 7), (True, None, 1, None), (False, 7, 2, 7), (False, 8, 0, 8)],
                         key=str)


def test_links_between_documents_without_ids(spark):
    a = near_copies(1)[0]
    rows = spark.createDataFrame([(None, a), (None, a + " more"), (5, a + " more tail")], "doc_id long, text string")
    got = near_duplicates(rows, bits=10).collect()
    assert {r.component_id for r in got} == {5}


def test_one_of_each_keeps_whole_rows(spark):
    values = texts() + near_copies(10)
    docs = documents(spark, values).unionByName(documents(spark, values[:3]))       # repeated rows
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    comps = plain_components(list(enumerate(values)), 5, 80, 100)
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == sorted({i for i, (_, c) in comps.items() if c == i})
    assert all(r.text == values[r.doc_id] and r.n == r.doc_id for r in rows)


def test_overlaps_of_rare_and_common_tokens():
    import numpy as np
    rng = np.random.default_rng(0)
    sets = [set(rng.choice(400, 60, replace=False).tolist()) | {1000, 1001} for _ in range(70)]
    doc = np.array([i for i, s in enumerate(sets) for _ in s])
    token = np.array([t for s in sets for t in s])
    got = overlaps(doc, token, len(sets))
    for a in range(70):
        for b in range(70):
            if a != b:
                assert got[a, b] == len(sets[a] & sets[b])


def test_forest_spans_components():
    import numpy as np
    link = np.zeros((5, 5), bool)
    for a, b in ((0, 1), (1, 2), (3, 4)):
        link[a, b] = link[b, a] = True
    a, b = forest(link, np.array([50, 40, 30, 20, 10]))
    assert dict(zip(a.tolist(), b.tolist())) == {50: 30, 40: 30, 20: 10}


def test_costly_prefixes_ask_for_more_matches():
    import numpy as np
    cheap, costly = np.zeros(100), np.zeros(100)
    costly[:16] = 5000.0
    assert matches_needed(cheap, 100, 85, 100) == 1
    assert matches_needed(costly, 100, 85, 100) > 1
    assert matches_needed(np.array([9.0]), 1, 85, 100) == 1


def test_words_of_helper():
    assert words_of("A\x0bb\x1cC") == ["a", "b\x1cc"]
