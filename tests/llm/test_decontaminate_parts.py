"""Benchmark items with one changed word, and results that do not depend on the shards."""

import random

import numpy as np
from llm.helpers import documents, sentence
from llm.test_large_operators import benchmark_items
from riskmart.llm import decontaminate, textvec


def test_one_changed_word_leaves_the_overlap():
    rng = np.random.default_rng(1)
    for n in range(1, 40):
        k = decontaminate.shingle_words(n, 0.6)
        assert (k == 0) == (n < 3)
        if not k:
            continue
        words = rng.integers(0, 1 << 62, n).astype(np.uint64)
        wanted = decontaminate.grams(words, k)
        for at in range(n):
            changed = words.copy()
            changed[at] = 7
            found = np.isin(wanted, textvec.shingles(changed, np.array([n]), k)[1]).mean()
            assert found >= 0.6


def items_and_values():
    """Items of a long question and an answer of 1 to 9 words; each leaks with one answer word changed."""
    rng = random.Random(6)
    items, values = [], []
    for i in range(45):
        items.append((i, f"{sentence(rng, 22)} {sentence(rng, 1 + i % 9)}"))
        words = items[-1][1].split(" ")
        words[22 + rng.randrange(1 + i % 9)] = "altered"
        values.append(f"{sentence(rng, 50)} {' '.join(words)} {sentence(rng, 40)}")
    values += [f"{sentence(rng, 30)} {sentence(rng, 9)} {sentence(rng, 30)}" for _ in range(60)]       # clean
    values += [" ".join(rng.sample(items[i][1].split(" "), len(items[i][1].split(" ")))) for i in range(20)]   # words only
    return items, values


def test_answers_with_a_changed_word_are_found_in_any_sharding(spark):
    items, values = items_and_values()
    items += [(i, t) for i, t in items[:3]]                     # repeated ids and texts
    items += [(100 + i, t) for i, t in benchmark_items()] + [(None, "short one."), (999, None)]
    docs = documents(spark, values)
    bench = spark.createDataFrame(items, "item_id long, text string")
    results = []
    for shard_bytes in (1 << 20, 4000, 900):
        got = decontaminate.contaminated(docs, bench, shard_bytes=shard_bytes).collect()
        results.append(sorted(tuple(r) for r in got))
        clean = sorted(r.doc_id for r in decontaminate.clean_documents(docs, bench, shard_bytes=shard_bytes).collect())
        assert clean == list(range(45, len(values)))
    assert results[0] == results[1] == results[2]
    assert {(r[0], r[1]) for r in results[0]} == {(i, i) for i in range(45)}
