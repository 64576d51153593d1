"""Shards and groups of equal texts."""

import random
from collections import defaultdict

from llm.helpers import documents
from riskmart.llm.kd_shards import kd_shards


def test_equal_texts_share_a_shard_unless_the_group_is_too_large(spark):
    rng = random.Random(5)
    values = [f"text {i} " + "x" * rng.randrange(400) for i in range(600)]
    for size in (2, 3, 7, 20):                                  # copies far apart in id, source and lang
        for g in range(12):
            values += [f"group {size} {g} " + "y" * 60] * size
    values += ["hot " + "z" * 100] * 700                        # more than a shard
    values += [None, "", "", None]
    rng.shuffle(values)
    rows = kd_shards(documents(spark, values), n_shards=8).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(values)))
    where, total = defaultdict(set), defaultdict(int)
    for r in rows:
        where[values[r.doc_id] or ""].add(r.shard)
        total[r.shard] += r.size
    hot = next(t for t in where if t.startswith("hot"))
    assert len(where[hot]) > 1 and all(len(s) == 1 for t, s in where.items() if t != hot)
    assert len(total) == 8 and max(total.values()) - min(total.values()) <= 20 * 80   # the largest whole group
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_one_text_fills_all_shards(spark):
    rows = kd_shards(documents(spark, ["the same text"] * 400), n_shards=4).collect()
    count = [sum(r.shard == s for r in rows) for s in range(4)]
    assert sum(count) == 400 and max(count) - min(count) <= 2
