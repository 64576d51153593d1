"""Frequent words in few prefixes make pairs, not crowds; the search leaves only its result on disk."""

import os
import time

import pytest

from riskmart.llm import line_dedup
from riskmart.llm.line_dedup import later_matches
from riskmart.session import shared_root

from .helpers import documents, texts
from .test_line_dedup import plain

COMMON = [f"c{i}" for i in range(24)]


def _values():
    """Lines whose prefixes are rare words give the common words their counts; few lines have common words only."""
    long = [" ".join(COMMON + [f"r{k}x{i}" for i in range(40)]) for k in range(40)]
    short = [" ".join(COMMON[:9] + [COMMON[9 + k]]) for k in (0, 0, 1, 5, 6, 9)]
    return ["\n".join(long[k::8] + short[k % 6:k % 6 + 1]) for k in range(8)] + short


@pytest.mark.parametrize("frequent, crowded", [(30, False), (2, True)])
def test_frequent_words_of_few_prefixes_are_no_crowds(spark, monkeypatch, frequent, crowded):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    seen, whole = [], line_dedup.gathered
    monkeypatch.setattr(line_dedup, "gathered", lambda pairs, crowds, blocks: (seen.append((pairs.count(), crowds.count())), whole(pairs, crowds, blocks))[1])
    values = _values()
    docs = documents(spark, values).repartition(5, "doc_id")
    got = {(r.id, r.line) for r in later_matches(docs, bits=16).collect()}
    assert got == plain(list(enumerate(values))) and len(got) >= 8
    (pairs, members), = seen
    assert (pairs > 0, members > 0) == (not crowded, crowded)


@pytest.mark.parametrize("frequent", [1, 5, 50])
def test_any_bound_gives_the_same_lines(spark, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    values = texts(seed=5) + _values()
    docs = documents(spark, values).repartition(3, "doc_id")
    assert {(r.id, r.line) for r in later_matches(docs, crowd=3, bits=12).collect()} == plain(list(enumerate(values)))


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_search_leaves_its_result_only(spark):
    root = shared_root(spark) + "/riskmart"
    listed = lambda: set(os.listdir(root)) if os.path.isdir(root) else set()
    docs, before, held = documents(spark, _values()), listed(), _shuffles(spark)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    removed = later_matches(docs, bits=10)
    new = [d for d in listed() - before if d.startswith("lines")]
    assert [os.listdir(f"{root}/{d}") for d in new] == [["001-removed"]]
    for _ in range(50):
        if not _shuffles(spark) - held:
            break
        time.sleep(0.1)
    assert not _shuffles(spark) - held
    assert removed.count() and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
