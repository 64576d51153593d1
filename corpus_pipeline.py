"""From raw documents to balanced training shards: five stages, each one operator of ``riskmart.llm``.

A stage takes (spark, docs, sf_dir), where ``docs`` is what the stage before kept,
and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import quality
from riskmart.llm.decontaminate import clean_documents
from riskmart.llm.kd_shards import kd_shards
from riskmart.llm.mixing import mixed_documents
from riskmart.llm.ngram_join import one_of_each
from riskmart.session import Scratch

# Model scores, similarity components and range cuts are not SQL; tests compare with plain Python.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones among them, accepts."""
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.8)."""
    return one_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stream mixed to the sources' target weights: scarce sources repeat, nothing is lost."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes: doc_id, size, text_crc32, shard, slot."""
    return kd_shards(docs, n_shards=8)


STAGES = [("quality", keep_good), ("near_duplicates", keep_distinct), ("decontaminate", keep_clean),
          ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each stage's result stored and read again."""
    scratch = Scratch(spark, "pipeline", until_exit=True)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
