import random

import pytest
from pyspark.sql import functions as F

from riskmart.operators.ranking import asc, desc, global_rank, plain_rank


def _ranks(df, key="id"):
    return {r[key]: r["rank"] for r in df.select(key, "rank").collect()}


def _random_rows(n, seed, distinct=50):
    rnd = random.Random(seed)
    specials = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    rows = []
    for i in range(n):
        r = rnd.random()
        if r < 0.1:
            v = rnd.choice(specials)
        else:
            v = float(rnd.randint(0, distinct)) / 4
        w = rnd.choice([None, rnd.randint(0, 5)])
        rows.append((i, v, w))
    return rows


@pytest.mark.parametrize("buckets", [None, 1, 37])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_plain_window_with_ties_nulls_nan(spark, buckets, seed):
    df = spark.createDataFrame(_random_rows(3000, seed), "id long, v double, w int")
    for order in (desc("v"), [("v", True), ("w", False)], asc("v", "w"), [("w", True), ("v", False)]):
        got = _ranks(global_rank(df, order, buckets=buckets))
        want = _ranks(plain_rank(df, order))
        assert got == want, order


def test_distributed_on_unique_keys_many_buckets(spark):
    df = spark.range(20000).select(F.col("id"), (F.rand(7) * 1e6).alias("score"))
    got = _ranks(global_rank(df, desc("score"), buckets=40))
    want = _ranks(plain_rank(df, desc("score")))
    assert got == want


def test_one_distinct_key_and_empty(spark):
    same = spark.range(500).withColumn("v", F.lit(1.0))
    assert set(_ranks(global_rank(same, desc("v"))).values()) == {1}
    empty = spark.createDataFrame([], "id long, v double")
    assert global_rank(empty, desc("v")).count() == 0


def test_rank_is_bigint_and_appended_last(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id long, v double")
    out = global_rank(df, desc("v"))
    assert out.columns == ["id", "v", "rank"]
    assert dict(out.dtypes)["rank"] == "bigint"


def test_hot_key_keeps_all_rows(spark):
    # A third of the rows share one key: every row must come back with the same rank.
    df = spark.range(9000).select("id", F.when(F.col("id") < 3000, F.lit(5.0))
                                  .otherwise(F.col("id").cast("double")).alias("v"))
    out = global_rank(df, desc("v"))
    assert out.count() == 9000
    assert _ranks(out) == _ranks(plain_rank(df, desc("v")))


def _single_partitions(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("SinglePartition"), plan.count("hashpartitioning(_b")


@pytest.mark.parametrize("rows, single, by_bucket", [(20, 1, 0), (2_000_000, 0, 1)])
def test_buckets_follow_the_rows(spark, rows, single, by_bucket):
    # a table of one bucket is sorted whole; no step of a larger one takes all rows or joins
    df = spark.range(rows).select("id", (F.col("id") * 7 % 1013).cast("double").alias("v"))
    out = global_rank(df, desc("v"))
    assert _single_partitions(out) == (single, by_bucket)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan parquet") == 1


def test_search_steps_stay_in_generated_code_and_small(spark):
    """The plan grows with the number of steps, not of cuts, and no step is interpreted row by row."""
    df = spark.range(20000).select("id", (F.col("id") * 7 % 10007).cast("double").alias("v"), (F.col("id") % 5).alias("w"))
    out = global_rank(df, [("w", True), ("v", False)], buckets=300)
    assert _ranks(out) == _ranks(plain_rank(df, [("w", True), ("v", False)]))
    optimized = out._jdf.queryExecution().optimizedPlan()
    assert optimized.toString().count("CASE WHEN") < 40
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.split("Initial Plan")[0].split("\n") if "Project" in line and "CASE WHEN" in line]
    assert steps and all("*(" in line for line in steps)


def test_hot_key_is_cut(spark):
    from riskmart.operators.ranking import with_bucket
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    cut = with_bucket(df, desc("v"), ("id",), 16)
    rows = {r["_b"]: r["count"] for r in cut.where("v = 5").groupBy("_b").count().collect()}
    assert len(rows) >= 4 and max(rows.values()) < 1500
    whole = [r["count"] for r in cut.groupBy("_b").count().collect()]
    assert len(whole) >= 14 and max(whole) < 9000 / 16 * 2


def test_position_is_unique_and_in_order(spark):
    rows = [(i % 50, float(i % 3), "x") for i in range(400)] + [(7, 1.0, "same")] * 30
    df = spark.createDataFrame(rows, "id long, v double, s string")
    out = global_rank(df, desc("v"), position="position", buckets=13).orderBy("position").collect()
    assert [r.position for r in out] == list(range(1, 431))
    assert [(-r.v, r.id) for r in out] == sorted((-r.v, r.id) for r in out)
    first = {}
    assert all(r["rank"] == first.setdefault(r.v, r.position) for r in out)


def test_only_the_sample_runs_before_the_action(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rank-lazy", "rank")
    global_rank(spark.range(1000).select("id", (F.col("id") % 9).alias("v")), desc("v"))
    jobs = tracker.getJobIdsForGroup("rank-lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    assert len(stages) <= 6                  # the sample's stages; AQE runs each as a job


def test_timestamp_date_and_string_keys(spark):
    df = spark.range(3000).select(
        "id",
        F.expr("make_timestamp_ntz(2020, 1 + CAST(id % 12 AS INT), 1 + CAST(id % 27 AS INT), "
               "CAST(id % 24 AS INT), 0, 0)").alias("ts"),
        F.expr("date_add(DATE'2020-01-01', CAST(id % 97 AS INT))").alias("d"),
        F.expr("concat('k', CAST(id % 211 AS STRING))").alias("s"))
    for order in (desc("ts"), asc("d", "s"), [("s", True), ("ts", False)]):
        got = _ranks(global_rank(df, order, buckets=20))
        assert got == _ranks(plain_rank(df, order)), order


@pytest.mark.parametrize("binary", [False, True])
def test_long_keys_with_a_common_prefix(spark, binary):
    # ids run against the keys, and a page position must follow the whole key
    prefix = "https://example.org/" + "path/" * 20
    key = F.concat(F.lit(prefix), F.lpad((5000 - F.col("id") - F.col("id") % 3).cast("string"), 5, "0"))
    df = spark.range(3000).select("id", (key.cast("binary") if binary else key).alias("k"), (F.col("id") % 2).alias("w"))
    for order in (asc("k"), desc("k"), [("w", True), ("k", False)]):
        out = global_rank(df, order, buckets=20, position="position")
        assert _ranks(out) == _ranks(plain_rank(df, order)), order
        positions = [r.position for r in out.orderBy(*[F.col(c).desc() if d else F.col(c) for c, d in order], "id").collect()]
        assert positions == list(range(1, 3001)), order


def test_long_keys_with_a_common_prefix_are_spread(spark):
    from riskmart.operators.ranking import with_bucket
    df = spark.range(3000).select("id", F.concat(F.lit("p" * 100), F.col("id").cast("string")).alias("k"))
    rows = [r["count"] for r in with_bucket(df, asc("k"), ("id",), 16).groupBy("_b").count().collect()]
    assert len(rows) >= 14 and max(rows) < 3000 / 16 * 2


def test_rerank_replaces_existing_rank_column(spark):
    df = spark.createDataFrame([(1, 2.0, 99), (2, 3.0, 98)], "id long, v double, rank long")
    for strategy in ("plain", "buckets"):
        out = global_rank(df, desc("v"), strategy=strategy)
        assert out.columns == ["id", "v", "rank"]
        assert _ranks(out) == {1: 2, 2: 1}
