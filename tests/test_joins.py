"""The spread join equals the plain join, and one key's rows are dealt over many tasks."""

from pyspark.sql import functions as F

from riskmart.operators.joins import hot_keys, spread_join


def _side(spark, n, name):
    # a third of the rows share id 0, another 5 % id 1, some have none
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 20 == 1, 1).when(F.col("id") % 50 == 2, None)
        .otherwise(F.col("id")).cast("long").alias("k"), (F.col("id") * 7).alias(name))


def test_equal_to_plain_join(spark):
    left, right = _side(spark, 900, "a"), _side(spark, 600, "b")
    plain, spread = left.join(right, "k"), spread_join(left, right, "k")
    assert spread.columns == plain.columns == ["k", "a", "b"]
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(spread) == key(plain)
    assert set(hot_keys(left, "k")) == {0, 1}


def test_hot_on_one_side_text_keys_and_no_hot_keys(spark):
    left = _side(spark, 600, "a").withColumn("k", F.concat(F.lit("k"), "k"))
    right = spark.range(600).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("b"))
    for x, y in ((left, right), (right, left), (right, right.withColumnRenamed("b", "c"))):
        assert sorted(map(tuple, spread_join(x, y, "k").collect())) == sorted(map(tuple, x.join(y, "k").collect()))
    empty = left.where("false")
    assert hot_keys(empty, "k") == {} and spread_join(empty, right, "k").count() == 0


def test_hot_key_meets_in_many_cells(spark):
    """With AQE's own skew handling off, no task sees more than a fraction of the hot key's pairs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        left, right = _side(spark, 3000, "a"), _side(spark, 3000, "b")
        most = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]
        pairs = 1000 * 1000
        assert most(left.join(right, "k")) >= pairs
        assert most(spread_join(left, right, "k")) < pairs / 8
    finally:
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
