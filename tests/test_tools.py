import duckdb
import pytest
from pyspark.sql import functions as F

from riskmart.plans.oracle import compare
from riskmart.plans.planreport import summarise


def test_compare_is_order_and_column_order_insensitive(spark):
    con = duckdb.connect()
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, float("nan"))], "k long, s string, x double")
    ok, msg = compare(df, con, "SELECT * FROM (VALUES ('NaN'::DOUBLE, 2, NULL), (0.5, 1, 'a')) t(x, k, s)")
    assert ok, msg
    bad, msg = compare(df, con, "SELECT 1 AS k, 'a' AS s, 0.5 AS x")
    assert not bad and "row counts differ" in msg
    renamed, msg = compare(df, con, "SELECT 1 AS key, 'a' AS s, 0.5 AS x")
    assert not renamed and "columns differ" in msg


def test_plan_summary_counts_exchanges(spark):
    df = spark.range(100).groupBy((F.col("id") % 7).alias("g")).count()
    s = summarise(df)
    assert s["hash_shuffles"] == 1 and s["single_partition"] == 0 and not s["python"]


def test_shared_root_prefers_session_setting_then_local_dir():
    import os
    from riskmart import session

    class Conf:
        def __init__(self, value, master):
            self.values = {"spark.checkpoint.dir": value, "spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key) or default

    class Ctx:
        def getCheckpointDir(self):
            return None

    class Fake:
        def __init__(self, value, master="local[4]"):
            self.conf, self.sparkContext = Conf(value, master), Ctx()

    assert session.shared_root(Fake("hdfs:///ckpt/")) == "hdfs:///ckpt"
    first = session.shared_root(Fake(None))
    assert os.path.isdir(first) and session.shared_root(Fake(None)) == first
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            session.shared_root(Fake(None, master))
        assert session.shared_root(Fake("/shared", master)) == "/shared"


def test_scratch_directories_do_not_touch_each_other(spark):
    from riskmart.session import Scratch
    with Scratch(spark, "a") as one:
        kept = one.store(spark.range(5).toDF("x"), "t")
        with Scratch(spark, "a") as two:
            two.store(spark.range(3).toDF("x"), "t")
        assert kept.count() == 5


def test_plan_report_sees_arrow_functions(spark):
    from riskmart.plans.planreport import summarise
    same = lambda batches: batches
    assert summarise(spark.range(3).mapInArrow(same, "id long"))["python"]
    assert summarise(spark.range(3).groupBy("id").applyInArrow(lambda t: t, "id long"))["python"]
    assert not summarise(spark.range(3).groupBy("id").count())["python"]
