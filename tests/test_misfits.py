"""Values that do not fit the harmonised types are listed, and rows stay whole."""

from pyspark.sql import functions as F

from riskmart.operators.harmonise import conform, flat_feed, flat_shape, misfits
from riskmart.operators.metrics import StageMetrics


def _feed(spark):
    rows = [(1, "a", "1.5", "2"), (2, "b", "x", None), (3, None, "NaN", "1,5"), (None, "d", "", "7")]
    return spark.createDataFrame(rows, "HSISID long, NAME string, X string, Y string").withColumn("STATE", F.lit("NC"))


def test_each_misfit_once(spark):
    shaped = flat_shape(_feed(spark), "Wake")
    got = sorted((r.datasetId or "", r.column, r.value, r.reason) for r in misfits(shaped).collect())
    assert got == [("", "geoX", "", "not a double"), ("2", "geoX", "x", "not a double"), ("3", "geoY", "1,5", "not a double")]
    assert conform(shaped).count() == 4
    assert conform(shaped).where("geoX is null").count() == 2
    assert sorted(map(str, flat_feed(_feed(spark), "Wake").collect())) == sorted(map(str, conform(shaped).collect()))


def test_empty_feed(spark):
    shaped = flat_shape(_feed(spark).where("false"), "Wake")
    assert misfits(shaped).count() == 0 and conform(shaped).count() == 0


def test_settled_count_takes_the_observed_one_s_place(spark):
    metrics = StageMetrics()
    metrics.observe(spark.range(7), "s", "t").collect()
    metrics.observe(spark.range(3), "s", "u").collect()
    metrics.settle("s", "t", 5)
    assert metrics.value("s", "t") == 5 and metrics.value("s", "u") == 3 and len(metrics.records) == 2
