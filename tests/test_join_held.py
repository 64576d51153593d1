"""The spread join holds the side with fewer hot rows, in parts of a bounded size."""

from pyspark.sql import functions as F

from riskmart.operators import joins


def _side(spark, n, name):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("long").alias("k"),
                                 F.col("id").alias(name), F.lit(name).alias("same"))


def test_parts_are_small_enough_to_be_held():
    assert joins._parts(900, {0: 300}, 1 / 64, 100) == {0: 22}
    assert joins._parts(1_800_000, {0: 600_000, 1: 30_000}, 1 / 64, 4096) == {0: 147, 1: 8}
    assert joins._parts(1_800_000, {0: 600_000, 1: 30_000}, 1 / 64) == {0: 22, 1: 2}


def test_smaller_side_is_held_whichever_side_it_is(spark, monkeypatch):
    monkeypatch.setattr(joins, "HELD", 10)
    small, large = _side(spark, 600, "a"), _side(spark, 1500, "b")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    for left, right in ((small, large), (large, small)):
        spread = joins.spread_join(left, right, "k")
        assert spread.columns == left.join(right, "k").columns
        assert key(spread) == key(left.join(right, "k"))
        plan = spread._jdf.queryExecution().optimizedPlan().toString()
        held = "_l" if left is small else "_r"
        assert "rightHint=(strategy=merge)" in plan
        other = "_r" if left is small else "_l"
        assert plan.index(f"AS {other}1") < plan.index(f"AS {held}1")           # the streamed side comes first
