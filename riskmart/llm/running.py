"""Running sums inside groups of any size, without one task per group.

A group is cut into buckets by ranges of a uniform 64-bit hash; bucket totals
give the offsets, a window per bucket gives the rest. A group that holds most of
the rows is just a group with many buckets. Rows that are equal in hash and tie
columns share a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 4096


def uniform(h: Column) -> Column:
    """A hash as a number in [0, 1), in the order of its unsigned value."""
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def running_sum(df: DataFrame, group: list[str], h: str, ties: list[str], value: Column, out: str,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the group's earlier rows, in the order (h, ties).

    ``df`` is read three times, so pass a stored table. Null group keys are a group.
    """
    same = lambda a, b, keys: [a[k].eqNullSafe(b[f"_{k}"]) for k in keys]
    renamed = lambda t: t.select(*[F.col(k).alias(f"_{k}") if k in group else F.col(k) for k in t.columns])
    sizes = renamed(df.groupBy(*group).agg(F.ceil(F.count("*") / bucket_rows).cast("int").alias("_buckets")))
    drop = [f"_{k}" for k in group]
    cut = (df.join(sizes, same(df, sizes, group), "left").drop(*drop)
           .withColumn("_bucket", F.floor(uniform(F.col(h)) * F.col("_buckets")).cast("int"))
           .withColumn("_value", value.cast("long")))
    totals = cut.groupBy(*group, "_bucket").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = renamed(totals.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
                      .drop("_sum")).withColumnRenamed("_bucket", "_at")
    within = (Window.partitionBy(*group, "_bucket").orderBy(h, *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = cut.withColumn("_local", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    return (local.join(offsets, [*same(local, offsets, group), local["_bucket"] == offsets["_at"]])
            .withColumn(out, F.col("_offset") + F.col("_local"))
            .drop(*drop, "_buckets", "_bucket", "_value", "_offset", "_local", "_at"))
