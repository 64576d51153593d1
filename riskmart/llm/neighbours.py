"""The next row in descending order of an integer id, without one task for the whole order.

Ids are counted in at most 65,536 equal cells of their range; cells are merged
into buckets of about ``bucket_rows`` rows, and a cell with more rows is cut into
finer cells. The first row of each bucket is copied to the bucket before it (a
broadcast of one id per bucket, at most about a million by the choice of
``bucket_rows``), so a window per bucket finds every next row in one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16
BUCKET_ROWS = 2048
MOST_BUCKETS = 1 << 20
_LOWEST = -(1 << 63)


def _order_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))


def _bucketed(df: DataFrame, id_col: str, bucket_rows: int) -> DataFrame:
    """``df`` with ``_bucket``, ascending with the id; null ids come before all."""
    spark, key = df.sparkSession, F.col(id_col).cast("long")
    low, high, rows = df.agg(F.min(key), F.max(key), F.count(key)).head()
    if not rows:
        return df.withColumn("_bucket", F.lit(-1).cast("long"))
    bucket_rows = max(bucket_rows, rows // MOST_BUCKETS + 1)
    width = (high - low) // CELLS + 1
    cell = F.expr(f"cast(({id_col} - {low}) div {width} as long)")
    counts = sorted(df.where(key.isNotNull()).groupBy(cell.alias("cell")).count().collect())   # at most CELLS rows
    plan, bucket, filled = [], 0, 0
    for c, n in counts:
        parts = min(width, n // bucket_rows) if n >= 2 * bucket_rows else 1
        if filled and filled + n > bucket_rows:
            bucket, filled = bucket + 1, 0
        plan.append((c, bucket, low + c * width, -(-width // parts)))
        bucket, filled = (bucket + parts, 0) if parts > 1 else (bucket, filled + n)
    cells = spark.createDataFrame(plan, "_cell long, _first long, _low long, _step long")
    return (df.join(F.broadcast(cells), cell == F.col("_cell"), "left")
            .withColumn("_bucket", F.coalesce(F.expr(f"_first + ({id_col} - _low) div _step"), F.lit(-1)).cast("long"))
            .drop("_cell", "_first", "_low", "_step"))


def with_next(df: DataFrame, id_col: str, value: str, out: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``out``: ``value`` of the next row by descending id; the last row's next is the first.

    Rows of equal id follow each other by value.
    """
    cut = _bucketed(df, id_col, bucket_rows)
    ordered = [_order_key(id_col).desc(), F.col(value).asc_nulls_first()]
    heads = cut.groupBy("_bucket").agg(F.max(_order_key(id_col)).alias("_head"))
    up = Window.orderBy("_bucket")       # one row per bucket
    heads = (heads.withColumn("_to", F.lead("_bucket").over(up))
             .withColumn("_to", F.coalesce("_to", F.first("_bucket").over(up.rowsBetween(
                 Window.unboundedPreceding, Window.unboundedFollowing)))))
    joined = cut.join(F.broadcast(heads.withColumnRenamed("_bucket", "_from")),
                      (F.col("_bucket") == F.col("_from")) & (_order_key(id_col) == F.col("_head")))
    firsts = (joined.groupBy("_to")
              .agg(F.min_by(value, F.struct(F.col(value).isNotNull(), F.col(value))).alias(value))
              .select(*[(F.col(value) if c == value else F.lit(None).cast(t)).alias(c) for c, t in df.dtypes],
                      F.col("_to").alias("_bucket"), F.lit(True).alias("_copy")))
    both = cut.withColumn("_copy", F.lit(False)).unionByName(firsts)
    window = Window.partitionBy("_bucket").orderBy(F.col("_copy").asc(), *ordered)
    return (both.withColumn(out, F.lead(value).over(window)).where(~F.col("_copy")).drop("_bucket", "_copy"))
