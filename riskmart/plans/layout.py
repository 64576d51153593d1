"""Storage layout (K1–K4, P1, S7–S9): load-date partitions, catalog tables, gold dirs."""

from __future__ import annotations

import uuid
from datetime import date
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_PARTS = ("year", "month", "day")


def with_load_date(df: DataFrame, as_of: date) -> DataFrame:
    """Append int ``year``, ``month``, ``day`` of the load date (constant columns)."""
    return df.withColumns({"year": F.lit(as_of.year), "month": F.lit(as_of.month),
                           "day": F.lit(as_of.day)})


def _rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    # AQE sizes the write tasks (advisory partition size) and splits a large
    # date into several tasks, instead of a fixed repartition(n).
    return df.hint("rebalance", *by) if by else df.hint("rebalance")


def write_partitioned(df: DataFrame, path: str, as_of: date | None = None,
                      mode: str = "static", partition_by: Sequence[str] = DATE_PARTS,
                      cluster: bool | None = None, num_files: int | None = None) -> None:
    """Overwrite a date-partitioned Parquet dataset.

    ``mode="static"`` replaces the whole dataset (the reference's behaviour:
    only the last load survives); ``"dynamic"`` replaces only the dates being
    written and keeps the others.

    ``cluster`` groups rows by partition value before writing (a ``REBALANCE``
    shuffle whose skewed partitions AQE splits to file size). It pays off when
    the partition values come from the data and are many (a backfill over
    thousands of days), so it is the default only without ``as_of``. With one
    load date (plus, say, an accepted/rejected flag) every task writes its own
    few files and nothing is shuffled. ``num_files`` instead fixes the number of
    writing tasks (the reference's ``repartition(4)``).
    """
    if mode not in ("static", "dynamic"):
        raise ValueError(f"unknown overwrite mode {mode!r}")
    if as_of is not None:
        df = with_load_date(df, as_of)
    if num_files is not None:
        # A fixed file count, as the reference's repartition(4) (one shuffle).
        df = df.repartition(num_files)
    else:
        if cluster is None:
            cluster = as_of is None
        if cluster:
            df = _rebalanced(df, partition_by)
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", mode)
     .partitionBy(*partition_by).parquet(path))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     as_of: date | None = None) -> DataFrame:
    """Read a partitioned dataset; partition columns come back as columns (pruned on filter).

    With ``as_of`` the load date's own directory is opened, so no other day is listed; a
    dataset without that day gives no rows.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if as_of is None:
        return reader.parquet(path)
    values = dict(zip(DATE_PARTS, (as_of.year, as_of.month, as_of.day)))
    day = "/".join([path, *[f"{k}={v}" for k, v in values.items()]])
    if path_exists(spark, day) is False:
        wanted = [F.col(k) == v for k, v in values.items()]
        return reader.parquet(path).where(wanted[0] & wanted[1] & wanted[2])
    return reader.option("basePath", path).parquet(day)


def last_partition(spark: SparkSession, table: str) -> date | None:
    """The last load date among the catalog's partitions of a table; no file is read."""
    dates = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in row[0].split("/"))
        dates.append(date(*[int(values[k]) for k in DATE_PARTS]))
    return max(dates, default=None)


def save_table(df: DataFrame, name: str, path: str | None = None,
               partition_by: Sequence[str] = (), bucket_by: tuple[int, str] | None = None,
               mode: str = "overwrite", replace: dict[str, int] | None = None) -> None:
    """Write a catalog table: managed, or external when ``path`` is given.

    ``replace`` names one partition (every partition column's value): if the table
    exists only that partition is written anew, its others stay.

    ``bucket_by=(n, "id")`` stores the table hash-bucketed on ``id``, so a later
    join of two such tables on ``id`` needs no shuffle (the write pays one
    shuffle by ``id`` instead; worth it when the table is joined more than once).
    Without bucketing no repartition is added: each task writes its own files.
    """
    if bucket_by is not None:
        # Without this shuffle every task would write a file per bucket
        # (tasks × buckets files); with it each bucket is written by one task.
        df = df.repartition(bucket_by[0], bucket_by[1])
    if replace and df.sparkSession.catalog.tableExists(name):
        view = f"riskmart_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        columns = [f"`{c}`" for c in df.sparkSession.table(name).columns if c not in replace]
        part = ", ".join(f"`{k}` = {v}" for k, v in replace.items())
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({part}) SELECT {', '.join(columns)} FROM {view}")
        df.sparkSession.catalog.dropTempView(view)
        return
    writer = df.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def publish_table(spark: SparkSession, name: str, path: str, properties: dict[str, str]) -> None:
    """An external Parquet table ``name`` over the files at ``path``: made, or pointed there anew."""
    schema = spark.read.parquet(path).schema
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    if spark.catalog.tableExists(name) and spark.table(name).schema != schema:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")
    spark.catalog.refreshTable(name)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object for ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether a path exists, on whatever file system its URI names (None: unknown)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:                       # no driver-side JVM (e.g. Spark Connect)
        return None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_gold_dir(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All Parquet files of one directory; a missing or empty directory gives no rows."""
    exists = path_exists(spark, path)
    if exists is False:
        return spark.createDataFrame([], schema)
    if exists is None:
        try:
            df = spark.read.schema(schema).parquet(path)
            df.schema                        # resolves the path
            return df
        except Exception as exc:
            if "PATH_NOT_FOUND" in str(exc):
                return spark.createDataFrame([], schema)
            raise
    return spark.read.schema(schema).parquet(path)
