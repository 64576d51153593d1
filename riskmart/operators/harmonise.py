"""Harmonising unlike feeds into one schema.

A flat CSV feed and a nested JSON feed of the same kind of records are each
projected onto one target schema, with a composite ``id``, and unioned by
column name. Every expression is a built-in column function.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.columns import typed_null

# The harmonised record layout (name, type), in output order.
TARGET_SCHEMA = T.StructType([
    T.StructField("datasetId", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("address1", T.StringType()),
    T.StructField("address2", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("tel", T.StringType()),
    T.StructField("dateStart", T.StringType()),
    T.StructField("dateEnd", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("geoX", T.DoubleType()),
    T.StructField("geoY", T.DoubleType()),
    T.StructField("county", T.StringType()),
    T.StructField("id", T.StringType()),
])

# Flat-feed source column → target column.
FLAT_RENAMES = {
    "HSISID": "datasetId", "NAME": "name", "ADDRESS1": "address1", "ADDRESS2": "address2",
    "CITY": "city", "STATE": "state", "POSTALCODE": "zip", "PHONENUMBER": "tel",
    "RESTAURANTOPENDATE": "dateStart", "FACILITYTYPE": "type", "X": "geoX", "Y": "geoY",
}
# Flat-feed columns that are not kept.
FLAT_DROPPED = ("OBJECTID", "GEOCODESTATUS", "PERMITID")

# Nested-feed field (under ``fields``) → target column.
NESTED_FIELDS = {
    "datasetId": "id", "name": "premise_name", "address1": "premise_address1",
    "address2": "premise_address2", "city": "premise_city", "state": "premise_state",
    "zip": "premise_zip", "tel": "premise_phone", "dateStart": "opening_date",
    "dateEnd": "closing_date",
}
# Nested-feed columns that are not kept.
NESTED_DROPPED = ("fields", "geometry", "record_timestamp", "recordid")


def composite_id(*parts: str, sep: str = "_"):
    """``state_county_datasetId``; null when any part is null (concat semantics)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(F.col(p))
    return F.concat(*cols)


def conform(df: DataFrame, schema: T.StructType = TARGET_SCHEMA) -> DataFrame:
    """Target types and order; a value that does not fit, or a column the feed lacks, is a typed null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else typed_null(f.dataType)).alias(f.name)
        for f in schema.fields])


def misfits(df: DataFrame, schema: T.StructType = TARGET_SCHEMA, keep: Sequence[str] = ("id", "datasetId")) -> DataFrame:
    """The values that ``conform`` turns into null because they do not fit their type.

    One row each: the ``keep`` columns as text, ``column``, ``value`` (as text) and ``reason``.
    ``df`` has the target's column names already (``flat_shape``, ``nested_shape``).
    """
    have = set(df.columns)
    bad = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.struct(
        F.lit(f.name).alias("column"), F.col(f.name).cast("string").alias("value"),
        F.lit(f"not a {f.dataType.simpleString()}").alias("reason"))) for f in schema.fields if f.name in have]
    return (df.withColumn("_bad", F.explode(F.array_compact(F.array(*bad))))
            .select(*[F.col(k).cast("string").alias(k) for k in keep], "_bad.*"))


def flat_feed(df: DataFrame, county: str) -> DataFrame:
    """Flat (CSV) feed: add county, rename, typed null end date, drop, composite id."""
    return conform(flat_shape(df, county))


def flat_shape(df: DataFrame, county: str) -> DataFrame:
    """``flat_feed`` before its values are fitted to the target types."""
    out = (df.withColumn("county", F.lit(county))
           .withColumnsRenamed(FLAT_RENAMES)
           .withColumn("dateEnd", typed_null("string"))
           .drop(*FLAT_DROPPED))
    return out.withColumn("id", composite_id("state", "county", "datasetId"))


def nested_feed(df: DataFrame, county: str) -> DataFrame:
    """Nested (JSON) feed: struct fields, type after " - ", coordinates from an array."""
    return conform(nested_shape(df, county))


def nested_shape(df: DataFrame, county: str) -> DataFrame:
    """``nested_feed`` before its values are fitted to the target types."""
    out = df.withColumn("county", F.lit(county)).withColumns(
        {target: F.col(f"fields.{source}") for target, source in NESTED_FIELDS.items()})
    out = out.withColumns({
        "type": F.get(F.split(F.col("fields.type_description"), " - "), 1),
        "geoX": F.get(F.col("fields.geolocation"), 0),
        "geoY": F.get(F.col("fields.geolocation"), 1),
    }).drop(*NESTED_DROPPED)
    return out.withColumn("id", composite_id("state", "county", "datasetId"))


def union_feeds(feeds: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name (not position)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), feeds)


def union_positional(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by position; names come from the first frame."""
    return reduce(lambda a, b: a.union(b), frames)


def replicate(df: DataFrame, copies: int) -> DataFrame:
    """Each row ``copies`` times, as one generator node (not a chain of unions)."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")


def mean_of(lo: str, hi: str):
    """Mean of two columns written as expression text, as the tutorial does."""
    return F.expr(f"(`{lo}` + `{hi}`) / 2")


def interval_columns(df: DataFrame, lo: str = "lcl", hi: str = "ucl") -> DataFrame:
    """Add ``avg``, the mean of two columns, and copies ``lcl2`` and ``ucl2`` of them."""
    return df.withColumns({"avg": mean_of(lo, hi), "lcl2": F.col(lo), "ucl2": F.col(hi)})
