"""Nested JSON feed source (S3): JSON lines with struct and array fields.

Pass a schema at scale: without one ``read_json_feed`` reads all input once to infer it.
``read_checked_feed`` infers from a bounded number of lines instead and lists, in the one
pass that reads the feed, whatever does not fit the schema.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.session import Scratch

SAMPLE_LINES = 10_000
BAD = "_unfit_line"


def read_json_feed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


@dataclass
class FeedRead:
    """``rows``: one for each JSON object, unfit values null. ``conflicts``: line, field, value, reason."""

    rows: DataFrame
    conflicts: DataFrame
    schema: T.StructType


def sampled_schema(spark: SparkSession, path: str, lines: int = SAMPLE_LINES) -> T.StructType:
    """The schema of the first ``lines`` lines; the rest of the input is not read."""
    with Scratch(spark, "feed-sample") as scratch:
        part = scratch.path("lines")
        spark.read.text(path).limit(lines).write.text(part)
        return spark.read.json(part).schema


def _structs(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.StructType]]:
    yield path, schema
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _structs(f.dataType, (*path, f.name))


def _at(path: tuple[str, ...]) -> Column:
    """The JSON text at a path of names (null where there is none)."""
    return F.get_json_object("value", "$" + "".join(f"['{name}']" for name in path)) if path else F.col("value")


def _typed_at(path: tuple[str, ...]) -> Column:
    column = F.col("_row")
    for name in path:
        column = column.getField(name)
    return column


def _conflict(field: Column, value: Column, reason: str) -> Column:
    return F.struct(field.alias("field"), value.alias("value"), F.lit(reason).alias("reason"))


def _unknown(above: str):
    """For transform over names that the schema lacks below ``above``."""
    return lambda key: _conflict(F.concat(F.lit(above + "." if above else ""), key), F.lit(None).cast("string"),
                                 "not in the schema")


def read_checked_feed(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      sample_lines: int = SAMPLE_LINES) -> FeedRead:
    """Read a feed of JSON lines with ``schema``, or with that of its first ``sample_lines`` lines.

    A conflict is a value that does not fit its field's type (the row stays, the value is
    null), a field that the schema lacks (at any depth of objects, not inside arrays; values of names with a quote are not looked at), or a
    line that is no JSON object (no row). Blank lines are left out. Both results are lazy
    and each is one scan of the feed.
    """
    schema = schema or sampled_schema(spark, path, sample_lines)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = (spark.read.text(path).where(F.trim("value") != "")
              .withColumn("_row", F.from_json("value", whole, options)))
    is_object = F.json_object_keys("value").isNotNull()
    rows = parsed.where(is_object).select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields])

    found = [F.when(~is_object, F.array(_conflict(F.lit(""), F.lit(None).cast("string"), "not a JSON object")))]
    for above, struct in _structs(schema):
        names = F.array(*[F.lit(f.name) for f in struct.fields]).cast("array<string>")
        unknown = F.array_except(F.json_object_keys(_at(above)), names)
        found.append(F.when(is_object, F.transform(unknown, _unknown(".".join(above)))))
        for f in struct.fields:
            here = (*above, f.name)
            unfit = is_object & _typed_at(here).isNull() & _at(here).isNotNull()
            if above:                          # an object that is unfit as a whole is one conflict
                unfit = unfit & _typed_at(above).isNotNull()
            found.append(F.when(unfit, F.array(_conflict(F.lit(".".join(here)), _at(here), f"not a {f.dataType.simpleString()}"))))
    conflicts = parsed.select(F.col("value").alias("line"),
                              F.explode(F.flatten(F.array_compact(F.array(*found)))).alias("_conflict"))
    return FeedRead(rows, conflicts.select("line", "_conflict.*"), schema)
