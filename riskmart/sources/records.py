"""Records over several lines, read in parallel: quoted line breaks and SQL statements.

A file is read as lines by as many tasks as it has splits. Whether a line starts inside a
quoted value is the parity of the quotes before it: one number for each split gives the
parity at its start, a window over the split's own lines gives the rest. A record ends with
a line after which no value is open (a SQL statement: and that ends with ``;``); a split's
first lines go on with the record that the last split with a record's end left open. No
task holds a file, only the lines of one split, and then those of one record.

A file with an odd number of quotes has no such reading: each of its lines is a record of
its own, so that one stray quote cannot make the rest of a file one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.session import Scratch
from riskmart.sources.delimited import parse_decimal_commas, text_schema

# What a line of a dump looks like outside quotes.
SQL_COMMENT = r"^\s*(?:--|#)"
SQL_END = r";\s*$"
SQL_START = r"^\s*(?i:INSERT\s+INTO)\b"
BLANK = r"^\s*$"


def records(spark: SparkSession, path: str | Sequence[str], quotes: Column, skip: Column, ends: Column,
            starts: Column, scratch: Scratch) -> DataFrame:
    """(file, record, first) of every record; ``first`` marks the record with a file's first line.

    The conditions are over the column ``value``, a line without its line end: ``quotes``
    counts its quotes; outside quoted values, ``skip`` leaves a line out, ``starts`` makes it
    the first of a record, and ``ends`` (tested after the line) the last.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .withColumn("no", F.monotonically_increasing_id()).withColumn("quotes", quotes.cast("long")))
    by_file = Window.partitionBy("file")
    earlier = by_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file", "block").agg(F.sum("quotes").alias("all"))         # a row for each split
              .select("file", "block", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("ahead"),
                      (F.sum("all").over(by_file) % 2 == 0).alias("balanced")))
    inside = Window.partitionBy("file", "block").orderBy("no")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    seen = F.sum("quotes").over(upto) + F.col("ahead")
    parsed = (lines.join(splits, ["file", "block"])
              .withColumn("after", F.col("balanced") & (seen % 2 == 1))
              .withColumn("before", F.col("balanced") & ((seen - F.col("quotes")) % 2 == 1))
              .where(F.col("before") | ~skip)
              .withColumn("ended", (~F.col("balanced") | (~F.col("after") & ends)).cast("int"))
              .withColumn("started", (~F.col("before") & starts).cast("int")))
    cut = F.sum(F.col("ended") + F.col("started")).over(upto) - F.col("ended")
    stored = scratch.store(parsed.select("file", "block", "no", "value", cut.alias("nth"),
                                         (F.col("ended") + F.col("started")).alias("cuts")), "lines")
    # where the first lines of a split belong: to the last record of the last split with a cut
    tails = (stored.groupBy("file", "block").agg(F.sum("cuts").alias("cuts"))
             .withColumn("tail", F.last(F.when(F.col("cuts") > 0, F.struct("block", F.col("cuts").alias("nth"))),
                                        ignorenulls=True).over(earlier))
             .select("file", "block", "tail"))
    none = F.struct(F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("nth"))
    key = F.when(F.col("nth") > 0, F.struct("block", "nth")).otherwise(F.coalesce("tail", none))
    return (stored.join(tails, ["file", "block"]).withColumn("key", key).groupBy("file", "key")
            .agg(F.array_sort(F.collect_list(F.struct("block", "no", "value"))).alias("of"))
            .select("file", F.array_join(F.transform("of", lambda line: line["value"]), "\n").alias("record"),
                    (F.col("key.block") == -1).alias("first")))


def read_delimited_records(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, sep: str = ";",
                           header: bool = True, decimal_comma: Sequence[str] = (),
                           scratch: Scratch | None = None) -> DataFrame:
    """``delimited.read_delimited(multi_line=True)`` with a schema, by several tasks a file.

    Quotes inside values are doubled. Blank lines outside values are left out, as a
    carriage return before a record's line end is.
    """
    scratch = scratch or Scratch(spark, "records", until_exit=True)
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    found = records(spark, path, quotes, value.rlike(BLANK), F.lit(True), F.lit(False), scratch)
    if header:
        found = found.where(~F.col("first"))
    read = text_schema(schema, decimal_comma)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.fields)
    options = {"sep": sep, "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = found.select(F.from_csv(F.regexp_replace("record", r"\r$", ""), ddl, options).alias("_row"))
    return parse_decimal_commas(parsed.select("_row.*"), decimal_comma)


def sql_statements(spark: SparkSession, path: str | Sequence[str], scratch: Scratch | None = None) -> DataFrame:
    """The statements of a dump, one row each (column ``value``), however many lines they span.

    Blank lines and comment lines (``--``, ``#``) between and inside statements are left out
    where no value is open. A line that begins with INSERT INTO outside a value starts a
    statement, whether or not the one before has its ``;``. Quotes of comment lines are not
    counted, so neither are those of a line inside a value that begins like a comment.
    """
    scratch = scratch or Scratch(spark, "statements", until_exit=True)
    value = F.col("value")
    plain = F.regexp_replace(value, r"\\.", "")                     # without escaped characters
    quotes = F.when(value.rlike(SQL_COMMENT), 0).otherwise(
        F.length(plain) - F.length(F.replace(plain, F.lit("'"), F.lit(""))))
    found = records(spark, path, quotes, value.rlike(BLANK) | value.rlike(SQL_COMMENT), value.rlike(SQL_END),
                    value.rlike(SQL_START), scratch)
    return found.select(F.col("record").alias("value"))
