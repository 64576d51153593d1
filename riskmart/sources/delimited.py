"""Delimited text sources (S1, S2): ``;``- or ``,``-separated files with a header.

At scale pass a ``schema``: inference reads the whole input once more. Columns
listed in ``decimal_comma`` are read as text and parsed as locale numbers
(``1,06957E+11`` → 106957000000.0), which inference cannot do.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.columns import parse_locale_double


def text_schema(schema: T.StructType, decimal_comma: Sequence[str]) -> T.StructType:
    """``schema`` with the decimal-comma columns read as text (parsed afterwards)."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) if f.name in decimal_comma
                         else f for f in schema.fields])


def parse_decimal_commas(df: DataFrame, decimal_comma: Sequence[str]) -> DataFrame:
    """Turn the listed text columns into doubles (decimal comma or point)."""
    if not decimal_comma:
        return df
    return df.select(*[
        parse_locale_double(F.col(f"`{c}`")).alias(c) if c in decimal_comma else F.col(f"`{c}`")
        for c in df.columns])


def read_delimited(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType | None = None, sep: str = ";", header: bool = True,
                   decimal_comma: Sequence[str] = (), infer: bool = True,
                   corrupt_column: str | None = None, multi_line: bool = False) -> DataFrame:
    """Read a delimited file set; decimal-comma columns come out as double.

    With ``corrupt_column`` (and a schema), a line whose values do not fit the
    schema keeps its row (unfit values null) and its raw text in that column.
    ``multi_line`` reads quoted values with line breaks; a file is then one task.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("escape", '"')
    if multi_line:
        reader = reader.option("multiLine", True)
    if schema is not None:
        read_schema = text_schema(schema, decimal_comma)
        if corrupt_column:
            read_schema = read_schema.add(corrupt_column, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        df = reader.schema(read_schema).csv(path)
    else:
        df = reader.option("inferSchema", infer).csv(path)
    return parse_decimal_commas(df, decimal_comma)


def write_delimited(df: DataFrame, path: str, sep: str = ";",
                    decimal_comma: Sequence[str] = ()) -> None:
    """Write a header + delimited file set; listed double columns use a decimal comma.

    Text is written as it is: blanks kept, quotes doubled, values with line breaks quoted
    (read those back with ``multi_line``).
    """
    out = df.select(*[
        F.translate(F.col(f"`{c}`").cast("string"), ".", ",").alias(c)
        if c in decimal_comma else F.col(f"`{c}`") for c in df.columns])
    (out.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
