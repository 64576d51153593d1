"""Word count (A2): whitespace tokens, case kept, as the classic MapReduce example.

explode + groupBy: the partial aggregation combines counts inside each task
before the shuffle, so a very frequent word costs one row per task, not one
per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the default delimiters of a Java StringTokenizer.
WHITESPACE = r"[ \t\n\r\f]+"


def words(df: DataFrame, column: str = "text") -> DataFrame:
    """One row per token (``word``); empty tokens from leading blanks are dropped."""
    return (df.select(F.explode(F.split(F.col(column), WHITESPACE)).alias("word"))
            .filter(F.col("word") != ""))


def word_count(df: DataFrame, column: str = "text") -> DataFrame:
    """(word, n) over every row of ``column``."""
    return words(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
