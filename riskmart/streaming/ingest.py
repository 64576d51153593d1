"""The raw ingest as an incremental file stream (Structured Streaming).

When source files keep arriving in a directory, the same delimited read →
load-date columns → partitioned Parquet runs as a file stream: each run picks up
only the files not yet seen (tracked in the checkpoint), and ``availableNow``
processes them in bounded micro-batches, then stops. The file sink commits
through its own log, so a failed batch is redone without duplicates.
"""

from __future__ import annotations

from datetime import date
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskmart.plans.layout import DATE_PARTS, with_load_date
from riskmart.sources.delimited import parse_decimal_commas, text_schema


def delimited_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sep: str = ";",
                     decimal_comma: Sequence[str] = (), max_files_per_trigger: int = 1000) -> DataFrame:
    """A streaming DataFrame over the delimited files of a directory (schema required).

    Same parsing as the batch ``read_delimited``.
    """
    df = (spark.readStream.schema(text_schema(schema, decimal_comma)).option("header", True)
          .option("sep", sep).option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir))
    return parse_decimal_commas(df, decimal_comma)


def ingest_available(stream: DataFrame, out_path: str, checkpoint: str, as_of: date,
                     timeout_s: float | None = None) -> None:
    """Write every file present now to ``out_path`` under the load date, then stop.

    If ``timeout_s`` passes first, the query is stopped and ``TimeoutError`` raised
    (the next run resumes from the checkpoint).
    """
    query = (with_load_date(stream, as_of).writeStream.format("parquet")
             .option("path", out_path).option("checkpointLocation", checkpoint)
             .partitionBy(*DATE_PARTS).trigger(availableNow=True).start())
    finished = query.awaitTermination(timeout_s)
    if timeout_s is not None and not finished:
        query.stop()
        raise TimeoutError(f"ingest into {out_path} did not finish in {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()
