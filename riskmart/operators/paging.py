"""Stable paging over a ranked table.

Page ``p`` of size ``n`` holds the rows at positions ``(p-1)·n+1 … p·n`` of the
table in (rank, id) order; rows that agree in both are ordered by their hash, so
every row has one position and is on one page. Gold tables store the position
(``POSITION``, unique), their files are sorted by it, and a manifest beside them lists
each file's runs of positions. So a page opens the one file (two at a border) that holds
it, and the position filter skips that file's other row groups; the total is a sum over
the manifest. The manifest has a row for each file and rank bucket, not for rows.

A frame without stored positions gets them from the same range-bucket plan that
ranks tables; there is no ordered offset over the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.columns import sanitize_floats
from riskmart.operators.ranking import asc, global_rank

PAGE_SIZE = 5   # fixed value: rows per page, as the reference's API serves them
# The pageable marts by public name → gold table name.
MART_TABLES = {
    "humanitarian": "gold_output_humanitarian",
    "government": "gold_output_government",
    "finance": "gold_output_finance",
}
POSITION = "position"    # gold tables' stored place, 1 to the number of rows
ROWS_PROPERTY = "riskmart.rows"
PATH_PROPERTY = "riskmart.path"    # where the table's files and their manifest are
MANIFEST = "_positions"            # appended to a mart's path


@dataclass
class Page:
    number: int
    size: int
    total: int
    total_pages: int
    rows: DataFrame

    def to_dict(self) -> dict:
        """The page as the reference's API body; only the page's rows reach the driver."""
        return {"page": self.number, "page_size": self.size, "total": self.total,
                "total_pages": self.total_pages,
                "data": [r.asDict(recursive=True) for r in self.rows.limit(self.size).collect()]}


def page_number(raw) -> int:
    """Any input → a page number ≥ 1 (not a number, or below 1 → 1)."""
    try:
        number = int(raw)
    except (TypeError, ValueError):
        return 1
    return max(number, 1)


def with_position(df: DataFrame, order: Sequence[str] = ("rank", "id")) -> DataFrame:
    """``df`` with the unique place of every row in ``order``."""
    return global_rank(df, asc(*order), name="_order", ties=(), position=POSITION).drop("_order")


def page_rows(df: DataFrame, number: int, size: int = PAGE_SIZE,
              order: Sequence[str] = ("rank", "id")) -> DataFrame:
    """The rows of one page, in order."""
    number = page_number(number)
    if POSITION not in df.columns:
        df = with_position(df, order)
    wanted = F.col(POSITION).between((number - 1) * size + 1, number * size)
    return df.where(wanted).orderBy(POSITION).drop(POSITION)


def write_manifest(spark: SparkSession, path: str) -> None:
    """Store the runs of positions of the files at ``path``, which are sorted by position.

    Within a run, the position less the row's index in its file is constant: one aggregate
    over a single column finds the runs.
    """
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.col(POSITION).alias("at"),
                                           (F.col(POSITION) - F.col("_metadata.row_index")).alias("run"))
    runs = rows.groupBy("file", "run").agg(F.min("at").alias("low"), F.max("at").alias("high")).drop("run")
    runs.coalesce(1).write.mode("overwrite").parquet(path + MANIFEST)


def manifest_page(spark: SparkSession, path: str, number, size: int = PAGE_SIZE, sanitize: bool = True) -> Page:
    """A page of the positioned files at ``path`` by their manifest: only the files that hold it are opened."""
    number = page_number(number)
    first, last = (number - 1) * size + 1, number * size
    manifest = spark.read.schema("file string, low long, high long").parquet(path + MANIFEST)
    here = (F.col("low") <= last) & (F.col("high") >= first)
    found = manifest.agg(F.coalesce(F.sum(F.col("high") - F.col("low") + 1), F.lit(0)).alias("total"),
                         F.collect_set(F.when(here, F.col("file"))).alias("files")).head()     # at most a file for each row
    # past the end any one file gives the schema, and the filter no rows
    rows = spark.read.parquet(*([f"{path}/{f}" for f in sorted(found.files)] or [path]))
    rows = page_rows(rows, number, size)
    return Page(number, size, found.total, max(1, math.ceil(found.total / size)), sanitize_floats(rows) if sanitize else rows)


def page(df: DataFrame, number, size: int = PAGE_SIZE, order: Sequence[str] = ("rank", "id"),
         sanitize: bool = True, total: int | None = None) -> Page:
    """One page plus its metadata; past the end gives an empty page. ``total`` spares the count."""
    number = page_number(number)
    total = df.count() if total is None else total
    total_pages = max(1, math.ceil(total / size))
    rows = page_rows(df, number, size, order)
    if sanitize:
        rows = sanitize_floats(rows)
    return Page(number, size, total, total_pages, rows)


def mart_names(spark: SparkSession, database: str = "default") -> list[str]:
    """The marts that exist in ``database`` (the catalog is the endpoint index)."""
    present = {t.name for t in spark.catalog.listTables(database)}
    return [m for m, table in MART_TABLES.items() if table in present]


def page_mart(spark: SparkSession, mart: str, number, database: str = "default",
              size: int = PAGE_SIZE) -> Page:
    """A page of a stored mart by its public name (L2)."""
    if mart not in MART_TABLES:
        raise KeyError(f"unknown mart {mart!r}; expected one of {sorted(MART_TABLES)}")
    name = f"{database}.{MART_TABLES[mart]}"
    stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if PATH_PROPERTY in stored:
        return manifest_page(spark, stored[PATH_PROPERTY], number, size)
    return page(spark.table(name), number, size, total=int(stored[ROWS_PROPERTY]) if ROWS_PROPERTY in stored else None)
