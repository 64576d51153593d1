"""Raw → curated → gold (M4): the three batch stages as plain Spark jobs.

* ``ingest``: the ``;`` war file and the INSERT dump → Parquet partitioned by
  load date. The dump is parsed once and written once: accepted rows and
  rejects land in the same job under ``outcome=accepted|rejected``.
* ``curate``: the load date's raw partition → typed, renamed managed tables.
* ``build_marts``: the ``Ongoing`` join is written once, then the three marts
  are projected from it, ranked, and written below the run's own id; one new
  file publishes all three (``runs``), and the external tables follow it.

Every write is observed (row counts come with the write, not a second scan).
Independent jobs (the two ingests, the two curations, the three marts) are
submitted from threads so the scheduler can run them side by side.
The load date is an argument, never the wall clock of a later stage.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators import marts
from riskmart.operators.metrics import StageMetrics
from riskmart.operators.paging import MART_TABLES, PATH_PROPERTY, POSITION, ROWS_PROPERTY, write_manifest
from riskmart.plans import runs
from riskmart.plans.curate import WAR_SOURCE_SCHEMA, curate_economics, curate_war
from riskmart.plans.layout import (DATE_PARTS, last_partition, publish_table, read_partitioned, save_table,
                                   with_load_date, write_partitioned)
from riskmart.sources.delimited import read_delimited
from riskmart.sources.dump import ECONOMICS_DUMP_SCHEMA, parse_insert_dump


@dataclass
class Paths:
    """Where each zone lives (all on shared storage)."""

    root: str

    @property
    def raw_war(self) -> str:
        return f"{self.root}/raw/war_partitioned"

    @property
    def raw_economics_ingest(self) -> str:
        return f"{self.root}/raw/economics_ingest"

    @property
    def raw_economics(self) -> str:
        return f"{self.raw_economics_ingest}/outcome=accepted"

    @property
    def rejected_economics(self) -> str:
        return f"{self.raw_economics_ingest}/outcome=rejected"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def ongoing_base(self, run: str) -> str:
        return f"{runs.run_root(self.gold, run)}/ongoing_base"

    def mart(self, run: str, mart: str) -> str:
        return f"{runs.run_root(self.gold, run)}/gold_output_{mart}"


@dataclass
class RunResult:
    tables: dict[str, DataFrame]
    metrics: StageMetrics = field(default_factory=StageMetrics)


def _on_date(df: DataFrame, as_of: date) -> DataFrame:
    return df.filter((F.col("year") == as_of.year) & (F.col("month") == as_of.month)
                     & (F.col("day") == as_of.day))


def in_parallel(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs from threads so the scheduler can overlap them."""
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def ingest(spark: SparkSession, war_path: str, economics_path: str, paths: Paths, as_of: date,
           metrics: StageMetrics, dump_mode: str = "locale", overwrite: str = "static",
           war_schema: T.StructType | None = WAR_SOURCE_SCHEMA) -> None:
    """``war_schema=None`` infers the war file's types as the reference does (one
    extra pass over the file; the decimal-comma cost then stays text)."""
    def war_job():
        if war_schema is None:
            war = metrics.observe(read_delimited(spark, war_path, sep=";", infer=True),
                                  "raw", "war")
            write_partitioned(war, paths.raw_war, as_of, overwrite)
            return
        war = read_delimited(spark, war_path, schema=war_schema, sep=";",
                             corrupt_column="_malformed")
        # Lines whose values do not fit the schema stay (with nulls), as the
        # reference's casts would leave them, but they are counted.
        war = metrics.observe(war, "raw", "war", rows=F.count(F.lit(1)),
                              malformed=F.count_if(F.col("_malformed").isNotNull()))
        write_partitioned(war.drop("_malformed"), paths.raw_war, as_of, overwrite)

    def economics_job():
        parsed = parse_insert_dump(spark.read.text(economics_path), ECONOMICS_DUMP_SCHEMA,
                                   dump_mode)
        ok = F.col("reject_reason").isNull()
        parsed = parsed.select(
            *[f"`{f.name}`" for f in ECONOMICS_DUMP_SCHEMA.fields],
            F.when(~ok, F.col("line")).alias("line"),
            F.when(~ok, F.col("tuple_no")).alias("tuple_no"), "reject_reason",
            F.when(ok, "accepted").otherwise("rejected").alias("outcome"))
        parsed = metrics.observe(parsed, "raw", "economics",
                                 rows=F.count_if(ok), rejected=F.count_if(~ok))
        write_partitioned(parsed, paths.raw_economics_ingest, as_of, overwrite,
                          partition_by=("outcome", *DATE_PARTS))

    in_parallel(war_job, economics_job)


def curate(spark: SparkSession, paths: Paths, as_of: date, metrics: StageMetrics,
           database: str = "default", id_type: str = "bigint",
           bucket_by: tuple[int, str] | None = None, overwrite: str = "static") -> dict[str, DataFrame]:
    if overwrite not in ("static", "dynamic"):
        raise ValueError(f"unknown overwrite mode {overwrite!r}")
    kept = dict(zip(DATE_PARTS, (as_of.year, as_of.month, as_of.day))) if overwrite == "dynamic" else None

    def job(table, raw_path, fn):
        raw = read_partitioned(spark, raw_path, as_of=as_of)           # lists that day only
        curated = with_load_date(fn(raw, id_type), as_of)
        name = f"{database}.{table}"
        # Managed table (lives under the database location), as the reference has it.
        save_table(metrics.observe(curated, "curated", table), name,
                   partition_by=DATE_PARTS, bucket_by=bucket_by, replace=kept)
        return table, spark.table(name)

    specs = (("war_curated", paths.raw_war, curate_war),
             ("economics_curated", paths.raw_economics, curate_economics))
    tables = dict(in_parallel(*[lambda spec=spec: job(*spec) for spec in specs]))
    if bucket_by is not None:            # bucketing shuffles after the count: take it from the files' footers
        for table, df in tables.items():
            metrics.settle("curated", table, _on_date(df, as_of).count())
    return tables


def latest_load(spark: SparkSession, table: str) -> date | None:
    """The last load date of a curated table, from the catalog's list of partitions."""
    return last_partition(spark, table)


def published_marts(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """The three marts of the published run, all of one run whatever is published meanwhile."""
    root = runs.published(spark, paths.gold)
    if root is None:
        return {}
    return {table: spark.read.parquet(f"{root}/{table}").drop(POSITION) for table in MART_TABLES.values()}


def _follow(spark: SparkSession, paths: Paths, database: str) -> None:
    """Point the catalog's gold tables at the published run; again if another was published meanwhile."""
    seen = None
    while (now := runs.history(spark, paths.gold)) != seen:
        seen = now
        for mart, table in MART_TABLES.items():
            path = paths.mart(seen[0], mart)
            rows = spark.read.parquet(path).count()                   # from the files' footers
            publish_table(spark, f"{database}.{table}", path, {ROWS_PROPERTY: str(rows), PATH_PROPERTY: path})


def build_marts(spark: SparkSession, paths: Paths, metrics: StageMetrics,
                database: str = "default", status: str = "Ongoing",
                rank_strategy: str = "buckets", as_of: date | None = None) -> dict[str, DataFrame]:
    """The marts of one load date (the curated war table's last one by default).

    Gold tables store the page position besides the mart's columns; the frames
    returned, which read this run's own files, leave it out.
    """
    war = spark.table(f"{database}.war_curated")
    economics = spark.table(f"{database}.economics_curated")
    as_of = as_of or latest_load(spark, f"{database}.war_curated")
    if as_of is not None:
        war, economics = _on_date(war, as_of), _on_date(economics, as_of)
    run = runs.new_run()
    # One join for all three marts, written once (lineage cut, shared input).
    base = metrics.observe(marts.ongoing_base(war, economics, status), "gold", "ongoing_base")
    base.write.parquet(paths.ongoing_base(run))
    base = spark.read.schema(base.schema).parquet(paths.ongoing_base(run))

    def job(mart, build):
        # Each file sorted by position, as the ranked rows are: a page read opens one file
        # and skips its row groups of other positions.
        df = build(base, rank_strategy, position=POSITION, stored=True)
        path = paths.mart(run, mart)
        metrics.observe(df, "gold", f"gold_output_{mart}").write.parquet(path)
        write_manifest(spark, path)
        return f"gold_output_{mart}", spark.read.schema(df.schema).parquet(path).drop(POSITION)

    # The three marts only share the stored base: build them side by side.
    built = dict(in_parallel(*[lambda m=m, b=b: job(m, b) for m, b in marts.MARTS.items()]))
    runs.publish(spark, paths.gold, run)
    _follow(spark, paths, database)
    return built


def run_all(spark: SparkSession, war_path: str, economics_path: str, root: str, as_of: date,
            database: str = "default", dump_mode: str = "locale", id_type: str = "bigint",
            rank_strategy: str = "buckets", bucket_by: tuple[int, str] | None = None,
            war_schema: T.StructType | None = WAR_SOURCE_SCHEMA, overwrite: str = "static") -> RunResult:
    """All three stages; returns the catalog tables and the observed counts.

    ``overwrite="dynamic"`` keeps the other load dates of the raw zone and the
    curated tables; the marts are those of ``as_of``.
    """
    paths = Paths(root)
    metrics = StageMetrics()
    ingest(spark, war_path, economics_path, paths, as_of, metrics, dump_mode, overwrite, war_schema)
    tables = curate(spark, paths, as_of, metrics, database, id_type, bucket_by, overwrite)
    tables.update(build_marts(spark, paths, metrics, database, rank_strategy=rank_strategy, as_of=as_of))
    metrics.collect()
    return RunResult(tables, metrics)
