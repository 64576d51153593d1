"""Gold runs, the page manifest, and direct addressing of a load date."""

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import functions as F

from riskmart.operators.metrics import StageMetrics
from riskmart.operators.paging import MART_TABLES, PATH_PROPERTY, manifest_page, page_mart, write_manifest
from riskmart.operators.ranking import desc, global_rank
from riskmart.plans import runs, stages
from riskmart.plans.layout import last_partition, read_partitioned, save_table, with_load_date, write_partitioned

DAY = date(2026, 3, 25)


def _curated(spark, db, n, directory):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{directory}/{db}'")
    war = spark.range(n).selectExpr(
        "id", "concat('w', id) AS name", "'t' AS type", "'r' AS region", "2000 AS start_year",
        "'c' AS primary_country", "'s' AS most_affected_sector", "'High' AS black_market_activity_level",
        "CAST(id % 50 AS DOUBLE) AS currency_black_market_rate_gap_pct", "'g' AS primary_black_market_goods")
    econ = spark.range(n).selectExpr(
        "id", "'Ongoing' AS status", "1.0D AS prewar_unemployment_pct", "CAST(id % 7 AS DOUBLE) AS during_war_unemployment_pct",
        "3.0D AS youth_unemployment_change_pct", "4.0D AS prewar_poverty_rate_pct", "5.0D AS during_war_poverty_rate_pct",
        "6.0D AS extreme_poverty_rate_pct", "7.0D AS food_insecurity_rate_pct", "8 AS households_fallen_into_poverty_estimate",
        "CAST(-(id % 11) AS DOUBLE) AS gdp_change_pct", "10.0D AS inflation_rate_change_pct", "11.0D AS currency_devaluation_pct")
    for df, table in ((war, "war_curated"), (econ, "economics_curated")):
        save_table(with_load_date(df, DAY), f"{db}.{table}", partition_by=("year", "month", "day"))


def test_two_runs_at_once(spark, tmp_dir):
    """Each run returns its own marts; the published three, and the catalog's, are all of one of them."""
    paths = stages.Paths(tmp_dir + "/zones")
    _curated(spark, "runs_a", 300, tmp_dir)
    _curated(spark, "runs_b", 500, tmp_dir)
    with ThreadPoolExecutor(2) as pool:
        a, b = [pool.submit(stages.build_marts, spark, paths, StageMetrics(), db) for db in ("runs_a", "runs_b")]
        a, b = a.result(), b.result()
    assert {t: df.count() for t, df in a.items()} == {t: 300 for t in MART_TABLES.values()}
    assert {t: df.count() for t, df in b.items()} == {t: 500 for t in MART_TABLES.values()}
    counts = {t: df.count() for t, df in stages.published_marts(spark, paths).items()}
    assert set(counts) == set(MART_TABLES.values()) and len(set(counts.values())) == 1
    assert len(runs.history(spark, paths.gold)) in (1, 2)


def test_published_run_and_catalog(spark, tmp_dir):
    paths = stages.Paths(tmp_dir + "/zones")
    assert stages.published_marts(spark, paths) == {}
    _curated(spark, "runs_c", 40, tmp_dir)
    roots = []
    for _ in range(3):
        stages.build_marts(spark, paths, StageMetrics(), "runs_c")
        roots.append(runs.published(spark, paths.gold))
    assert len(set(roots)) == 3 and runs.history(spark, paths.gold) == [r.rsplit("/", 1)[1] for r in reversed(roots[1:])]
    assert sorted(os.listdir(f"{paths.gold}/runs")) == sorted(r.rsplit("/", 1)[1] for r in roots[1:])     # the first is gone
    for table in MART_TABLES.values():
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES runs_c.{table}").collect()}
        assert properties[PATH_PROPERTY] == f"{roots[2]}/{table}"
        assert spark.table(f"runs_c.{table}").count() == 40
    p = page_mart(spark, "finance", 8, "runs_c")
    assert (p.total, p.total_pages, p.rows.count()) == (40, 8, 5)


def test_a_run_that_fails_is_not_published(spark, tmp_dir, monkeypatch):
    paths = stages.Paths(tmp_dir + "/zones")
    _curated(spark, "runs_d", 30, tmp_dir)
    stages.build_marts(spark, paths, StageMetrics(), "runs_d")
    before = runs.history(spark, paths.gold)

    def broken(*args, **how):
        raise RuntimeError("no finance mart")
    monkeypatch.setitem(stages.marts.MARTS, "finance", broken)
    try:
        stages.build_marts(spark, paths, StageMetrics(), "runs_d")
    except RuntimeError:
        pass
    assert runs.history(spark, paths.gold) == before
    assert {df.count() for df in stages.published_marts(spark, paths).values()} == {30}


def test_a_page_opens_the_file_that_holds_it(spark, tmp_dir):
    base = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("id"), (F.col("id") % 13).cast("double").alias("v"))
    ranked = global_rank(base, desc("v"), position="position", buckets=16)
    path = tmp_dir + "/mart"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # small tables would be one file
    try:
        ranked.sortWithinPartitions("position").write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    write_manifest(spark, path)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) > 4
    ordered = [(r.rank, r.id) for r in ranked.orderBy("rank", "id").collect()]
    for number in (1, 2, 333, 999, 1000):
        p = manifest_page(spark, path, str(number))
        assert (p.total, p.total_pages) == (5000, 1000)
        assert len(p.rows.inputFiles()) <= 2
        assert [(r.rank, r.id) for r in p.rows.collect()] == ordered[(number - 1) * 5:number * 5]
    opened = [len(manifest_page(spark, path, n).rows.inputFiles()) for n in range(1, 60)]
    assert opened.count(1) >= 55                         # two only where a page crosses a border
    past = manifest_page(spark, path, 1001)
    assert past.rows.count() == 0 and past.total_pages == 1000


def test_manifest_of_an_empty_mart(spark, tmp_dir):
    empty = spark.createDataFrame([], "id long, v double, rank long, position long")
    empty.write.parquet(tmp_dir + "/empty")
    write_manifest(spark, tmp_dir + "/empty")
    p = manifest_page(spark, tmp_dir + "/empty", 1)
    assert (p.total, p.total_pages, p.rows.count()) == (0, 1, 0)


def test_one_load_date_lists_no_other(spark, tmp_dir):
    for day in (24, 25, 26):
        write_partitioned(spark.range(day), tmp_dir + "/raw", date(2026, 3, day), "dynamic")
    os.makedirs(tmp_dir + "/raw/year=2026/month=3/day=oops")               # a listing of all days would make day a string
    spark.range(1).write.mode("overwrite").parquet(tmp_dir + "/raw/year=2026/month=3/day=oops")
    df = read_partitioned(spark, tmp_dir + "/raw", as_of=DAY)
    assert dict(df.dtypes)["day"] == "int"
    assert df.columns == ["id", "year", "month", "day"]
    assert [tuple(r) for r in df.select("year", "month", "day").distinct().collect()] == [(2026, 3, 25)] and df.count() == 25
    assert all("/year=2026/month=3/day=25/" in f for f in df.inputFiles())
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in scan
    write_partitioned(spark.range(3), tmp_dir + "/other", DAY)
    assert read_partitioned(spark, tmp_dir + "/other", as_of=date(2026, 4, 1)).count() == 0


def test_last_load_comes_from_the_catalog(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lastp LOCATION '{tmp_dir}/lastp'")
    rows = spark.createDataFrame([(1, 2025, 12, 31), (2, 2026, 2, 9), (3, 2026, 2, 10)], "id long, year int, month int, day int")
    save_table(rows, "lastp.t", partition_by=("year", "month", "day"))
    assert last_partition(spark, "lastp.t") == date(2026, 2, 10)
