from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.operators.paging import page, page_number
from riskmart.plans.layout import read_gold_dir, read_partitioned, write_partitioned


def test_static_overwrite_keeps_last_load_only(spark, tmp_dir):
    df = spark.range(10)
    write_partitioned(df, tmp_dir + "/s", date(2026, 3, 24), "static")
    write_partitioned(df, tmp_dir + "/s", date(2026, 3, 25), "static")
    days = {r.day for r in read_partitioned(spark, tmp_dir + "/s").select("day").distinct().collect()}
    assert days == {25}


def test_dynamic_overwrite_keeps_other_days(spark, tmp_dir):
    df = spark.range(10)
    write_partitioned(df, tmp_dir + "/d", date(2026, 3, 24), "dynamic")
    write_partitioned(df, tmp_dir + "/d", date(2026, 3, 25), "dynamic")
    write_partitioned(df, tmp_dir + "/d", date(2026, 3, 25), "dynamic")
    counts = {r.day: r["count"] for r in read_partitioned(spark, tmp_dir + "/d").groupBy("day").count().collect()}
    assert counts == {24: 10, 25: 10}


def test_partition_filter_is_pruned(spark, tmp_dir):
    write_partitioned(spark.range(10), tmp_dir + "/p", date(2026, 3, 25))
    df = read_partitioned(spark, tmp_dir + "/p").filter(F.col("day") == 25)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_gold_dir_missing_is_empty(spark, tmp_dir):
    schema = spark.range(1).schema
    assert read_gold_dir(spark, tmp_dir + "/nothing", schema).count() == 0


@pytest.mark.parametrize("raw,expected", [("3", 3), ("0", 1), ("-2", 1), ("x", 1), (None, 1)])
def test_page_number_clamping(raw, expected):
    assert page_number(raw) == expected


def test_pages_cover_table_once(spark):
    from riskmart.operators.ranking import desc, global_rank
    base = spark.createDataFrame([(i, float(i % 4)) for i in range(23)], "id long, v double")
    df = global_rank(base, desc("v"))                    # heavy ties
    rows = [(r.id, r.v, r.rank) for r in df.collect()]
    seen = []
    first = page(df, 1)
    assert (first.total, first.total_pages, first.size) == (23, 5, 5)
    for p in range(1, first.total_pages + 1):
        seen += [(r.rank, r.id) for r in page(df, p).rows.collect()]
    assert seen == sorted((r, i) for i, _, r in rows)
    assert page(df, 6).rows.count() == 0


def test_page_sanitizes_infinities(spark):
    df = spark.createDataFrame([(1, float("inf"), 1), (2, float("nan"), 1)],
                               "id long, v double, rank long")
    assert [r.v for r in page(df, 1).rows.collect()] == [None, None]


def test_deep_page_inside_huge_tie_group(spark):
    from riskmart.operators.paging import page_rows
    from riskmart.operators.ranking import desc, global_rank
    # 30,000 rows, a third share one key; ids are not in rank order.
    base = spark.range(30000).select(
        ((F.col("id") * 7919) % 30000).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(50.0)).otherwise(F.col("id").cast("double")).alias("v"))
    ranked = global_rank(base, desc("v"))
    ordered = [(r.rank, r.id) for r in ranked.orderBy("rank", "id").collect()]
    stored = global_rank(base, desc("v"), position="position").cache()
    for number in (1, 2000, 3333, 3334, 5990, 6000):
        got = [(r.rank, r.id) for r in page_rows(stored, number, 5).collect()]
        assert got == ordered[(number - 1) * 5: number * 5], number


def test_page_mart_by_name(spark, tmp_dir):
    from riskmart.operators.paging import mart_names, page_mart
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pg LOCATION '{tmp_dir}/pg'")
    df = spark.createDataFrame([(i, i + 1) for i in range(12)], "id long, rank long")
    df.write.mode("overwrite").saveAsTable("pg.gold_output_finance")
    assert mart_names(spark, "pg") == ["finance"]
    p = page_mart(spark, "finance", "3", "pg")
    assert (p.total, p.total_pages, [r.id for r in p.rows.collect()]) == (12, 3, [10, 11])
    with pytest.raises(KeyError):
        page_mart(spark, "nope", 1, "pg")


def test_bucketed_curated_tables_join_without_shuffle(spark, tmp_dir):
    from riskmart.operators.marts import ongoing_base
    from riskmart.plans.layout import save_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bk LOCATION '{tmp_dir}/bk'")
    war = spark.range(2000).selectExpr(
        "id", "concat('w', id) AS name", "'t' AS type", "'r' AS region", "2000 AS start_year",
        "'c' AS primary_country", "'s' AS most_affected_sector", "'High' AS black_market_activity_level",
        "1.5D AS currency_black_market_rate_gap_pct", "'g' AS primary_black_market_goods")
    econ = spark.range(2000).selectExpr(
        "id", "IF(id % 2 = 0, 'Ongoing', 'Resolved') AS status", "1.0D AS prewar_unemployment_pct",
        "2.0D AS during_war_unemployment_pct", "3.0D AS youth_unemployment_change_pct",
        "4.0D AS prewar_poverty_rate_pct", "5.0D AS during_war_poverty_rate_pct",
        "6.0D AS extreme_poverty_rate_pct", "7.0D AS food_insecurity_rate_pct",
        "8 AS households_fallen_into_poverty_estimate", "-9.0D AS gdp_change_pct",
        "10.0D AS inflation_rate_change_pct", "11.0D AS currency_devaluation_pct")
    save_table(war, "bk.war_curated", bucket_by=(8, "id"))
    save_table(econ, "bk.economics_curated", bucket_by=(8, "id"))
    with_autobroadcast_off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = ongoing_base(spark.table("bk.war_curated"), spark.table("bk.economics_curated"))
        plan = base._jdf.queryExecution().executedPlan().toString()
        assert base.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_autobroadcast_off)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_gold_dir_empty_is_empty(spark, tmp_dir):
    import os
    os.makedirs(tmp_dir + "/empty")
    schema = spark.range(1).schema
    assert read_gold_dir(spark, tmp_dir + "/empty", schema).count() == 0


def test_fixed_file_count(spark, tmp_dir):
    import glob
    write_partitioned(spark.range(1000), tmp_dir + "/n", date(2026, 3, 25), num_files=4)
    files = glob.glob(tmp_dir + "/n/year=2026/month=3/day=25/*.parquet")
    assert len(files) == 4
    assert read_partitioned(spark, tmp_dir + "/n").count() == 1000


def test_deep_page_with_string_tiebreak(spark):
    from riskmart.operators.paging import page_rows
    from riskmart.operators.ranking import desc, global_rank
    base = spark.range(30000).select(
        F.concat(F.lit("k"), F.lpad(((F.col("id") * 7919) % 30000).cast("string"), 6, "0")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(50.0)).otherwise(F.col("id").cast("double")).alias("v"))
    ranked = global_rank(base, desc("v"))
    ordered = [(r.rank, r.id) for r in ranked.orderBy("rank", "id").collect()]
    stored = global_rank(base, desc("v"), position="position").cache()
    for number in (3334, 5000, 5990, 6000, 6001):
        got = [(r.rank, r.id) for r in page_rows(stored, number, 5).collect()]
        assert got == ordered[(number - 1) * 5: number * 5], number


def test_pages_with_repeated_ids_cover_table_once(spark):
    from riskmart.operators.ranking import desc, global_rank
    rows = [(i % 7, float(i % 2), i) for i in range(60)] + [(3, 1.0, 99)] * 4
    base = spark.createDataFrame(rows, "id long, v double, n long")
    for df in (global_rank(base, desc("v")), global_rank(base, desc("v"), position="position").cache()):
        seen = [tuple(r)[:3] for p in range(1, 14) for r in page(df, p).rows.collect()]
        assert len(seen) == 64 and sorted(seen) == sorted(rows)


def test_page_filter_reaches_the_scan(spark, tmp_dir):
    from riskmart.operators.paging import page_rows
    from riskmart.operators.ranking import desc, global_rank
    base = spark.range(1000).select("id", (F.col("id") % 4).alias("v"))
    global_rank(base, desc("v"), position="position").sortWithinPartitions("position").write.parquet(tmp_dir + "/g")
    plan = page_rows(spark.read.parquet(tmp_dir + "/g"), 9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(position,41)" in plan and "LessThanOrEqual(position,45)" in plan


def test_backfill_write_clusters_by_day(spark, tmp_dir):
    import glob
    df = spark.range(6000).select(
        "id", F.lit(2026).alias("year"), F.lit(3).alias("month"),
        (F.col("id") % 30 + 1).cast("int").alias("day")).repartition(8)
    write_partitioned(df, tmp_dir + "/bf")          # no as_of: values come from the data
    days = glob.glob(tmp_dir + "/bf/year=2026/month=3/day=*")
    assert len(days) == 30
    # Clustered first: each day is written by few tasks, not by all 8 input tasks.
    assert max(len(glob.glob(d + "/*.parquet")) for d in days) <= 2
    assert read_partitioned(spark, tmp_dir + "/bf").count() == 6000


def test_page_body_is_json_ready(spark):
    import json
    df = spark.createDataFrame([(1, float("inf"), 1), (2, 2.5, 2)], "id long, v double, rank long")
    body = page(df, "1").to_dict()
    assert json.loads(json.dumps(body)) == {
        "page": 1, "page_size": 5, "total": 2, "total_pages": 1,
        "data": [{"id": 1, "v": None, "rank": 1}, {"id": 2, "v": 2.5, "rank": 2}]}
