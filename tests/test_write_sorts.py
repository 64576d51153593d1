"""Writes of the staged run sort rows no more often than their files need."""

from riskmart.operators.metrics import StageMetrics
from riskmart.operators.paging import MART_TABLES, POSITION
from riskmart.operators.ranking import desc, global_rank
from riskmart.plans import stages
from tests.test_runs import _curated


class _Seen(StageMetrics):
    def observe(self, df, stage, table, **metrics):
        self.__dict__.setdefault("frames", {})[table] = df
        return super().observe(df, stage, table, **metrics)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_rows_are_in_order_of_position_after_one_sort(spark, tmp_dir):
    spark.range(5000).selectExpr("id", "CAST(id % 37 AS DOUBLE) AS score").write.parquet(f"{tmp_dir}/rows")
    ranked = global_rank(spark.read.parquet(f"{tmp_dir}/rows"), desc("score"), position=POSITION, buckets=9, stored=True)
    assert _plan(ranked).count("Sort [") == 1
    ranked.select(POSITION).write.parquet(f"{tmp_dir}/ranked")
    files = spark.read.parquet(f"{tmp_dir}/ranked").selectExpr("_metadata.file_name AS f", "_metadata.row_index AS i", POSITION).collect()
    assert sorted(r[POSITION] for r in files) == list(range(1, 5001))
    for name in {r.f for r in files}:
        at = [r[POSITION] for r in sorted((r for r in files if r.f == name), key=lambda r: r.i)]
        assert at == sorted(at)


def test_marts_are_sorted_once(spark, tmp_dir):
    _curated(spark, "sorts", 60, tmp_dir)
    seen = _Seen()
    stages.build_marts(spark, stages.Paths(f"{tmp_dir}/zones"), seen, "sorts")
    for table in MART_TABLES.values():
        assert _plan(seen.frames[table]).count("Sort [") == 1
