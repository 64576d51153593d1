"""One key holding a third of the rows: results stay whole and exact."""

from pyspark.sql import functions as F

from riskmart.operators.marts import government
from riskmart.operators.metrics import duplicate_keys
from riskmart.operators.ranking import desc, plain_rank
from riskmart.operators.text import word_count


def _war(spark, n):
    # A third of the war rows share id 0 (the join fans out on it).
    return spark.range(n).selectExpr(
        "IF(id < {0}, 0, id) AS id".format(n // 3), "concat('w', id) AS name", "'t' AS type",
        "'r' AS region", "2000 AS start_year", "'c' AS primary_country", "'s' AS most_affected_sector",
        "'High' AS black_market_activity_level", "CAST(id % 50 AS DOUBLE) AS currency_black_market_rate_gap_pct",
        "'g' AS primary_black_market_goods")


def _econ(spark, n):
    return spark.range(n).selectExpr(
        "id", "'Ongoing' AS status", "1.0D AS prewar_unemployment_pct",
        "CAST(id % 7 AS DOUBLE) AS during_war_unemployment_pct", "3.0D AS youth_unemployment_change_pct",
        "4.0D AS prewar_poverty_rate_pct", "5.0D AS during_war_poverty_rate_pct",
        "6.0D AS extreme_poverty_rate_pct", "7.0D AS food_insecurity_rate_pct",
        "8 AS households_fallen_into_poverty_estimate", "CAST(-(id % 11) AS DOUBLE) AS gdp_change_pct",
        "10.0D AS inflation_rate_change_pct", "11.0D AS currency_devaluation_pct")


def test_hot_join_key_fans_out_whole(spark):
    n = 6000
    war, econ = _war(spark, n), _econ(spark, n)
    out = government(war, econ, buckets=24)
    assert out.count() == n                  # every war row joins exactly one economics row
    assert out.filter("id = 0").count() == n // 3
    ranks = {(r.name_of_war): r.rank for r in out.collect()}
    joined = war.withColumnRenamed("name", "name_of_war").join(econ, "id")
    scored = out.drop("rank")
    want = {r.name_of_war: r.rank for r in plain_rank(scored, desc("crisis_score")).collect()}
    assert ranks == want and joined.count() == n
    assert duplicate_keys(war).collect()[0]["n"] == n // 3


def test_hot_word_counted_exactly(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("the the the")).otherwise(
            F.concat(F.lit("the word"), F.col("id").cast("string"))).alias("text"))
    counts = {r.word: r.n for r in word_count(docs).collect()}
    assert counts["the"] == 1000 * 3 + 2000
    assert sum(counts.values()) == 1000 * 3 + 2000 * 2
