"""The three gold marts: one filtered join, a delta, a weighted score, a rank.

``ongoing_base`` builds the join once with every column any mart needs; each
mart is then a projection of it. Called separately, Catalyst prunes the unused
columns below the join; in the batch run the base is written once and the three
marts read it (one join instead of three).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.columns import delta, weighted_score
from riskmart.operators.joins import spread_join
from riskmart.operators.ranking import desc, global_rank

# Output column names and orders of the gold tables, and the
# score weights, as the reference defines them.
HUMANITARIAN_COLUMNS = [
    "id", "name_of_war", "region", "type_of_war", "start_year", "primary_country",
    "status", "poverty_change_pct", "extreme_poverty_rate_pct", "food_insecurity_rate_pct",
    "households_fallen_into_poverty_estimate",
]
GOVERNMENT_COLUMNS = [
    "id", "name_of_war", "type_of_war", "region", "start_year", "primary_country",
    "most_affected_sector", "currency_black_market_rate_gap_pct", "status",
    "unemployment_change_pct", "youth_unemployment_change_pct", "gdp_change_pct",
    "inflation_rate_change_pct", "currency_devaluation_pct",
]
FINANCE_COLUMNS = [
    "id", "name_of_war", "type_of_war", "region", "start_year", "primary_country",
    "most_affected_sector", "black_market_activity_level",
    "currency_black_market_rate_gap_pct", "primary_black_market_goods", "status",
    "unemployment_change_pct", "youth_unemployment_change_pct", "gdp_change_pct",
    "inflation_rate_change_pct", "currency_devaluation_pct",
]
# crisis_score = -gdp*0.3 + unemployment change*0.2 + inflation*0.2
#                + devaluation*0.2 + black-market rate gap*0.1
CRISIS_WEIGHTS = [
    ("-gdp_change_pct", 0.3), ("unemployment_change_pct", 0.2),
    ("inflation_rate_change_pct", 0.2), ("currency_devaluation_pct", 0.2),
    ("currency_black_market_rate_gap_pct", 0.1),
]
# risk_score = gap*0.3 + devaluation*0.3 - gdp*0.2 + inflation*0.2
RISK_WEIGHTS = [
    ("currency_black_market_rate_gap_pct", 0.3), ("currency_devaluation_pct", 0.3),
    ("-gdp_change_pct", 0.2), ("inflation_rate_change_pct", 0.2),
]
HUMANITARIAN_ORDER = desc("extreme_poverty_rate_pct", "food_insecurity_rate_pct")


def _terms(weights):
    return [(-F.col(c[1:]) if c.startswith("-") else F.col(c), w) for c, w in weights]


def ongoing_base(war: DataFrame, economics: DataFrame, status: str = "Ongoing", spread: bool = False) -> DataFrame:
    """Curated war ⋈ curated economics on ``id`` for one status, all mart inputs.

    The status filter sits on the economics side below the join, so it reaches
    the Parquet scan as a pushed filter. ``spread`` is for ids that repeat many times on
    both sides: a sketch of each finds them, and the join spreads them.
    """
    econ = economics.filter(F.col("status") == F.lit(status)).select(
        "id", "status",
        delta("during_war_poverty_rate_pct", "prewar_poverty_rate_pct").alias("poverty_change_pct"),
        "extreme_poverty_rate_pct", "food_insecurity_rate_pct",
        "households_fallen_into_poverty_estimate",
        delta("during_war_unemployment_pct", "prewar_unemployment_pct")
        .alias("unemployment_change_pct"),
        "youth_unemployment_change_pct", "gdp_change_pct", "inflation_rate_change_pct",
        "currency_devaluation_pct")
    w = war.select(
        "id", F.col("name").alias("name_of_war"), F.col("type").alias("type_of_war"),
        "region", "start_year", "primary_country", "most_affected_sector",
        "black_market_activity_level", "currency_black_market_rate_gap_pct",
        "primary_black_market_goods")
    # Inner equi-join, key once and first (left columns, then right).
    return spread_join(w, econ, "id") if spread else w.join(econ, on="id", how="inner")


def ongoing_base_sql(spark: SparkSession, war_table: str, economics_table: str,
                     status: str = "Ongoing") -> DataFrame:
    """``ongoing_base`` written as SQL text over catalog tables or views (SQL surface).

    The status is a bound parameter, not spliced into the text; table names are
    identifiers the caller controls. Catalyst plans it exactly like the DataFrame
    version (filter pushed to the scan, columns pruned).
    """
    return spark.sql(f"""
        SELECT w.id, w.name AS name_of_war, w.type AS type_of_war, w.region, w.start_year,
               w.primary_country, w.most_affected_sector, w.black_market_activity_level,
               w.currency_black_market_rate_gap_pct, w.primary_black_market_goods,
               e.status,
               e.during_war_poverty_rate_pct - e.prewar_poverty_rate_pct AS poverty_change_pct,
               e.extreme_poverty_rate_pct, e.food_insecurity_rate_pct,
               e.households_fallen_into_poverty_estimate,
               e.during_war_unemployment_pct - e.prewar_unemployment_pct
                 AS unemployment_change_pct,
               e.youth_unemployment_change_pct, e.gdp_change_pct, e.inflation_rate_change_pct,
               e.currency_devaluation_pct
        FROM {war_table} w JOIN {economics_table} e ON w.id = e.id
        WHERE e.status = :status""", args={"status": status})


def humanitarian_scored(base: DataFrame) -> DataFrame:
    return base.select(*HUMANITARIAN_COLUMNS)


def government_scored(base: DataFrame) -> DataFrame:
    return base.select(*GOVERNMENT_COLUMNS).withColumn(
        "crisis_score", weighted_score(_terms(CRISIS_WEIGHTS)))


def finance_scored(base: DataFrame) -> DataFrame:
    return base.select(*FINANCE_COLUMNS).withColumn(
        "risk_score", weighted_score(_terms(RISK_WEIGHTS)))


def humanitarian_from_base(base: DataFrame, rank_strategy: str = "buckets", **how) -> DataFrame:
    """``how`` goes to ``global_rank`` (``position``, ``buckets``), here and below."""
    return global_rank(humanitarian_scored(base), HUMANITARIAN_ORDER, strategy=rank_strategy, **how)


def government_from_base(base: DataFrame, rank_strategy: str = "buckets", **how) -> DataFrame:
    return global_rank(government_scored(base), desc("crisis_score"), strategy=rank_strategy, **how)


def finance_from_base(base: DataFrame, rank_strategy: str = "buckets", **how) -> DataFrame:
    return global_rank(finance_scored(base), desc("risk_score"), strategy=rank_strategy, **how)


def humanitarian(war: DataFrame, economics: DataFrame, status: str = "Ongoing",
                 rank_strategy: str = "buckets", **how) -> DataFrame:
    return humanitarian_from_base(ongoing_base(war, economics, status), rank_strategy, **how)


def government(war: DataFrame, economics: DataFrame, status: str = "Ongoing",
               rank_strategy: str = "buckets", **how) -> DataFrame:
    return government_from_base(ongoing_base(war, economics, status), rank_strategy, **how)


def finance(war: DataFrame, economics: DataFrame, status: str = "Ongoing",
            rank_strategy: str = "buckets", **how) -> DataFrame:
    return finance_from_base(ongoing_base(war, economics, status), rank_strategy, **how)


MARTS = {
    "humanitarian": humanitarian_from_base,
    "government": government_from_base,
    "finance": finance_from_base,
}
