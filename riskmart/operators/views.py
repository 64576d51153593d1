"""Aggregate views over the marts (A3–A5): country crisis, sector exposure, regional need.

The reference names these analyses in prose only; these definitions are ours.
Each is one groupBy with partial aggregation; averages are rounded to 4 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def country_crisis(government: DataFrame) -> DataFrame:
    """Countries by crisis score: conflicts, best rank, highest and mean score."""
    return government.groupBy("primary_country").agg(
        F.count(F.lit(1)).alias("n_conflicts"),
        F.min("rank").alias("best_rank"),
        F.max("crisis_score").alias("max_crisis_score"),
        F.round(F.avg("crisis_score"), 4).alias("avg_crisis_score"))


def sector_exposure(finance: DataFrame) -> DataFrame:
    """Sectors × black-market intensity: conflicts, mean risk, widest rate gap."""
    return finance.groupBy("most_affected_sector", "black_market_activity_level").agg(
        F.count(F.lit(1)).alias("n_conflicts"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
        F.max("currency_black_market_rate_gap_pct").alias("max_rate_gap_pct"))


def regional_need(humanitarian: DataFrame) -> DataFrame:
    """Regions by humanitarian need: poverty change, food insecurity, extreme poverty."""
    return humanitarian.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_conflicts"),
        F.round(F.avg("poverty_change_pct"), 4).alias("avg_poverty_change_pct"),
        F.round(F.avg("food_insecurity_rate_pct"), 4).alias("avg_food_insecurity_rate_pct"),
        F.max("extreme_poverty_rate_pct").alias("max_extreme_poverty_rate_pct"))
