"""Curation (P2–P10): raw source columns → typed, renamed curated columns.

Each step is one ``select`` built from a column-spec list, so the 12/16 renames
and casts are a single Project. Casts are ``try_cast`` (a bad value becomes null
instead of failing the job under ANSI) and the war cost accepts decimal commas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskmart.functions.columns import ColumnSpec, project

# The war source file's columns (``;``-separated, header row).
WAR_SOURCE_SCHEMA = T.StructType([
    T.StructField("Conflict_Id", T.LongType()),
    T.StructField("Conflict_Name", T.StringType()),
    T.StructField("Conflict_Type", T.StringType()),
    T.StructField("Region", T.StringType()),
    T.StructField("Start_Year", T.IntegerType()),
    T.StructField("End_Year", T.IntegerType()),
    T.StructField("Primary_Country", T.StringType()),
    T.StructField("Most_Affected_Sector", T.StringType()),
    T.StructField("Cost_of_War_USD", T.StringType()),
    T.StructField("Black_Market_Activity_Level", T.StringType()),
    T.StructField("Primary_Black_Market_Goods", T.StringType()),
    T.StructField("Currency_Black_Market_Rate_Gap_%", T.DoubleType()),
])
WAR_DECIMAL_COMMA = ("Cost_of_War_USD",)


def war_spec(id_type: str = "bigint") -> list[ColumnSpec]:
    """Curated war columns in the reference's order."""
    return [
        ColumnSpec("Conflict_Name", "name"),
        ColumnSpec("Conflict_Type", "type"),
        ColumnSpec("Region", "region"),
        ColumnSpec("Start_Year", "start_year", "int"),
        ColumnSpec("End_Year", "end_year", "int"),
        ColumnSpec("Primary_Country", "primary_country"),
        ColumnSpec("Most_Affected_Sector", "most_affected_sector"),
        ColumnSpec("Cost_of_War_USD", "cost_of_war_usd", "locale_double"),
        ColumnSpec("Black_Market_Activity_Level", "black_market_activity_level"),
        ColumnSpec("Currency_Black_Market_Rate_Gap_%", "currency_black_market_rate_gap_pct", "double"),
        ColumnSpec("Primary_Black_Market_Goods", "primary_black_market_goods"),
        ColumnSpec("Conflict_Id", "id", id_type),
    ]


def economics_spec(id_type: str = "bigint") -> list[ColumnSpec]:
    """Curated economics columns in the reference's order.

    Unemployment_Spike_pp and Estimated_Reconstruction_Cost_USD are not kept,
    as in the reference.
    """
    return [
        ColumnSpec("Pre_War_Unemployment_pct", "prewar_unemployment_pct", "double"),
        ColumnSpec("During_War_Unemployment_pct", "during_war_unemployment_pct", "double"),
        ColumnSpec("Status", "status"),
        ColumnSpec("Youth_Unemployment_Change_pct", "youth_unemployment_change_pct", "double"),
        ColumnSpec("Pre_War_Poverty_Rate_pct", "prewar_poverty_rate_pct", "double"),
        ColumnSpec("During_War_Poverty_Rate_pct", "during_war_poverty_rate_pct", "double"),
        ColumnSpec("Extreme_Poverty_Rate_pct", "extreme_poverty_rate_pct", "double"),
        ColumnSpec("Food_Insecurity_Rate_pct", "food_insecurity_rate_pct", "double"),
        ColumnSpec("Households_Fallen_Into_Poverty", "households_fallen_into_poverty_estimate", "int"),
        ColumnSpec("GDP_Change_pct", "gdp_change_pct", "double"),
        ColumnSpec("Inflation_Rate_pct", "inflation_rate_change_pct", "double"),
        ColumnSpec("Currency_Devaluation_pct", "currency_devaluation_pct", "double"),
        ColumnSpec("Informal_Economy_Pre_War_pct", "informal_economy_size_pre_war_pct", "double"),
        ColumnSpec("Informal_Economy_During_War_pct", "informal_economy_size_during_war_pct", "double"),
        ColumnSpec("War_Profiteering_Documented", "war_profiteering_documented"),
        ColumnSpec("Conflict_Id", "id", id_type),
    ]


def curate_war(raw: DataFrame, id_type: str = "bigint") -> DataFrame:
    return project(raw, war_spec(id_type))


def curate_economics(raw: DataFrame, id_type: str = "bigint") -> DataFrame:
    return project(raw, economics_spec(id_type))
