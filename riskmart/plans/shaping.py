"""Shape the driver's TPC-H-like tables into war-like and economics-like tables.

The real source files of the conflict data are not available, so the curated
inputs of the marts are derived from ``orders``/``customer``/``nation``/``region``
(one war row per order) and ``lineitem`` (economics figures per order). The
same shaping is written as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.plans.curate import WAR_SOURCE_SCHEMA, economics_spec, war_spec
from riskmart.sources.dump import ECONOMICS_DUMP_SCHEMA

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def war_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with the curated war columns (golden order)."""
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    # nation (25 rows) and region (5 rows) are fixed-size dimension tables:
    # broadcasting them is bounded whatever the scale factor.
    n = F.broadcast(load(spark, sf_dir, "nation"))
    r = F.broadcast(load(spark, sf_dir, "region"))
    acct = F.col("c_acctbal")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("c_name").alias("name"),
                F.col("o_orderpriority").alias("type"),
                F.col("r_name").alias("region"),
                F.year("o_orderdate").cast("int").alias("start_year"),
                (F.year("o_orderdate") + 1).cast("int").alias("end_year"),
                F.col("n_name").alias("primary_country"),
                F.col("c_mktsegment").alias("most_affected_sector"),
                F.col("o_totalprice").alias("cost_of_war_usd"),
                F.when(acct < 0, "Dominant").when(acct < 3000, "Low")
                .when(acct < 7000, "Moderate").otherwise("High")
                .alias("black_market_activity_level"),
                (acct / 100).alias("currency_black_market_rate_gap_pct"),
                F.lower("c_mktsegment").alias("primary_black_market_goods")))


def economics_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has line items, with the curated economics columns."""
    o = load(spark, sf_dir, "orders")
    # Partial (map-side) aggregation first, so the shuffle carries one row per
    # order per task, not every line item.
    l = (load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_quantity").alias("prewar_unemployment_pct"),
        F.max("l_quantity").alias("during_war_unemployment_pct"),
        F.max("l_linenumber").cast("double").alias("youth_unemployment_change_pct"),
        (F.min("l_discount") * 100).alias("prewar_poverty_rate_pct"),
        (F.max("l_discount") * 100).alias("during_war_poverty_rate_pct"),
        (F.max("l_tax") * 100).alias("extreme_poverty_rate_pct"),
        (F.min("l_tax") * 100).alias("food_insecurity_rate_pct"),
        F.count(F.lit(1)).cast("int").alias("households_fallen_into_poverty_estimate"),
        (F.lit(0) - F.max("l_discount") * 100).alias("gdp_change_pct"),
        (F.max("l_extendedprice") / 1000).alias("inflation_rate_change_pct"),
        (F.min("l_extendedprice") / 1000).alias("currency_devaluation_pct")))
    return (o.join(l, o.o_orderkey == l.l_orderkey).select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "O", "Ongoing").otherwise("Resolved").alias("status"),
        "prewar_unemployment_pct", "during_war_unemployment_pct",
        "youth_unemployment_change_pct", "prewar_poverty_rate_pct",
        "during_war_poverty_rate_pct", "extreme_poverty_rate_pct", "food_insecurity_rate_pct",
        "households_fallen_into_poverty_estimate", "gdp_change_pct",
        "inflation_rate_change_pct", "currency_devaluation_pct"))


# The same two shapes as SQL text (runs unchanged in DuckDB and Spark SQL).
WAR_LIKE_SQL = """
SELECT o.o_orderkey AS id, c.c_name AS name, o.o_orderpriority AS type,
       r.r_name AS region,
       CAST(year(o.o_orderdate) AS INT) AS start_year,
       CAST(year(o.o_orderdate) + 1 AS INT) AS end_year,
       n.n_name AS primary_country, c.c_mktsegment AS most_affected_sector,
       o.o_totalprice AS cost_of_war_usd,
       CASE WHEN c.c_acctbal < 0 THEN 'Dominant' WHEN c.c_acctbal < 3000 THEN 'Low'
            WHEN c.c_acctbal < 7000 THEN 'Moderate' ELSE 'High' END AS black_market_activity_level,
       c.c_acctbal / 100 AS currency_black_market_rate_gap_pct,
       lower(c.c_mktsegment) AS primary_black_market_goods
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ECONOMICS_LIKE_SQL = """
SELECT o.o_orderkey AS id,
       CASE WHEN o.o_orderstatus = 'O' THEN 'Ongoing' ELSE 'Resolved' END AS status,
       l.prewar_unemployment_pct, l.during_war_unemployment_pct,
       l.youth_unemployment_change_pct,
       l.prewar_poverty_rate_pct, l.during_war_poverty_rate_pct,
       l.extreme_poverty_rate_pct, l.food_insecurity_rate_pct,
       l.households_fallen_into_poverty_estimate, l.gdp_change_pct,
       l.inflation_rate_change_pct, l.currency_devaluation_pct
FROM orders o JOIN (
  SELECT l_orderkey,
         min(l_quantity) AS prewar_unemployment_pct,
         max(l_quantity) AS during_war_unemployment_pct,
         CAST(max(l_linenumber) AS DOUBLE) AS youth_unemployment_change_pct,
         min(l_discount) * 100 AS prewar_poverty_rate_pct,
         max(l_discount) * 100 AS during_war_poverty_rate_pct,
         max(l_tax) * 100 AS extreme_poverty_rate_pct,
         min(l_tax) * 100 AS food_insecurity_rate_pct,
         CAST(count(*) AS INT) AS households_fallen_into_poverty_estimate,
         0 - max(l_discount) * 100 AS gdp_change_pct,
         max(l_extendedprice) / 1000 AS inflation_rate_change_pct,
         min(l_extendedprice) / 1000 AS currency_devaluation_pct
  FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""


def war_source(war: DataFrame) -> DataFrame:
    """A war-like table under the war source file's column names, in file order."""
    target = {spec.source: spec.target for spec in war_spec()}
    return war.select(*[F.col(target[f.name]).alias(f.name) for f in WAR_SOURCE_SCHEMA])


def economics_source(econ: DataFrame) -> DataFrame:
    """An economics-like table as the dump's columns, in dump order."""
    target = {spec.source: F.col(spec.target) for spec in economics_spec() if spec.target in econ.columns}
    # the columns that curation drops, and those that the economics-like table lacks
    made = {
        "Unemployment_Spike_pp": F.col("during_war_unemployment_pct") - F.col("prewar_unemployment_pct"),
        "Estimated_Reconstruction_Cost_USD": F.col("inflation_rate_change_pct") * 1e9,
        "Informal_Economy_Pre_War_pct": F.col("prewar_poverty_rate_pct"),
        "Informal_Economy_During_War_pct": F.col("during_war_poverty_rate_pct"),
        "War_Profiteering_Documented": F.when(F.col("households_fallen_into_poverty_estimate") > 4, "Yes").otherwise("No"),
    }
    return econ.select(*[(target | made)[f.name].alias(f.name) for f in ECONOMICS_DUMP_SCHEMA])
