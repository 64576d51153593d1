"""Registered queries (Spark) and their DuckDB oracle SQL, by name.

Every query reads the driver's tables in ``sf_dir`` (or files Spark derives
from them) in full. Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions import columns
from riskmart.operators import harmonise, joins, marts, metrics, paging, ranking, text, views
from riskmart.plans import layout, stages
from riskmart.plans.shaping import (ECONOMICS_LIKE_SQL, WAR_LIKE_SQL, economics_like,
                                    economics_source, load, war_like, war_source)
from riskmart.session import scratch_path
from riskmart.sources import dump, feeds
from riskmart.sources.delimited import read_delimited, write_delimited
from riskmart.sources.records import read_delimited_records
from riskmart.streaming import ingest as streaming_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _d(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


# ---------------------------------------------------------------- marts (M1-M3)

_BASE_SQL = f"""
WITH war AS ({WAR_LIKE_SQL}), econ AS ({ECONOMICS_LIKE_SQL}),
base AS (
  SELECT w.id, w.name AS name_of_war, w.type AS type_of_war, w.region, w.start_year,
         w.primary_country, w.most_affected_sector, w.black_market_activity_level,
         w.currency_black_market_rate_gap_pct, w.primary_black_market_goods, e.status,
         e.during_war_poverty_rate_pct - e.prewar_poverty_rate_pct AS poverty_change_pct,
         e.extreme_poverty_rate_pct, e.food_insecurity_rate_pct,
         e.households_fallen_into_poverty_estimate,
         e.during_war_unemployment_pct - e.prewar_unemployment_pct AS unemployment_change_pct,
         e.youth_unemployment_change_pct, e.gdp_change_pct, e.inflation_rate_change_pct,
         e.currency_devaluation_pct
  FROM war w JOIN econ e ON w.id = e.id WHERE e.status = 'Ongoing')
"""

HUMANITARIAN_SQL = _BASE_SQL + f"""
SELECT {', '.join(marts.HUMANITARIAN_COLUMNS)},
       rank() OVER (ORDER BY extreme_poverty_rate_pct DESC NULLS LAST,
                             food_insecurity_rate_pct DESC NULLS LAST) AS rank
FROM base
"""

GOVERNMENT_SCORED_SQL = _BASE_SQL + f""",
scored AS (
  SELECT {', '.join(marts.GOVERNMENT_COLUMNS)},
         (-gdp_change_pct) * {_d(0.3)} + unemployment_change_pct * {_d(0.2)}
         + inflation_rate_change_pct * {_d(0.2)} + currency_devaluation_pct * {_d(0.2)}
         + currency_black_market_rate_gap_pct * {_d(0.1)} AS crisis_score
  FROM base)
"""
GOVERNMENT_SQL = GOVERNMENT_SCORED_SQL + """
SELECT *, rank() OVER (ORDER BY crisis_score DESC NULLS LAST) AS rank FROM scored
"""

FINANCE_SCORED_SQL = _BASE_SQL + f""",
scored AS (
  SELECT {', '.join(marts.FINANCE_COLUMNS)},
         currency_black_market_rate_gap_pct * {_d(0.3)} + currency_devaluation_pct * {_d(0.3)}
         + (-gdp_change_pct) * {_d(0.2)} + inflation_rate_change_pct * {_d(0.2)} AS risk_score
  FROM base)
"""
FINANCE_SQL = FINANCE_SCORED_SQL + """
SELECT *, rank() OVER (ORDER BY risk_score DESC NULLS LAST) AS rank FROM scored
"""


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ongoing_base(war_like(spark, sf_dir), economics_like(spark, sf_dir))


@register("mart_government", GOVERNMENT_SQL)
def mart_government(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.government(war_like(spark, sf_dir), economics_like(spark, sf_dir))


@register("mart_humanitarian", HUMANITARIAN_SQL)
def mart_humanitarian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.humanitarian(war_like(spark, sf_dir), economics_like(spark, sf_dir))


@register("mart_finance", FINANCE_SQL)
def mart_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.finance(war_like(spark, sf_dir), economics_like(spark, sf_dir))


@register("mart_government_distributed", GOVERNMENT_SQL)
def mart_government_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The government mart ranked in many small buckets."""
    return marts.government(war_like(spark, sf_dir), economics_like(spark, sf_dir),
                            buckets=64)


@register("mart_humanitarian_distributed", HUMANITARIAN_SQL)
def mart_humanitarian_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two descending keys with heavy ties, many small buckets."""
    return marts.humanitarian(war_like(spark, sf_dir), economics_like(spark, sf_dir),
                              buckets=64)


@register("mart_finance_distributed", FINANCE_SQL)
def mart_finance_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.finance(war_like(spark, sf_dir), economics_like(spark, sf_dir),
                         buckets=64)


@register("mart_government_sql", GOVERNMENT_SQL)
def mart_government_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The government mart from SQL text over (temporary) catalog views."""
    suffix = uuid.uuid4().hex[:8]
    war_like(spark, sf_dir).createOrReplaceTempView(f"war_curated_{suffix}")
    economics_like(spark, sf_dir).createOrReplaceTempView(f"economics_curated_{suffix}")
    base = marts.ongoing_base_sql(spark, f"war_curated_{suffix}", f"economics_curated_{suffix}")
    return marts.government_from_base(base)


# ------------------------------------------------------------- fan-out join

@register("mart_government_spread", GOVERNMENT_SQL)
def mart_government_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The government mart over the join that looks for hot ids first."""
    base = marts.ongoing_base(war_like(spark, sf_dir), economics_like(spark, sf_dir), spread=True)
    return marts.government_from_base(base)


@register("join_fan_out", """
WITH c AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END AS k, c_acctbal FROM customer),
     o AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS k, o_orderkey FROM orders)
SELECT k % 10 AS k, count(*) AS n, sum(o_orderkey) AS orders, max(c_acctbal) AS most
FROM c JOIN o USING (k) GROUP BY 1""")
def join_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders over a key that fills a third of both sides."""
    hot = lambda c: F.when(F.col(c) % 3 == 0, F.lit(0)).otherwise(F.col(c)).cast("long")
    customers = load(spark, sf_dir, "customer").select(hot("c_custkey").alias("k"), "c_acctbal")
    orders = load(spark, sf_dir, "orders").select(hot("o_custkey").alias("k"), "o_orderkey")
    return (joins.spread_join(customers, orders, "k").groupBy((F.col("k") % 10).alias("k"))
            .agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("orders"), F.max("c_acctbal").alias("most")))


# ----------------------------------------------------------- ranking

@register("rank_distributed", """
SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS rank
FROM orders""")
def rank_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.global_rank(orders, ranking.desc("o_totalprice"), buckets=32)


@register("rank_key_window", """
SELECT o_orderkey,
       rank() OVER (ORDER BY o_orderpriority DESC NULLS LAST, o_orderstatus ASC NULLS FIRST) AS rank
FROM orders""")
def rank_key_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct keys, heavy ties: runs of equal keys cross many bucket borders."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    order = [("o_orderpriority", True), ("o_orderstatus", False)]
    return ranking.global_rank(orders, order, ties=("o_orderkey",), buckets=64).select("o_orderkey", "rank")


_NULL_KEY_SQL = """CASE WHEN o_orderstatus = 'F' THEN NULL
            WHEN o_orderpriority = '1-URGENT' THEN CAST('NaN' AS DOUBLE)
            WHEN o_orderpriority = '2-HIGH' THEN CAST('Infinity' AS DOUBLE)
            WHEN o_orderpriority = '5-LOW' THEN CAST('-Infinity' AS DOUBLE)
            ELSE round(o_totalprice, -5) END"""


def _null_key() -> Column:
    return (F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("double"))
            .when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("nan")))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit(float("inf")))
            .when(F.col("o_orderpriority") == "5-LOW", F.lit(float("-inf")))
            .otherwise(F.round("o_totalprice", -5)))


@register("rank_nulls", f"""
SELECT o_orderkey,
       rank() OVER (ORDER BY {_NULL_KEY_SQL} DESC NULLS LAST, o_custkey ASC NULLS FIRST) AS rank
FROM orders""")
def rank_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, NaN, ±inf and heavy ties in the first key; a second ascending key."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", _null_key().alias("key"))
    order = [("key", True), ("o_custkey", False)]
    return ranking.global_rank(orders, order, buckets=32).select("o_orderkey", "rank")


# ------------------------------------------------------------ paging

@register("page_finance", f"SELECT * FROM ({FINANCE_SQL}) ORDER BY rank, id LIMIT 5 OFFSET 10")
def page_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page 3 of the stored finance mart (the API pages gold tables, not plans)."""
    return paging.page(_stored(marts.finance_from_base, spark, sf_dir), 3).rows


def _stored(build, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store a mart as the staged run does: with positions, files sorted by them."""
    df = build(_base(spark, sf_dir), position=paging.POSITION)
    path = scratch_path(spark, build.__name__)
    df.sortWithinPartitions(paging.POSITION).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("page_humanitarian_ties",
          f"SELECT * FROM ({HUMANITARIAN_SQL}) ORDER BY rank, id LIMIT 5 OFFSET 1495")
def page_humanitarian_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page deep inside a tie group (the humanitarian rank has few distinct values)."""
    return paging.page(_stored(marts.humanitarian_from_base, spark, sf_dir), 300).rows


@register("page_government", f"SELECT * FROM ({GOVERNMENT_SQL}) ORDER BY rank, id LIMIT 5 OFFSET 35")
def page_government(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page 8 of the government mart by its public name, from the staged run's gold table."""
    db, _ = _staged(spark, sf_dir)
    return paging.page_mart(spark, "government", 8, db).rows


@register("page_metadata", f"""
SELECT mart, CAST(2 AS BIGINT) AS page, CAST(5 AS BIGINT) AS page_size, total,
       greatest(CAST(1 AS BIGINT), CAST(ceil(total / 5.0) AS BIGINT)) AS total_pages
FROM (SELECT unnest(['humanitarian', 'government', 'finance']) AS mart),
     (SELECT count(*) AS total FROM ({_BASE_SQL} SELECT * FROM base))""")
def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a page says of itself: its number and size, and the mart's rows and pages."""
    db, _ = _staged(spark, sf_dir)
    pages = [(m, paging.page_mart(spark, m, "2", db)) for m in paging.MART_TABLES]
    return spark.createDataFrame([(m, p.number, p.size, p.total, p.total_pages) for m, p in pages],
                                 "mart string, page long, page_size long, total long, total_pages long")


@register("sanitize_floats", """
SELECT event_id, event_type,
       CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN NULL ELSE value END AS value
FROM events""")
def sanitize_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    value = (F.when(F.col("event_type") == "error", F.lit(float("nan")))
             .when(F.col("event_type") == "signup", F.lit(float("inf")))
             .when(F.col("event_type") == "purchase", F.lit(float("-inf")))
             .otherwise(F.col("value")))
    return columns.sanitize_floats(events.select("event_id", "event_type", value.alias("value")))


# ------------------------------------------------------------ sources

PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())])
PART_DUMP_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())])


@register("ingest_delimited_roundtrip",
          "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def ingest_delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part → ``;`` file with a decimal-comma price → read back."""
    path = scratch_path(spark, "part_semicolon")
    write_delimited(load(spark, sf_dir, "part"), path, sep=";", decimal_comma=("p_retailprice",))
    return read_delimited(spark, path, schema=PART_SCHEMA, sep=";",
                          decimal_comma=("p_retailprice",))


@register("ingest_csv_comma", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def ingest_csv_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → comma CSV → read back with schema inference."""
    path = scratch_path(spark, "customer_csv")
    write_delimited(load(spark, sf_dir, "customer"), path, sep=",")
    df = read_delimited(spark, path, sep=",", infer=True)
    return df.select(F.col("c_custkey").cast("long"), "c_name", F.col("c_nationkey").cast("int"),
                     F.col("c_acctbal").cast("double"), "c_mktsegment")


def _write_part_dump(spark: SparkSession, sf_dir: str, bad_size: bool) -> str:
    part = load(spark, sf_dir, "part")
    size = F.col("p_size")
    if bad_size:
        size = F.when(size > 45, F.lit("n/a")).otherwise(size.cast("string"))
    # A bad size is written as the quoted text 'n/a'; good sizes stay numbers.
    lines = dump.insert_lines(
        part.select("p_partkey", "p_name", size.alias("p_size"), "p_retailprice"), "part")
    header = spark.createDataFrame(
        [("CREATE TABLE part (p_partkey BIGINT, p_name TEXT, p_size INT, p_retailprice REAL);",)],
        "value string")
    path = scratch_path(spark, "part_dump")
    header.unionByName(lines).write.mode("overwrite").text(path)
    return path


@register("ingest_dump_roundtrip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def ingest_dump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_part_dump(spark, sf_dir, bad_size=False)
    return dump.read_insert_dump(spark, path, PART_DUMP_SCHEMA, mode="locale").rows


@register("ingest_dump_strict", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def ingest_dump_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_part_dump(spark, sf_dir, bad_size=False)
    return dump.read_insert_dump(spark, path, PART_DUMP_SCHEMA, mode="strict").rows


@register("ingest_dump_rejects", """
SELECT 'accepted' AS outcome, CAST(NULL AS VARCHAR) AS reason, count(*) AS n
FROM part WHERE p_size <= 45
UNION ALL
SELECT 'rejected' AS outcome, 'bad p_size' AS reason, count(*) AS n FROM part WHERE p_size > 45""")
def ingest_dump_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conservation: every INSERT row is either accepted or rejected with a reason."""
    path = _write_part_dump(spark, sf_dir, bad_size=True)
    parsed = dump.parse_insert_dump(spark.read.text(path), PART_DUMP_SCHEMA, mode="locale")
    return (parsed.groupBy(
        F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected").alias("outcome"),
        F.col("reject_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("n")))


@register("ingest_dump_conservation", """
SELECT 'accepted' AS outcome, CAST(NULL AS VARCHAR) AS reason, count(*) AS n, CAST(sum(key) AS BIGINT) AS key_sum
FROM (SELECT p_partkey AS key FROM part WHERE p_partkey % 5 IN (0, 3)
      UNION ALL SELECT p_partkey + 1000000 FROM part WHERE p_partkey % 5 = 0)
UNION ALL SELECT 'rejected', 'text outside the value tuples', count(*), NULL FROM part WHERE p_partkey % 5 IN (1, 2)
UNION ALL SELECT 'rejected', 'text between the values', count(*), NULL FROM part WHERE p_partkey % 5 = 4""")
def ingest_dump_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with two tuples and a backslash quote, stray text, nested parentheses: none is lost."""
    part = load(spark, sf_dir, "part")
    key, rest = F.col("p_partkey").cast("string"), F.concat_ws(", ", "p_size", "p_retailprice")
    kind = F.col("p_partkey") % 5
    body = (F.when(kind == 0, F.concat(F.lit("("), key, F.lit(", 'it\\'s one', "), rest, F.lit("), ("),
                                       (F.col("p_partkey") + 1000000).cast("string"), F.lit(", 'two', "), rest, F.lit(")")))
            .when(kind == 1, F.concat(F.lit("("), key, F.lit(", 'a', "), rest, F.lit("), 7, 'lost', ("), key,
                                      F.lit(", 'b', "), rest, F.lit(")")))
            .when(kind == 2, F.concat(F.lit("("), key, F.lit(", (1), "), rest, F.lit(")")))
            .when(kind == 3, F.concat(F.lit("("), key, F.lit(", 'q''q\u2028', "), rest, F.lit(")")))
            .otherwise(F.concat(F.lit("("), key, F.lit(", 'x' junk!, "), rest, F.lit(")"))))
    path = scratch_path(spark, "conservation")
    (part.select(F.concat(F.lit("INSERT INTO part VALUES "), body, F.lit(";")).alias("value"))
     .write.mode("overwrite").text(path))
    parsed = dump.parse_insert_dump(spark.read.text(path), PART_DUMP_SCHEMA, mode="locale")
    return (parsed.groupBy(
        F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected").alias("outcome"),
        F.col("reject_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"),
             F.sum(F.when(F.col("reject_reason").isNull(), F.col("p_partkey"))).alias("key_sum")))


DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])
DOCUMENT_SQL = "SELECT doc_id, text, lang, source FROM documents"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(*[F.col(f.name).cast(f.dataType) for f in DOCUMENT_SCHEMA.fields])


@register("ingest_csv_quoted_lines", DOCUMENT_SQL)
def ingest_csv_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with their line breaks → ``;`` file → records read by several tasks a file."""
    path = scratch_path(spark, "documents_csv")
    write_delimited(_documents(spark, sf_dir), path, sep=";")
    return read_delimited_records(spark, path, DOCUMENT_SCHEMA, sep=";")


@register("ingest_dump_statements", DOCUMENT_SQL)
def ingest_dump_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents → INSERT statements over several lines, line breaks inside and outside quotes → rows."""
    path = scratch_path(spark, "documents_dump")
    lines = dump.insert_lines(_documents(spark, sf_dir), "documents")
    (lines.select(F.regexp_replace("value", r"^(INSERT INTO documents VALUES) \(", "$1\n-- one row\n  (").alias("value"))
     .write.mode("overwrite").text(path))
    return dump.read_insert_dump(spark, path, DOCUMENT_SCHEMA, statements=True).rows


EVENT_FEED_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("props", T.StructType([T.StructField("k", T.LongType())]))])


@register("json_field", """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → JSON lines with a nested ``props`` object → nested read → struct field."""
    feed = feeds.read_json_feed(spark, _event_feed(spark, sf_dir), EVENT_FEED_SCHEMA)
    return feed.select("event_id", "event_type", F.col("props.k").alias("k"))


@register("json_inferred", """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed read without a schema (one more pass finds it)."""
    feed = feeds.read_json_feed(spark, _event_feed(spark, sf_dir))
    return feed.select("event_id", "event_type", F.col("props.k").cast("long").alias("k"))


def _event_feed(spark: SparkSession, sf_dir: str) -> str:
    events = load(spark, sf_dir, "events")
    path = scratch_path(spark, "events_json")
    # Scalar fields through to_json (escaping is Spark's); props is already a JSON object.
    head = F.to_json(F.struct("event_id", "event_type"))
    (events.select(F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(', "props": '),
                            F.coalesce("props", F.lit("null")), F.lit("}")).alias("value"))
     .write.mode("overwrite").text(path))
    return path


@register("json_conflicts", """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT 'row' AS reason, '' AS field, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids,
  CAST(sum(CASE WHEN event_id % 11 <> 0 THEN k END) AS BIGINT) AS ks
FROM e WHERE event_id % 13 <> 0
UNION ALL SELECT 'not a JSON object', '', count(*), NULL, NULL FROM e WHERE event_id % 13 = 0 HAVING count(*) > 0
UNION ALL SELECT 'not a bigint', 'props.k', count(*), NULL, NULL FROM e
WHERE event_id % 13 <> 0 AND event_id % 11 = 0 AND k IS NOT NULL HAVING count(*) > 0
UNION ALL SELECT 'not in the schema', 'note', count(*), NULL, NULL FROM e
WHERE event_id % 13 <> 0 AND event_id % 11 <> 0 AND event_id % 7 = 0 HAVING count(*) > 0""")
def json_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → JSON lines, some cut short, with a text for a number or with a new field → rows and conflicts."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    number, id_ = F.struct("k").alias("props"), F.col("event_id")
    line = (F.when(id_ % 13 == 0, F.concat(F.lit('{"event_id": '), id_.cast("string")))
            .when(id_ % 11 == 0, F.to_json(F.struct("event_id", "event_type", F.struct(
                F.concat(F.lit("no "), F.col("k").cast("string")).alias("k")).alias("props"))))
            .when(id_ % 7 == 0, F.to_json(F.struct("event_id", "event_type", number, F.lit("new").alias("note"))))
            .otherwise(F.to_json(F.struct("event_id", "event_type", number))))
    path = scratch_path(spark, "events_json")
    events.select(line.alias("value")).write.mode("overwrite").text(path)
    feed = feeds.read_checked_feed(spark, path, EVENT_FEED_SCHEMA)
    rows = feed.rows.agg(F.lit("row").alias("reason"), F.lit("").alias("field"), F.count("*").alias("n"),
                         F.sum("event_id").alias("ids"), F.sum("props.k").alias("ks"))
    none = F.lit(None).cast("long")
    return rows.unionByName(feed.conflicts.groupBy("reason", "field").agg(F.count("*").alias("n"))
                            .select("*", none.alias("ids"), none.alias("ks")))


# ------------------------------------------------------ layout

AS_OF = date(2026, 3, 25)
EARLIER = date(2026, 3, 24)


@register("raw_partition_roundtrip", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       {AS_OF.year} AS year, {AS_OF.month} AS month, {AS_OF.day} AS day
FROM orders""")
def raw_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders loaded on two dates → read one load date back (partition pruning)."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "orders_raw")
    layout.write_partitioned(orders, path, EARLIER, mode="dynamic")
    layout.write_partitioned(orders, path, AS_OF, mode="dynamic")
    raw = layout.read_partitioned(spark, path)
    return raw.filter((F.col("year") == AS_OF.year) & (F.col("month") == AS_OF.month)
                      & (F.col("day") == AS_OF.day))


def _two_loads(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, f"overwrite_{mode}")
    layout.write_partitioned(orders, path, EARLIER, mode)
    layout.write_partitioned(orders, path, AS_OF, mode)
    return (layout.read_partitioned(spark, path).groupBy("year", "month", "day")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")))


_LOAD_SQL = ("SELECT CAST({y} AS INTEGER) AS year, CAST({m} AS INTEGER) AS month, "
             "CAST({d} AS INTEGER) AS day, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum "
             "FROM orders")


@register("overwrite_static", _LOAD_SQL.format(y=AS_OF.year, m=AS_OF.month, d=AS_OF.day))
def overwrite_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, static overwrite: only the last load date survives."""
    return _two_loads(spark, sf_dir, "static")


@register("overwrite_dynamic", _LOAD_SQL.format(y=AS_OF.year, m=AS_OF.month, d=AS_OF.day)
          + " UNION ALL " + _LOAD_SQL.format(y=EARLIER.year, m=EARLIER.month, d=EARLIER.day))
def overwrite_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, dynamic overwrite: both load dates survive."""
    return _two_loads(spark, sf_dir, "dynamic")


@register("write_fixed_files", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice, 2026 AS year, 3 AS month, 25 AS day FROM orders""")
def write_fixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders written by four tasks (the reference's repartition before a write), read back."""
    path = scratch_path(spark, "fixed_files")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    layout.write_partitioned(orders, path, AS_OF, num_files=4)
    return layout.read_partitioned(spark, path)


@register("write_backfill", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1, 2""")
def write_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders written under their own months, rows of a month brought together first, read back."""
    path = scratch_path(spark, "backfill")
    day = F.col("o_orderdate").cast("date")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(day).alias("year"), F.month(day).alias("month"))
    layout.write_partitioned(orders, path, partition_by=("year", "month"))
    return (layout.read_partitioned(spark, path).groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")))


_STATUS_SUMS_SQL = """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS custkey_sum
FROM orders GROUP BY o_orderstatus"""


def _status_sums(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                           F.sum("o_custkey").alias("custkey_sum"))


def _scratch_database(spark: SparkSession, name: str) -> str:
    db = f"rm_{name}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    return db


@register("table_managed", _STATUS_SUMS_SQL)
def table_managed(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _scratch_database(spark, "managed")
    layout.save_table(load(spark, sf_dir, "orders"), f"{db}.orders_managed",
                      partition_by=("o_orderstatus",))
    return _status_sums(layout.read_table(spark, f"{db}.orders_managed"))


@register("table_external", _STATUS_SUMS_SQL)
def table_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _scratch_database(spark, "external")
    orders = load(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_external")
    layout.save_table(orders, f"{db}.orders_external", path=path)
    # Read the files the way a reader without the catalog would.
    return _status_sums(layout.read_gold_dir(spark, path, orders.schema))


# ------------------------------------------------ raw → curated → gold (M4, K5)

def _source_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The reshaped driver tables as a ``;`` file and an INSERT dump."""
    war = war_like(spark, sf_dir)
    econ = economics_like(spark, sf_dir)
    war_path = scratch_path(spark, "source_war")
    econ_path = scratch_path(spark, "source_economics")
    header = spark.createDataFrame([("CREATE TABLE economics (Conflict_Id INT, ...);",)],
                                   "value string")
    lines = dump.insert_lines(economics_source(econ), "economics",
                              decimal_comma=("Estimated_Reconstruction_Cost_USD",),
                              barewords=("War_Profiteering_Documented",))
    stages.in_parallel(
        lambda: write_delimited(war_source(war), war_path, sep=";",
                                decimal_comma=("Cost_of_War_USD",)),
        lambda: header.unionByName(lines).write.mode("overwrite").text(econ_path))
    return war_path, econ_path


def _staged(spark: SparkSession, sf_dir: str, **how) -> tuple[str, stages.RunResult]:
    """A whole staged run: its database and result."""
    db = _scratch_database(spark, "pipeline")
    return db, stages.run_all(spark, *_source_files(spark, sf_dir), scratch_path(spark, "zones"), AS_OF,
                              database=db, **how)


def _run_pipeline(spark: SparkSession, sf_dir: str, **how) -> stages.RunResult:
    return _staged(spark, sf_dir, **how)[1]


def _curated(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Ingest and curation only."""
    paths, counts = stages.Paths(scratch_path(spark, "zones")), metrics.StageMetrics()
    stages.ingest(spark, *_source_files(spark, sf_dir), paths, AS_OF, counts)
    return stages.curate(spark, paths, AS_OF, counts, _scratch_database(spark, "curated"))[table]


@register("end_to_end_humanitarian", HUMANITARIAN_SQL)
def end_to_end_humanitarian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_pipeline(spark, sf_dir).tables["gold_output_humanitarian"]


@register("end_to_end_finance", FINANCE_SQL)
def end_to_end_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_pipeline(spark, sf_dir).tables["gold_output_finance"]


def _two_days_sql(days: list[date]) -> str:
    parts = [f"SELECT zone, {d.year} AS year, {d.month} AS month, {d.day} AS day, n FROM counts" for d in days]
    return f"""
WITH counts AS (
  SELECT 'raw_war' AS zone, count(*) AS n FROM ({WAR_LIKE_SQL})
  UNION ALL SELECT 'war_curated', count(*) FROM ({WAR_LIKE_SQL})
  UNION ALL SELECT 'raw_economics', count(*) FROM ({ECONOMICS_LIKE_SQL})
  UNION ALL SELECT 'economics_curated', count(*) FROM ({ECONOMICS_LIKE_SQL}))
""" + " UNION ALL ".join(parts) + f"""
UNION ALL SELECT 'gold_output_government', {days[-1].year}, {days[-1].month}, {days[-1].day},
                 (SELECT count(*) FROM ({_BASE_SQL} SELECT * FROM base))"""


def _two_days(spark: SparkSession, sf_dir: str, overwrite: str) -> DataFrame:
    """Two whole runs a day apart: rows by zone and load date, and the last run's government mart."""
    sources = _source_files(spark, sf_dir)
    root, db = scratch_path(spark, "zones"), _scratch_database(spark, overwrite)
    for day in (EARLIER, AS_OF):
        result = stages.run_all(spark, *sources, root, day, database=db, overwrite=overwrite)
    paths = stages.Paths(root)
    zones = {"raw_war": layout.read_partitioned(spark, paths.raw_war),
             "raw_economics": layout.read_partitioned(spark, paths.raw_economics),
             "war_curated": spark.table(f"{db}.war_curated"),
             "economics_curated": spark.table(f"{db}.economics_curated"),
             "gold_output_government": layout.with_load_date(result.tables["gold_output_government"], AS_OF)}
    return harmonise.union_feeds([
        df.groupBy(F.lit(zone).alias("zone"), "year", "month", "day").agg(F.count("*").alias("n"))
        for zone, df in zones.items()])


@register("pipeline_two_days_dynamic", _two_days_sql([EARLIER, AS_OF]))
def pipeline_two_days_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days(spark, sf_dir, "dynamic")


@register("pipeline_two_days_static", _two_days_sql([AS_OF]))
def pipeline_two_days_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_days(spark, sf_dir, "static")


@register("end_to_end_government", GOVERNMENT_SQL)
def end_to_end_government(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source files → raw → curated → gold; the government mart as stored."""
    return _run_pipeline(spark, sf_dir).tables["gold_output_government"]


@register("end_to_end_reference_parsing", GOVERNMENT_SQL)
def end_to_end_reference_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run with the reference's own parsing: inferred war types, strict dump tokens.

    The strict tokenizer shifts dump columns 15-18 (the decimal-comma cost splits,
    the bareword flag is lost) but no gold table reads them, so the government
    mart is unchanged.
    """
    return _run_pipeline(spark, sf_dir, dump_mode="strict",
                         war_schema=None).tables["gold_output_government"]


_DATE_SQL = f"{AS_OF.year} AS year, {AS_OF.month} AS month, {AS_OF.day} AS day"


@register("curate_war", f"""
SELECT name, type, region, start_year, end_year, primary_country, most_affected_sector,
       cost_of_war_usd, black_market_activity_level, currency_black_market_rate_gap_pct,
       primary_black_market_goods, id, {_DATE_SQL}
FROM ({WAR_LIKE_SQL})""")
def curate_war(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir, "war_curated")


@register("curate_economics", f"""
SELECT prewar_unemployment_pct, during_war_unemployment_pct, status,
       youth_unemployment_change_pct, prewar_poverty_rate_pct, during_war_poverty_rate_pct,
       extreme_poverty_rate_pct, food_insecurity_rate_pct,
       households_fallen_into_poverty_estimate, gdp_change_pct, inflation_rate_change_pct,
       currency_devaluation_pct, prewar_poverty_rate_pct AS informal_economy_size_pre_war_pct,
       during_war_poverty_rate_pct AS informal_economy_size_during_war_pct,
       CASE WHEN households_fallen_into_poverty_estimate > 4 THEN 'Yes' ELSE 'No' END
         AS war_profiteering_documented,
       id, {_DATE_SQL}
FROM ({ECONOMICS_LIKE_SQL})""")
def curate_economics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir, "economics_curated")


_ONGOING_COUNT = f"(SELECT count(*) FROM ({_BASE_SQL} SELECT * FROM base))"


@register("stage_counts", f"""
SELECT 'raw' AS stage, 'war' AS table_name, 'rows' AS metric, (SELECT count(*) FROM ({WAR_LIKE_SQL})) AS value
UNION ALL SELECT 'raw', 'war', 'malformed', CAST(0 AS BIGINT)
UNION ALL SELECT 'raw', 'economics', 'rows', (SELECT count(*) FROM ({ECONOMICS_LIKE_SQL}))
UNION ALL SELECT 'raw', 'economics', 'rejected', CAST(0 AS BIGINT)
UNION ALL SELECT 'curated', 'war_curated', 'rows', (SELECT count(*) FROM ({WAR_LIKE_SQL}))
UNION ALL SELECT 'curated', 'economics_curated', 'rows', (SELECT count(*) FROM ({ECONOMICS_LIKE_SQL}))
UNION ALL SELECT 'gold', 'ongoing_base', 'rows', {_ONGOING_COUNT}
UNION ALL SELECT 'gold', 'gold_output_humanitarian', 'rows', {_ONGOING_COUNT}
UNION ALL SELECT 'gold', 'gold_output_government', 'rows', {_ONGOING_COUNT}
UNION ALL SELECT 'gold', 'gold_output_finance', 'rows', {_ONGOING_COUNT}""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by each stage, counted by the writes themselves (observe)."""
    return _run_pipeline(spark, sf_dir).metrics.to_frame(spark)


@register("stage_counts_bucketed", f"""
SELECT 'war_curated' AS table_name, count(*) AS value, count(*) AS stored FROM ({WAR_LIKE_SQL})
UNION ALL SELECT 'economics_curated', count(*), count(*) FROM ({ECONOMICS_LIKE_SQL})""")
def stage_counts_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of bucketed curated tables (written through a shuffle), beside the tables' own rows."""
    paths, counts = stages.Paths(scratch_path(spark, "zones")), metrics.StageMetrics()
    stages.ingest(spark, *_source_files(spark, sf_dir), paths, AS_OF, counts)
    tables = stages.curate(spark, paths, AS_OF, counts, _scratch_database(spark, "bucketed"), bucket_by=(4, "id"))
    stored = harmonise.union_feeds([df.groupBy(F.lit(name).alias("table_name")).agg(F.count("*").alias("stored"))
                                    for name, df in tables.items()])
    return counts.to_frame(spark).where("stage = 'curated'").select("table_name", "value").join(stored, "table_name")


@register("duplicate_keys", """
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.duplicate_keys(load(spark, sf_dir, "lineitem"), "l_orderkey")


# ------------------------------------------- feeds, unions, scalar functions

FLAT_FEED_SCHEMA = T.StructType([
    T.StructField("HSISID", T.LongType()), T.StructField("NAME", T.StringType()),
    T.StructField("ADDRESS1", T.StringType()), T.StructField("ADDRESS2", T.StringType()),
    T.StructField("CITY", T.StringType()), T.StructField("STATE", T.StringType()),
    T.StructField("POSTALCODE", T.IntegerType()), T.StructField("PHONENUMBER", T.StringType()),
    T.StructField("RESTAURANTOPENDATE", T.StringType()),
    T.StructField("FACILITYTYPE", T.StringType()),
    T.StructField("X", T.DoubleType()), T.StructField("Y", T.DoubleType()),
    T.StructField("OBJECTID", T.LongType()), T.StructField("PERMITID", T.LongType()),
    T.StructField("GEOCODESTATUS", T.StringType())])
NESTED_FEED_SCHEMA = T.StructType([
    T.StructField("fields", T.StructType([
        T.StructField(n, T.StringType()) for n in (
            "id", "premise_name", "premise_address1", "premise_address2", "premise_city",
            "premise_state", "premise_zip", "premise_phone", "opening_date", "closing_date",
            "type_description")] + [
        T.StructField("geolocation", T.ArrayType(T.DoubleType()))])),
    T.StructField("geometry", T.StringType()), T.StructField("record_timestamp", T.StringType()),
    T.StructField("recordid", T.StringType())])


def _flat_feed_file(spark: SparkSession, sf_dir: str) -> str:
    """customer rendered as a flat CSV feed (null state where the balance is negative)."""
    c = load(spark, sf_dir, "customer")
    flat = c.select(
        F.col("c_custkey").alias("HSISID"), F.col("c_name").alias("NAME"),
        F.col("c_mktsegment").alias("ADDRESS1"), F.lit(None).cast("string").alias("ADDRESS2"),
        F.lower("c_mktsegment").alias("CITY"),
        F.when(F.col("c_acctbal") >= 0, "NC").alias("STATE"),
        F.col("c_nationkey").alias("POSTALCODE"),
        F.concat(F.lit("555-"), F.col("c_custkey").cast("string")).alias("PHONENUMBER"),
        F.col("c_nationkey").cast("string").alias("RESTAURANTOPENDATE"),
        F.col("c_mktsegment").alias("FACILITYTYPE"), F.col("c_acctbal").alias("X"),
        F.col("c_nationkey").cast("double").alias("Y"), F.col("c_custkey").alias("OBJECTID"),
        F.col("c_custkey").alias("PERMITID"), F.lit("M").alias("GEOCODESTATUS"))
    path = scratch_path(spark, "flat_feed")
    write_delimited(flat, path, sep=",")
    return path


def _nested_feed_file(spark: SparkSession, sf_dir: str) -> str:
    """supplier rendered as a nested JSON feed (no " - " and no coordinates when in debt)."""
    s = load(spark, sf_dir, "supplier")
    debt = F.col("s_acctbal") < 0
    fields = F.struct(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("premise_name"),
        F.lit("depot").alias("premise_address1"),
        F.when(F.col("s_acctbal") > 5000, "suite").alias("premise_address2"),
        F.lit("durham").alias("premise_city"), F.lit("NC").alias("premise_state"),
        F.col("s_nationkey").cast("string").alias("premise_zip"),
        F.concat(F.lit("555-"), F.col("s_suppkey").cast("string")).alias("premise_phone"),
        F.col("s_nationkey").cast("string").alias("opening_date"),
        F.lit(None).cast("string").alias("closing_date"),
        F.when(debt, "Restaurant").otherwise("1 - Restaurant").alias("type_description"),
        F.when(debt, F.array().cast("array<double>"))
        .otherwise(F.array(F.col("s_acctbal"), F.col("s_nationkey").cast("double")))
        .alias("geolocation"))
    nested = s.select(fields.alias("fields"), F.lit(None).cast("string").alias("geometry"),
                      F.lit("2026-03-25").alias("record_timestamp"),
                      F.col("s_suppkey").cast("string").alias("recordid"))
    path = scratch_path(spark, "nested_feed")
    nested.write.mode("overwrite").json(path)
    return path


@register("harmonise_feeds", """
SELECT CAST(c_custkey AS VARCHAR) AS datasetId, c_name AS name, c_mktsegment AS address1,
       CAST(NULL AS VARCHAR) AS address2, lower(c_mktsegment) AS city,
       CASE WHEN c_acctbal >= 0 THEN 'NC' END AS state, CAST(c_nationkey AS VARCHAR) AS zip,
       '555-' || CAST(c_custkey AS VARCHAR) AS tel, CAST(c_nationkey AS VARCHAR) AS dateStart,
       CAST(NULL AS VARCHAR) AS dateEnd, c_mktsegment AS type, c_acctbal AS geoX,
       CAST(c_nationkey AS DOUBLE) AS geoY, 'Wake' AS county,
       (CASE WHEN c_acctbal >= 0 THEN 'NC' END) || '_Wake_' || CAST(c_custkey AS VARCHAR) AS id
FROM customer
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, 'depot', CASE WHEN s_acctbal > 5000 THEN 'suite' END,
       'durham', 'NC', CAST(s_nationkey AS VARCHAR), '555-' || CAST(s_suppkey AS VARCHAR),
       CAST(s_nationkey AS VARCHAR), CAST(NULL AS VARCHAR),
       string_split(CASE WHEN s_acctbal < 0 THEN 'Restaurant' ELSE '1 - Restaurant' END, ' - ')[2],
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) END,
       'Durham', 'NC_Durham_' || CAST(s_suppkey AS VARCHAR)
FROM supplier""")
def harmonise_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat CSV feed and a nested JSON feed → one schema, composite id, union by name."""
    flat = read_delimited(spark, _flat_feed_file(spark, sf_dir), schema=FLAT_FEED_SCHEMA, sep=",")
    nested = feeds.read_json_feed(spark, _nested_feed_file(spark, sf_dir), NESTED_FEED_SCHEMA)
    return harmonise.union_feeds([harmonise.flat_feed(flat, "Wake"),
                                  harmonise.nested_feed(nested, "Durham")])


@register("harmonise_misfits", """
SELECT concat('NC_Wake_', c_custkey) AS id, CAST(c_custkey AS VARCHAR) AS "datasetId", 'geoX' AS "column",
       'n/a ' || c_mktsegment AS value, 'not a double' AS reason
FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR), 'geoX', CAST(count(CASE WHEN c_custkey % 7 <> 0 THEN 1 END) AS VARCHAR), 'kept'
FROM customer""")
def harmonise_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat feed with coordinates that are not numbers: each such value with its reason, and all rows kept."""
    feed = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("HSISID"), F.col("c_name").alias("NAME"), F.col("c_mktsegment").alias("ADDRESS1"),
        F.lit("NC").alias("STATE"), F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("n/a "), "c_mktsegment"))
        .otherwise(F.col("c_acctbal").cast("string")).alias("X"))
    shaped = harmonise.flat_shape(feed, "Wake")
    kept = harmonise.conform(shaped).agg(F.lit("rows").alias("id"), F.count("*").cast("string").alias("datasetId"),
                                         F.lit("geoX").alias("column"), F.count("geoX").cast("string").alias("value"),
                                         F.lit("kept").alias("reason"))
    return harmonise.misfits(shaped).unionByName(kept)


@register("union_positional", """
SELECT c_custkey AS party_key, c_name AS party_name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def union_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"),
        F.col("c_acctbal").alias("balance"))
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return harmonise.union_positional([c, s])


@register("replicate", """
SELECT o_orderstatus, count(*) * 61 AS n, CAST(sum(o_orderkey) * 61 AS BIGINT) AS key_sum
FROM orders GROUP BY o_orderstatus""")
def replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders × 61 (the tutorial's "bigger dataset"), then counted per status."""
    big = harmonise.replicate(load(spark, sf_dir, "orders"), 61)
    return big.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum("o_orderkey").alias("key_sum"))


@register("split_part", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS word1, string_split(p_name, ' ')[2] AS word2,
       string_split(p_name, ' ')[3] AS word3
FROM part""")
def split_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split text and take parts by position; a missing part is null, not an error."""
    words = F.split(F.col("p_name"), " ")
    return load(spark, sf_dir, "part").select(
        "p_partkey", F.get(words, 0).alias("word1"), F.get(words, 1).alias("word2"),
        F.get(words, 2).alias("word3"))


@register("array_element", """
SELECT vec_id, embedding[1] AS e0, embedding[2] AS e1, embedding[64] AS e63,
       embedding[65] AS e64
FROM embeddings""")
def array_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return load(spark, sf_dir, "embeddings").select(
        "vec_id", F.get(e, 0).alias("e0"), F.get(e, 1).alias("e1"), F.get(e, 63).alias("e63"),
        F.get(e, 64).alias("e64"))


@register("mean_expr", """
SELECT l_orderkey, l_linenumber, l_discount AS lcl, l_tax AS ucl, (l_discount + l_tax) / 2 AS avg,
       l_discount AS lcl2, l_tax AS ucl2
FROM lineitem""")
def mean_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename columns with blanks, mean by expression text, copy columns."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("Lower Confidence Limit"),
        F.col("l_tax").alias("Upper Confidence Limit"))
    df = li.withColumnsRenamed({"Lower Confidence Limit": "lcl", "Upper Confidence Limit": "ucl"})
    return harmonise.interval_columns(df, "lcl", "ucl")


# ----------------------------------------------------------------- text (A2)

@register("word_count", r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(load(spark, sf_dir, "documents"), "text")


# ------------------------------------------------------------ views (A3-A5)

@register("view_country", f"""
SELECT primary_country, count(*) AS n_conflicts, min(rank) AS best_rank,
       max(crisis_score) AS max_crisis_score, round(avg(crisis_score), 4) AS avg_crisis_score
FROM ({GOVERNMENT_SQL}) GROUP BY primary_country""")
def view_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.country_crisis(mart_government(spark, sf_dir))


@register("view_sector", f"""
SELECT most_affected_sector, black_market_activity_level, count(*) AS n_conflicts,
       round(avg(risk_score), 4) AS avg_risk_score,
       max(currency_black_market_rate_gap_pct) AS max_rate_gap_pct
FROM ({FINANCE_SCORED_SQL} SELECT * FROM scored)
GROUP BY most_affected_sector, black_market_activity_level""")
def view_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sector_exposure(marts.finance_scored(_base(spark, sf_dir)))


@register("view_region", f"""
SELECT region, count(*) AS n_conflicts, round(avg(poverty_change_pct), 4) AS avg_poverty_change_pct,
       round(avg(food_insecurity_rate_pct), 4) AS avg_food_insecurity_rate_pct,
       max(extreme_poverty_rate_pct) AS max_extreme_poverty_rate_pct
FROM ({_BASE_SQL} SELECT * FROM base) GROUP BY region""")
def view_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.regional_need(marts.humanitarian_scored(_base(spark, sf_dir)))


# ------------------------------------------------ incremental ingest (stream)

@register("stream_ingest_roundtrip", f"""
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, {_DATE_SQL} FROM part""")
def stream_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part → ``;`` files → file stream (availableNow) → load-date partitions → read."""
    source = scratch_path(spark, "stream_source")
    write_delimited(load(spark, sf_dir, "part"), source, sep=";", decimal_comma=("p_retailprice",))
    out = scratch_path(spark, "stream_raw")
    stream = streaming_ingest.delimited_stream(spark, source, PART_SCHEMA, sep=";",
                                               decimal_comma=("p_retailprice",))
    streaming_ingest.ingest_available(stream, out, scratch_path(spark, "stream_checkpoint"), AS_OF)
    return layout.read_partitioned(spark, out)
