"""Registered queries of the llm operators: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import merkle, pii, quality, warc_zip
from .decontaminate import contaminated
from .divergence import audit
from .kd_shards import kd_shards
from .line_dedup import deduplicated
from .mixing import mix_sources
from .ngram_join import near_duplicates
from .phrases import phrases, top_phrases
from .substring_dedup import without_repeats
from .token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    counted = token_counts(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query("op3_mix_sources")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op10_kd_shards")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = kd_shards(table(spark, sf_dir, "documents"), n_shards=8)
    return (sharded.withColumn("law", F.lit("bytes"))
            .withColumn("shard", F.col("shard").cast("int"))
            .withColumn("grown_shard", F.lit(None).cast("int"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))


@query("op5_merkle_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = merkle.fingerprints(table(spark, sf_dir, "documents"))
    return trees.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.col("a_root").alias("fingerprint"), F.col("e_root").alias("edited_fingerprint"),
        merkle.likeness("a_", "e_").alias("near_edited"), merkle.likeness("a_", "n_").alias("near_next"),
        F.size("a_sections").alias("n_sections"), F.size("a_paragraphs").alias("n_paragraphs"),
        merkle.first_difference("a_", "e_", "sections").alias("edited_section"),
        merkle.first_difference("a_", "e_", "paragraphs").alias("edited_paragraph"))


@query("op9_warc_zip", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
     k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM k""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc_zip.round_trip(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query("op7_quality_gam")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")  # noqa: B023
              for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


@query("op4_ngram_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select(
        "doc_id", "n_lines", "removed_lines", F.length("text").cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op13_substring_dedup", """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
     windows AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(w[i:i + 12], ' ')) AS least FROM starts),
     gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows WHERE least < doc_id),
     words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
     kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_phrases", """
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
     pieces AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM docs),
     grams AS (SELECT lang, k, w[i:i + k - 1] AS w, count(*) AS f
               FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 5) AS t(k) WHERE len(w) >= k)
               GROUP BY ALL),
     totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
     often AS (SELECT * FROM grams WHERE f >= 30),
     cuts AS (SELECT lang, k, w, f, unnest(range(1, k)) AS cut FROM often WHERE k > 1),
     scored AS (SELECT c.lang, c.k, c.w, c.f AS a, c.cut, p.f AS l, q.f AS r,
                       CAST(2000000::HUGEINT * c.f // (p.f + q.f) AS BIGINT) AS score
                FROM cuts c JOIN often p ON p.lang = c.lang AND p.w = c.w[1:cut] JOIN often q ON q.lang = c.lang AND q.w = c.w[cut + 1:]),
     best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1),
     inner_of AS (SELECT lang, w[i:i + m - 1] AS w, max(f) AS f
                  FROM (SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM often, range(2, 4) AS t(m) WHERE k > m)
                  GROUP BY ALL),
     kept AS (SELECT b.* FROM best b LEFT JOIN inner_of o USING (lang, w) WHERE o.f IS NULL OR 100 * o.f < 80 * b.a),
     ranked AS (SELECT *, array_to_string(w, ' ') AS phrase FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, score
FROM ranked JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (top_phrases(phrases(table(spark, sf_dir, "documents")), 2000)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


@query("op11_source_divergence", """
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
     terms AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
     kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
     sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
     groups AS (SELECT DISTINCT lang, source FROM docs),
     found AS (SELECT lang, source, term, count(*) AS c FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
     grid AS (SELECT g.lang, g.source, k.term, coalesce(f.c, 0)::HUGEINT AS c FROM groups g JOIN kept k USING (lang)
              LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
     own AS (SELECT lang, source, term, c, sum(c) OVER (PARTITION BY lang, source) AS n, sum(c) OVER (PARTITION BY lang, term) AS lc,
                    sum(c) OVER (PARTITION BY lang) AS ln, v FROM grid JOIN sizes USING (lang)),
     p AS (SELECT lang, source, term, c, 1 + 1000000000 * (c + 2) // (n + 2 * v) AS p, 1 + 1000000000 * (lc + 2) // (ln + 2 * v) AS q FROM own),
     sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
               FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
     parts AS (SELECT * FROM pairs UNION ALL
               SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
