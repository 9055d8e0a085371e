"""The operators of this subpackage as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (conversation_repair, exact_dedup, fingerprints, jaccard_join, language_id, license_scan, lm_scoring, mixing, packing, secret_scan, simhash_join, spelling,
                            url_filter)

Run = Callable[[SparkSession, str], DataFrame]

# Where the public vocabularies are; another copy of the files can be named here.
VOCABULARY, RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.license_scan(documents(spark, sf_dir)))


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.harmonic_pack(documents(spark, sf_dir), VOCABULARY, RANKS, PATTERN)


def op3_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir)).drop("changed")


def op4_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    known = language_id.profiles(docs.where(~language_id.held_out("doc_id")))
    found = language_id.identify(docs, known)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(documents(spark, sf_dir), lambda doc_id: language_id.held_out(doc_id, folds=7), RANKS, PATTERN)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(documents(spark, sf_dir)).drop("label", "th")


# A history of two lists for the hosts of the pages, by rules on the smallest page of each host: dates as days from the first of 2024.
LIST_RULES = """
SELECT 'hosts' AS list, 'block' AS kind, host AS pattern, 'add' AS action, seed * 13 % 200 AS day FROM hosts WHERE seed % 3 <> 0
UNION ALL SELECT 'hosts', 'block', host, 'remove', seed * 13 % 200 + 60 + seed % 50 FROM hosts WHERE seed % 3 <> 0
UNION ALL SELECT 'hosts', 'block', host, 'add', seed * 13 % 200 + 150 FROM hosts WHERE seed % 6 = 1
UNION ALL SELECT 'domains', 'block', substr(host, length(host) - 10), 'add', seed * 7 % 300 FROM hosts WHERE seed % 5 = 0 AND length(host) > 11
UNION ALL SELECT 'paths', 'allow', concat(host, '/en'), 'add', seed * 5 % 250 FROM hosts WHERE seed % 2 = 0
UNION ALL SELECT 'paths', 'block', concat(host, '/de'), 'add', seed * 3 % 250 FROM hosts WHERE seed % 4 = 1"""
FETCHED = "date_add(DATE '2024-01-01', CAST(page_id * 7919 % 366 AS INT))"


def op9_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    hosts = pages.groupBy(url_filter.host_of(F.col("url")).alias("host")).agg(F.min("page_id").alias("seed")).where("host <> ''")
    events = spark.sql(LIST_RULES.replace("FROM hosts", "FROM {hosts}"), hosts=hosts).withColumn("at", F.expr("date_add(DATE '2024-01-01', CAST(day AS INT))"))
    found = url_filter.temporal_filter(pages.withColumn("fetched", F.expr(FETCHED)), events)
    dates = ("fetched", "valid_from", "valid_until")
    return found.select("page_id", "url", "host", "pattern", "list", "kind", *[F.col(c).cast("string").alias(c) for c in dates], "blocked")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(documents(spark, sf_dir))


def op11_simhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_join.simhash_join(documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.conversation_repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Run]:
    return {f.__name__: f for f in (op1_license_scan, op2_harmonic_packing, op3_iblt_fingerprints, op4_entropy_mixing, op5_language_id, op6_exact_dedup, op7_attention_lm, op8_jaccard_join, op9_temporal_url_filter, op10_secret_scan,
                                    op11_simhash_join, op12_spelling_variants, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents""", "op9_temporal_url_filter": f"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7919 % 366 AS INT) AS fetched,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1)) AS host, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) AS path
  FROM pages),
hosts AS (SELECT host, min(page_id) AS seed FROM captures WHERE host <> '' GROUP BY host),
events AS ({LIST_RULES}),
dated AS (SELECT list, pattern, day, min(action) AS action, min(kind) AS kind FROM events GROUP BY list, pattern, day),
periods AS (SELECT list, kind, pattern, action, DATE '2024-01-01' + CAST(day AS INT) AS valid_from,
                   DATE '2024-01-01' + CAST(lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS INT) AS valid_until FROM dated),
entries AS (SELECT * FROM periods WHERE action = 'add'),
matches AS (
  SELECT c.page_id, e.*, row_number() OVER (PARTITION BY c.page_id ORDER BY length(e.pattern) DESC, e.kind, e.list, e.valid_from) AS place
  FROM captures c JOIN entries e ON (c.host = e.pattern OR ends_with(c.host, '.' || e.pattern) OR starts_with(c.host || c.path || '/', e.pattern || '/'))
                                AND c.fetched >= e.valid_from AND (e.valid_until IS NULL OR c.fetched < e.valid_until))
SELECT c.page_id, c.url, c.host, m.pattern, m.list, m.kind, CAST(c.fetched AS VARCHAR) AS fetched, CAST(m.valid_from AS VARCHAR) AS valid_from,
       CAST(m.valid_until AS VARCHAR) AS valid_until, coalesce(m.kind = 'block', false) AS blocked
FROM captures c LEFT JOIN matches m ON c.page_id = m.page_id AND m.place = 1"""}
