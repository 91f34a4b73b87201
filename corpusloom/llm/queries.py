"""The queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontaminate, language_id, neighbours, secrets, simhash, token_counts, token_files, toxicity, url_filter
from .common import table

#: The given list: canonical URLs of known spam hosts, for every page number below LISTED_PAGES (1.5 million URLs).
SPAM_HOSTS = ("spam-farm", "cheap-pills", "click-bait", "casino-win", "free-bets", "ads-track", "adult-x")
LISTED_PARTS = [f"{sub}{host}.example.{top}/{lang}/" for host in SPAM_HOSTS for sub in ("", "m.", "blog.") for top in ("com", "net", "org") for lang in ("en", "fr", "de", "es")]
LISTED_ENDS = ("", ".html", "?page=2")
LISTED_PAGES = 2000


def listed_urls(spark: SparkSession) -> DataFrame:
    """One column url: the given list."""
    each = lambda parts: F.explode(F.array(*map(F.lit, parts)))
    rows = spark.range(LISTED_PAGES).select("id", each(LISTED_PARTS).alias("part")).select("id", "part", each(LISTED_ENDS).alias("end"))
    return rows.select(F.concat("part", F.col("id").cast("string"), "end").alias("url"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), listed_urls(spark))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, written)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.where(~held))
    return language_id.predict_languages(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"), 5, 0)
    field = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held))
    scored = toxicity.score_documents(docs, field)
    predicted = F.when(F.col("score") >= 0.5, F.lit(1)).otherwise(F.lit(0))
    return scored.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"), "spans")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_secret_scan,
        op3_token_counts,
        op4_token_files,
        op5_language_id,
        op6_decontaminate,
        op7_neighbours,
        op8_simhash_dedup,
        op9_toxicity,
        op10_byte_bpe,
    )
}

_CANONICAL = r"""nullif(regexp_replace(h, '^www\.', '') || regexp_replace(p, '/+$', '') || coalesce('?' || nullif(array_to_string(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)') AND x <> ''), '&'), ''), ''), '')"""
_quoted = lambda parts: ", ".join(f"'{p}'" for p in parts)
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op1_url_filter": rf"""
WITH a AS (SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
b AS (SELECT page_id, rest, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS h, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS p FROM a),
c AS (SELECT *, CASE WHEN h = '' THEN NULL ELSE {_CANONICAL} END AS canonical,
  CASE WHEN (h = 'example.net' OR h LIKE '%.example.net') AND p LIKE '/en/%' THEN 'example.net/en/'
       WHEN (h = 'example.com' OR h LIKE '%.example.com') AND p LIKE '/de/%' THEN 'example.com/de/'
       WHEN (h = 'org' OR h LIKE '%.org') AND p LIKE '/fr/%' THEN 'org/fr/'
       WHEN (h = 'net' OR h LIKE '%.net') AND p LIKE '/%' THEN 'net/' END AS rule FROM b),
listed AS (SELECT part || n || ending AS url FROM (SELECT unnest([{_quoted(LISTED_PARTS)}]) AS part), range({LISTED_PAGES}) AS r(n),
  (SELECT unnest([{_quoted(LISTED_ENDS)}]) AS ending))
SELECT page_id, h AS host, p AS path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  canonical, (listed.url IS NOT NULL AND rule IS NULL) AS listed
FROM c LEFT JOIN listed ON listed.url = c.canonical""",
}
