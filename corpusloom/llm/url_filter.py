"""URL filters: host and path rules, then a blocked Bloom filter of listed URLs confirmed by an exact hash join.

Only DataFrame functions are used. A listed URL sets eight bits of one 256-bit block (four BIGINT words); a page url is a
possible hit when its block has all of them. The filter is of bounded size and always broadcast, so pages meet it without a
shuffle. Only possible hits reach the exact join, which removes false positives.

Defined results: a null url, or one without "://", has empty host and path, fits no rule and is never listed; repeated rows
are judged one by one; an empty list lets everything pass; extra columns of the input are kept out of the result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: (verdict, rule): the rule's host fits itself and its subdomains, its path is a prefix; the longest rule wins.
RULES: tuple[tuple[str, str], ...] = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
BLOCK_BITS = 256
PROBES = 8
BITS_PER_URL = 16
#: Blocks of the filter at most, so that it is always broadcast: 40 MiB of bits and numbers. It gives every URL its bits up to
#: 16 million URLs; beyond, it passes more hits that the exact join then removes.
MAX_BLOCKS = 1 << 20
#: Up to this many distinct URLs (at most about 100 bytes each) possible hits and confirmed URLs are broadcast; beyond, they
#: are joined by shuffles of possible hits alone.
BROADCAST_URLS = 200_000
#: Copies of a confirmed URL in the shuffled form, so that one hot url is dealt to as many tasks.
SALTS = 16


def ascii_lower(col: Column) -> Column:
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def after_scheme(url: Column) -> Column:
    """What follows the first "://", or an empty string."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """host without www., path without a closing slash, query without utm_*, ref and fragment; null where there is no host."""
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^(utm_[^=]*|ref)(=|$)") & (p != "")), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule = verdict = None
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def probe_words(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and the four words of the bits that the url sets."""
    block = F.pmod(F.xxhash64(url), F.lit(blocks).cast("bigint"))
    bits = F.xxhash64(url, F.lit("bits"))
    places = [F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(BLOCK_BITS - 1).cast("bigint")) for i in range(PROBES)]
    words = []
    for w in range(BLOCK_BITS // 64):
        word = F.lit(0).cast("bigint")
        for p in places:
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(p, F.lit(64).cast("bigint")).cast("int"))
            word = word.bitwiseOR(F.when(F.shiftrightunsigned(p, 6) == w, bit).otherwise(F.lit(0).cast("bigint")))
        words.append(word)
    return block, words


def bloom_table(listed: DataFrame, blocks: int) -> DataFrame:
    """listed: one distinct column url. One row for each block with a bit set."""
    block, words = probe_words(F.col("url"), blocks)
    rows = listed.select(block.alias("block"), *(w.alias(f"w{i}") for i, w in enumerate(words)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(words))))


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    broadcast_urls: int = BROADCAST_URLS,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """id, host, path, rule, verdict, canonical and listed (boolean) of every row of pages.

    listed: a DataFrame whose first column holds canonical URLs; nulls and repeats in it are ignored. Pages are read once and
    meet the filter where they are read; what is written then has their judged columns. Only distinct possible hits go to the
    exact join with the list, and only pages of possible hits are ever shuffled.
    """
    urls = listed.toDF("url", *(f"_{i}" for i in range(1, len(listed.columns)))).select("url").where(F.col("url").isNotNull())
    blocks = min(max_blocks, max(1, -(-urls.count() * BITS_PER_URL // BLOCK_BITS)))
    bloom = bloom_table(urls, blocks)
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    rows = rows.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), canonical_url(F.col("url")).alias("canonical"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    block, words = probe_words(F.col("canonical"), blocks)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("verdict"), block.alias("block"), *(w.alias(f"p{i}") for i, w in enumerate(words)))
    holds = F.lit(True)
    for i in range(len(words)):
        holds = holds & (F.col(f"w{i}").bitwiseAND(F.col(f"p{i}")) == F.col(f"p{i}"))
    possible = F.coalesce(holds & F.col("canonical").isNotNull() & F.col("rule").isNull(), F.lit(False))
    rows = rows.join(F.broadcast(bloom), "block", "left").select("id", "host", "path", "rule", "verdict", "canonical", possible.alias("possible"))
    rows = materialize(rows, "judged-pages")

    hits = materialize(rows.where("possible").select(F.col("canonical").alias("url")).distinct(), "possible-urls")
    if hits.count() <= broadcast_urls:
        found = urls.join(F.broadcast(hits), "url", "left_semi").distinct()
    else:
        found = hits.join(urls.distinct(), "url", "left_semi")
    found = materialize(found.select(F.col("url").alias("listed_url")), "confirmed-urls")
    if found.count() <= broadcast_urls:
        key = F.when(F.col("possible"), F.col("canonical"))
        rows = rows.withColumn("key", key).join(F.broadcast(found), F.col("key") == F.col("listed_url"), "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        own = F.pmod(F.xxhash64("id", "canonical"), F.lit(SALTS).cast("bigint")).cast("int").alias("salt")
        found = found.select("listed_url", F.col("listed_url").alias("canonical"), salts)
        some = rows.where("possible").select("*", own).join(found, ["canonical", "salt"], "left").drop("salt")
        rows = some.unionByName(rows.where("not possible").withColumn("listed_url", F.lit(None).cast("string")))
    is_listed = F.col("listed_url").isNotNull()
    by_list = F.when(is_listed, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", by_list).alias("verdict"), "canonical", is_listed.alias("listed")
    )
