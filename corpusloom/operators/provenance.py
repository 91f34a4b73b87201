"""Recovering the source passage of an answer: exact, by leading tokens, and over consecutive paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.sources.tables import checkpointed

SIGNATURE = 12
FOLLOWING = 3


def _keyed(words: Column) -> list[Column]:
    """key (a hash), signature and number of tokens of words joined by spaces."""
    leading = F.substring_index(words, " ", SIGNATURE)
    return [F.sha2(words, 256).alias("key"), leading.alias("signature"), F.when(words != "", F.size(F.split(words, " "))).otherwise(0).alias("size")]


def paragraph_index(paragraphs: DataFrame, text: str = "text", source: str = "source", index: str = "paragraph_index", order: str = "line_no") -> DataFrame:
    """Paragraphs with a source, an index and a token, with their key, signature and number of tokens."""
    rows = paragraphs.select(
        T.strip(F.col(text)).alias("evidence"), F.col(source).cast("string").alias("source"), F.col(index).cast("bigint").alias("idx"),
        F.col(order).alias("line"),
    )
    rows = rows.where((F.coalesce("source", F.lit("")) != "") & F.col("idx").isNotNull()).withColumn("words", T.comparison_key(F.col("evidence")))
    # matching reads it several times, each time other columns; words are made again of the few paragraphs that are compared
    return checkpointed(rows.select("evidence", "source", "idx", "line", *_keyed(F.col("words")))).where("size > 0")


def match(answers: DataFrame, paragraphs: DataFrame, id_col: str = "id", answer: str = "answer") -> DataFrame:
    """id, source, paragraph_index, evidence, score and method of each answer that is found; paragraphs: paragraph_index()'s.

    An answer equal to exactly one paragraph is `exact`. Else, of the paragraphs with the same leading tokens, the one with
    the longest common start, then the likest length, then the first, is extended by up to three following ones.
    Of paragraphs with equal tokens only the first is compared. Keys and places go through the joins; evidence is fetched for what
    is found.
    """
    words = T.comparison_key(F.col(answer))
    asked = checkpointed(answers.select(F.col(id_col).alias("id"), words.alias("a")).select("id", "a", *_keyed(F.col("a"))))
    place = F.struct("line", "source", "idx")
    firsts = paragraphs.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("p")).select("key", "n", "p.*")
    single = firsts.where("n = 1")
    found = asked.select("id", "key").join(single, "key").select("id", "key", "line", "source", "idx")
    exact = paragraphs.select("key", "line", "source", "idx", "evidence").join(found, ["key", "line", "source", "idx"])
    exact = exact.select("id", "source", F.col("idx").alias("paragraph_index"), "evidence", F.lit(1.0).alias("score"), F.lit("exact").alias("method"))
    rest = asked.join(single.select("key"), "key", "left_anti").select("id", "a", "signature", F.col("size").alias("asked"))
    wanted = paragraphs.join(rest.select("signature").distinct(), "signature", "left_semi").select("signature", "key", "line", "source", "idx", "size", "evidence")
    wanted = wanted.join(firsts.select("key", "line", "source", "idx"), ["key", "line", "source", "idx"], "left_semi")
    wanted = wanted.select("signature", place.alias("p"), "key", "size", T.comparison_key(F.col("evidence")).alias("w"))
    pairs = rest.join(wanted, "signature")
    fewer = F.least("asked", "size")
    # where one is the beginning of the other, all of the shorter one's tokens are shared
    whole = F.startswith(F.concat("a", F.lit(" ")), F.concat("w", F.lit(" "))) | F.startswith(F.concat("w", F.lit(" ")), F.concat("a", F.lit(" ")))
    ratio = F.when(whole, F.lit(1.0)).otherwise(T.common_prefix_ratio(F.split("a", " "), F.split("w", " ")))
    alike = F.floor(fewer / F.greatest("asked", "size") * 10_000)
    order = F.struct(ratio.alias("s"), alike.alias("l"), (-F.col("p.line")).alias("o"))
    # an aggregate, not a window: partial maxima keep a hot signature from meeting in one task
    best = pairs.groupBy("id").agg(F.max_by(F.struct("p", "key"), order).alias("b")).select("id", "b.key", "b.p.*")
    best = checkpointed(best)
    ahead = best.select("id", F.col("line").alias("own"), F.col("key").alias("own_key"), "source", F.explode(F.array(*map(F.lit, range(FOLLOWING + 1)))).alias("k"), "idx")
    ahead = ahead.select("id", "own", "own_key", "source", "k", (F.col("idx") + F.col("k")).alias("idx"))
    near = ahead.join(paragraphs.select("source", "idx", "line", "key", "evidence"), ["source", "idx"])
    near = near.where((F.col("k") > 0) | ((F.col("line") == F.col("own")) & (F.col("key") == F.col("own_key"))))
    evidence = [F.max_by(F.when(F.col("k") == k, F.col("evidence")), F.when(F.col("k") == k, F.col("line"))).alias(f"e{k}") for k in range(FOLLOWING + 1)]
    near = near.groupBy("id").agg(*evidence).join(best.select("id", "source", "idx"), "id").join(asked.select("id", T.split_key(F.col("a")).alias("a")), "id")
    near = near.withColumns({f"w{k}": T.tokens(F.col(f"e{k}")) for k in range(FOLLOWING + 1)})
    text, tokens, going = F.col("e0"), F.col("w0"), F.lit(True)
    for k in range(1, FOLLOWING + 1):
        going = going & F.col(f"e{k}").isNotNull()
        if k > 1:
            going = going & (T.left_coverage_ratio(F.col("a"), tokens) < 1.0)
        near = near.withColumn(f"g{k}", going)
        going = F.col(f"g{k}")
        near = near.withColumn(f"t{k}", F.when(going, F.concat_ws(" ", text, F.col(f"e{k}"))).otherwise(text))
        near = near.withColumn(f"k{k}", F.when(going, F.concat(tokens, F.col(f"w{k}"))).otherwise(tokens))
        text, tokens = F.col(f"t{k}"), F.col(f"k{k}")
    method = F.when(F.col("g1"), "consecutive_prefix").otherwise("normalized_prefix")
    near = near.select(
        "id", "source", F.col("idx").alias("paragraph_index"), text.alias("evidence"),
        F.round(T.left_coverage_ratio(F.col("a"), tokens), 4).alias("score"), method.alias("method"),
    )
    return exact.unionByName(near)
