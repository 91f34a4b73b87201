import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import prompts
from corpusloom.functions import scores as S
from corpusloom.functions import text as T

TEXTS = [
    None, "", "  desire\n\n and\t language ", "﻿A b \x85 c", "ﬁne ½ Straße", "The Other—speaks.", "don’t DON'T x", "one two", "a b c d e f", "\x1c x 　",
    "w " * 30, " ".join(f"w{i % 8}" for i in range(24)), " ".join(f"w{i % 8}" for i in range(23)),
]


@pytest.fixture(scope="module")
def rows(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id int, raw string").withColumn("t", T.nfkc(F.col("raw")))
    return frame.select(
        "id", T.clean_text(F.col("t")).alias("clean"), T.cleaning_operations(F.col("raw"), F.col("t")).alias("ops"), T.tokens(F.col("t")).alias("tokens"),
        T.fingerprint(F.col("t")).alias("fp"), T.repeated_ngram(T.tokens(F.col("t"))).alias("repeated"), T.simhash(F.col("raw")).alias("hash"),
    ).orderBy("id").collect()


def clean(v):
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", v or "").replace("﻿", "")).strip()


def words(v):
    return [w.replace("’", "'").lower() for w in re.findall(r"[a-z0-9]+(?:['’][a-z0-9]+)?", clean(v), re.I | re.A)]


def test_cleaning_and_tokens(rows):
    for r, text in zip(rows, TEXTS, strict=True):
        assert r.clean == clean(text) and r.tokens == words(text), text
        assert r.fp == hashlib.sha256(" ".join(words(text)).encode()).hexdigest()
        grams = [tuple(r.tokens[i : i + 8]) for i in range(len(r.tokens) - 7)]
        assert r.repeated == (len(r.tokens) >= 24 and any(grams.count(g) >= 3 for g in set(grams)))
    assert rows[2].clean == "desire and language" and rows[3].ops == ["unicode_nfkc", "bom_removed", "whitespace_normalized"]
    assert rows[5].tokens == ["the", "other", "speaks"]


def test_simhash_bit_by_bit(rows):
    for r, text in zip(rows, TEXTS, strict=True):
        w = words(text)
        features = w if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
        value = 0
        for b in range(64):
            s = sum(1 if int(hashlib.sha256(f.encode()).hexdigest()[:16], 16) >> b & 1 else -1 for f in features)
            value |= (1 << b) if features and s >= 0 else 0
        assert r.hash % (1 << 64) == value, text


def test_ratios_and_payloads(spark):
    one = spark.range(1).select(
        T.common_prefix_ratio(T.tokens(F.lit("a b c")), T.tokens(F.lit("a b c d"))).alias("ratio"),
        T.left_coverage_ratio(T.tokens(F.lit("one two three four")), T.tokens(F.lit("one two"))).alias("left"),
        T.left_coverage_ratio(T.tokens(F.lit("")), T.tokens(F.lit("one"))).alias("none"),
        T.overlap(T.content_tokens(F.lit("the desire of language")), T.content_tokens(F.lit("language"))).alias("overlap"),
        T.json_payload(F.lit('```json\n{"a": {"b": 1}}\n```')).alias("json"), T.json_payload(F.lit("none")).alias("nothing"),
        T.tagged_field(F.lit("<answer> x\ny </answer><answer>z</answer>"), "answer").alias("tag"), T.tagged_field(F.lit("x"), "answer").alias("no_tag"),
        T.sentences(F.lit("One. Two? Three")).alias("parts"), T.question_cleaned(F.lit('"Question: why so late?"')).alias("asked"),
        T.question_cleaned(F.lit("no question")).alias("not_asked"), T.evidence_span(F.lit("of the other"), F.lit("speech—of—the OTHER!")).alias("span"),
        T.evidence_span(F.lit("absent"), F.lit("speech")).alias("no_span"), T.occurrences(F.lit("aaaa"), "aa").alias("twice"),
        S.paragraph_quality(F.lit("x" * 700)).alias("best"), S.hard_quality(F.lit(1.0), F.lit(0.5)).alias("hard"),
        prompts.render("a {x} {{b}} {x}", {"x": F.lit("{y}"), "b": F.lit("c")}).alias("prompt"),
    ).first()
    assert (one.ratio, one.left, one.none, one.overlap) == (1.0, 0.5, 0.0, 0.5)
    assert one.json == '{"a": {"b": 1}}' and one.nothing is None and one.tag == "x\ny" and one.no_tag is None
    assert one.parts == ["One.", "Two?", "Three"] and one.asked == "why so late?" and one.not_asked is None
    assert (one.span.start, one.span.end) == (7, 19) and one.no_span is None and one.twice == 2
    assert (one.best, one.hard) == (1.0, 0.85) and one.prompt == "a {y} {c} {y}"


def test_suitability_ranks_types(spark):
    clinical = "The analyst hears the symptom of the patient in the treatment; neurosis and psychosis differ in transference. " * 3
    office = "The committee met on a day in spring and agreed on the order of the chairs and of the tables in the room. " * 3
    got = spark.createDataFrame([(clinical,), (office,)], "t string").select(S.type_suitability(F.col("t"), "clinical_application").alias("s")).collect()
    assert got[0].s > got[1].s


def test_descending_order(spark):
    names = ["a", "ab", "abc", "b", "", "ß"]
    got = spark.createDataFrame([(n,) for n in names], "n string").orderBy(T.descending(F.col("n"))).collect()
    assert [r.n for r in got] == sorted(names, reverse=True)


def test_white_space_of_python_is_cleaned(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = [f"a{x}b {x}{y}c  d{y}" for x in spaces for y in (" ", "\t", "\u3000", "\xa0")] + ["\ufeff a\ufeffb ", "é\n é", "plain text", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.clean_text(F.col("t")).alias("c"))
    assert [r.c for r in rows.orderBy("i").collect()] == [" ".join((t or "").replace("\ufeff", "").split()) for t in texts]


def test_texts_without_unsafe_characters_meet_no_slow_pattern(spark):
    rows = spark.createDataFrame([("plain",), ("caf\xe9",), ("ﬁ",), ("e\u0301",), (None,)], "t string")
    assert [r.t for r in rows.select(T.nfkc(F.col("t")).alias("t")).collect()] == ["plain", "caf\xe9", "fi", "\xe9", None]
    assert "octet_length" in rows.select(T.nfkc(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_of_letters_whose_small_ones_are_ascii(spark):
    rows = spark.createDataFrame([("\u212aelvin \u0130s DON’T a’’b 1x",), ("?!",)], "t string")
    assert [r.w for r in rows.select(T.tokens(F.col("t")).alias("w")).collect()] == [["elvin", "s", "don't", "a", "b", "1x"], []]


@pytest.mark.parametrize(("n", "times"), [(8, 3), (5, 2), (1, 4), (3, 3)])
def test_repeated_ngrams_by_counting(spark, n, times):
    from collections import Counter
    from random import Random

    r = Random(n)
    texts = [[r.choice("abc" if i % 2 else "abcdefghij") for _ in range(r.randint(0, 60))] for i in range(120)]
    texts += [[f"w{i % 9}" for i in range(k)] for k in range(15, 40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, w array<string>").select("i", T.repeated_ngram(F.col("w"), n, times).alias("r"))
    many = lambda w: len(w) >= n * times and max(Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)).values()) >= times
    got = [x.r for x in rows.orderBy("i").collect()]
    assert got == [many(w) for w in texts] and 0 < sum(got) < len(got)


def test_terms_are_sought_one_by_one(spark):
    rows = spark.createDataFrame([("a.b",), ("axb",), ("(c",), (None,)], "t string").select(T.contains_any(F.col("t"), ("a.b", "(c")).alias("r"))
    assert [x.r for x in rows.collect()] == [True, False, True, None]
    assert "RLIKE" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_content_tokens_are_distinct_and_in_order(spark):
    rows = spark.createDataFrame([("The cat, THE cat and an owl: it is of owl's own",)], "t string").select(T.content_tokens(F.col("t")).alias("r"))
    assert rows.first().r == ["cat", "owl", "owl's", "own"]
