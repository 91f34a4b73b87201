"""Rule gates: every failed rule of a row, in rule order; accepted and rejected rows are two filters on that."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions import text as T
from corpusloom.functions.fixed import BOILERPLATE, LEGACY_PLACEHOLDERS, META_QUESTIONS, MOJIBAKE, PLACEHOLDERS
from corpusloom.sources.tables import checkpointed


def reasons(*rules: tuple[Column, str]) -> Column:
    """Names of the rules whose condition holds (a null condition does not), in order."""
    return F.array_compact(F.array(*(F.when(failed, F.lit(name)) for failed, name in rules)))


def split_by(df: DataFrame, column: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    return df.where(F.size(column) == 0), df.where(F.size(column) > 0)


def reason_counts(df: DataFrame, column: str = "reasons") -> DataFrame:
    """reason, n: how often each rule failed; a row counts for each of its reasons."""
    return df.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def outside(length: Column, low: int, high: int) -> Column:
    return ~length.between(low, high)


# --- corpus ------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class CleaningRules:
    min_chars: int = 240
    max_chars: int = 1800
    min_alphabetic_ratio: float = 0.6
    ngram: int = 8
    ngram_times: int = 3


def paragraph_reasons(text: Column, words: Column, rules: CleaningRules = CleaningRules()) -> Column:
    """text: cleaned; words: its tokens."""
    return reasons(
        (outside(F.length(text), rules.min_chars, rules.max_chars), "length"),
        (T.contains_any(F.lower(text), BOILERPLATE), "publisher_metadata"),
        (T.contains_any(text, MOJIBAKE), "mojibake"),
        (T.alphabetic_ratio(text) < rules.min_alphabetic_ratio, "low_alphabetic_ratio"),
        (T.repeated_ngram(words, rules.ngram, rules.ngram_times), "repeated_ngram"),
    )


def with_exact_duplicates(df: DataFrame, key: str, order: str, column: str = "reasons") -> DataFrame:
    """Adds exact_duplicate to rows whose key an earlier row without any reason has.

    The earliest such row of each key is an aggregate with map-side combining; one hot key is one row of it.
    """
    firsts = df.where(F.size(column) == 0).groupBy(key).agg(F.min(order).alias("_first"))
    both = df.join(firsts, key, "left")
    late = F.coalesce(F.col(order) > F.col("_first"), F.lit(False))
    added = F.when(late, F.concat(column, F.array(F.lit("exact_duplicate")))).otherwise(F.col(column))
    return both.withColumn(column, added).drop("_first").select(*df.columns)


def clean_corpus(
    raw: DataFrame, rules: CleaningRules = CleaningRules(), text_col: str = "text", source_col: str = "source", order: str = "line_no",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """raw with cleaned_text, tokens, fingerprint, operations and reasons (in order, then exact_duplicate, missing_provenance).
    keep: the columns to return besides order, source and reasons, where not all are wanted; others are not written."""
    rows = raw.withColumn("_nfkc", T.nfkc(F.col(text_col)))
    rows = rows.withColumn("cleaned_text", T.clean_text(F.col("_nfkc")))
    rows = rows.withColumn("operations", T.cleaning_operations(F.col(text_col), F.col("_nfkc"))).drop("_nfkc")
    rows = rows.withColumn("tokens", T.tokens(F.col("cleaned_text")))
    rows = rows.withColumn("fingerprint", F.sha2(F.array_join("tokens", " "), 256))
    rows = rows.withColumn("reasons", paragraph_reasons(F.col("cleaned_text"), F.col("tokens"), rules))
    source = F.coalesce(F.col(source_col), F.lit(""))
    # a row without provenance is never accepted, so it makes no later row a duplicate
    missing = F.array(F.lit("missing_provenance"))
    eligible = rows.withColumn("_why", F.when(source == "", F.concat("reasons", missing)).otherwise(F.col("reasons")))
    if keep is not None:
        eligible = eligible.select(*dict.fromkeys([order, source_col, *keep, "fingerprint", "reasons", "_why"]))
    # written once: the two sides of the join read the columns they need, instead of working through all texts twice
    eligible = checkpointed(eligible)
    firsts = eligible.where(F.size("_why") == 0).groupBy("fingerprint").agg(F.min(order).alias("_first"))
    late = F.coalesce(F.col(order) > F.col("_first"), F.lit(False))
    found = F.concat(
        "reasons",
        F.when(late, F.array(F.lit("exact_duplicate"))).otherwise(F.array().cast("array<string>")),
        F.when(source == "", missing).otherwise(F.array().cast("array<string>")),
    )
    return eligible.join(firsts, "fingerprint", "left").withColumn("reasons", found).drop("_why", "_first")


# --- questions and answers ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class AnswerRules:
    min_question: int = 20
    max_question: int = 300
    min_answer: int = 80
    max_answer: int = 1600


def classify_question(question: Column, definition_prefixes: Sequence[str] = fixed.DEFINITION_STARTS) -> Column:
    """The first type whose keywords occur; the order of the rules is part of the meaning."""
    low = F.lower(question)
    starts = low.rlike("^(?:" + "|".join(definition_prefixes) + ")")
    return (
        F.when(T.contains_any(low, fixed.COMPARISON_TERMS), "comparison")
        .when(T.contains_any(low, fixed.CLINICAL_TERMS), "clinical")
        .when(starts, "definition")
        .when(T.contains_any(low, fixed.EXPLANATION_TERMS), "explanation")
        .when(T.contains_any(low, fixed.TEXTUAL_TERMS), "textual_interpretation")
        .otherwise("other")
    )


def quality_reasons(question: Column, answer: Column, rules: AnswerRules = AnswerRules()) -> Column:
    low_question, low_answer = F.lower(question), F.lower(answer)
    return reasons(
        (outside(F.length(question), rules.min_question, rules.max_question), "question_length"),
        (~F.endswith(question, F.lit("?")), "question_not_interrogative"),
        (T.contains_any(low_question, META_QUESTIONS), "meta_question"),
        (outside(F.length(answer), rules.min_answer, rules.max_answer), "answer_length"),
        (T.contains_any(low_answer, PLACEHOLDERS), "placeholder_answer"),
        (T.contains_any(low_answer, BOILERPLATE), "boilerplate"),
        (T.contains_any(answer, MOJIBAKE), "mojibake"),
        (T.repeated_ngram(T.tokens(answer)), "repetitive_answer"),
        ((answer != "") & (T.alphabetic_ratio(answer) < 0.55), "low_alphabetic_ratio"),
    )


def assess_quality(pairs: DataFrame, rules: AnswerRules = AnswerRules(), question: str = "question", answer: str = "answer") -> DataFrame:
    """pairs with cleaned question and answer, question_type, reasons and quality_score."""
    from corpusloom.functions import scores as S

    rows = T.with_nfkc(pairs, question, answer).withColumns({question: T.clean_text(F.col(question)), answer: T.clean_text(F.col(answer))})
    rows = rows.withColumn("question_type", classify_question(F.col(question)))
    rows = rows.withColumn("reasons", quality_reasons(F.col(question), F.col(answer), rules))
    return rows.withColumn("quality_score", S.pair_quality(F.length(question), F.length(answer), F.size("reasons")))


def evidence_reason(text: Column, low: int = 240, high: int = 1800) -> Column:
    """The first failed rule of a piece of evidence, null if it is usable."""
    lowered = F.lower(text)
    return (
        F.when(outside(F.length(text), low, high), "evidence_length")
        .when(T.contains_any(lowered, BOILERPLATE), "boilerplate")
        .when(T.contains_any(text, MOJIBAKE), "mojibake")
        .when(T.alphabetic_ratio(text) < 0.6, "low_alphabetic_ratio")
        .when(T.repeated_ngram(T.tokens(text)), "repetitive_evidence")
    )


def legacy_validate(pairs: DataFrame, question: str = "question", answer: str = "answer", order: str = "line_no") -> DataFrame:
    """pairs with `reason`, the first failed rule or duplicate; the first valid row of each normalised text stays."""
    q, a = T.strip(F.coalesce(F.col(question), F.lit(""))), T.strip(F.coalesce(F.col(answer), F.lit("")))
    low = F.lower(a)
    reason = (
        F.when((F.length(q) < 12) | ~F.contains(q, F.lit("?")), "invalid_question")
        .when(outside(F.length(a), 120, 6000), "invalid_answer_length")
        .when(T.contains_any(a, MOJIBAKE), "mojibake")
        .when(T.contains_any(low, LEGACY_PLACEHOLDERS), "refusal_or_placeholder")
        .when(T.contains_any(low, BOILERPLATE), "boilerplate")
    )
    rows = pairs.withColumn("_key", F.sha2(F.lower(T.clean_text(F.concat(q, F.lit("\n"), a))), 256)).withColumn("reason", reason)
    firsts = rows.where(F.col("reason").isNull()).groupBy("_key").agg(F.min(order).alias("_first"))
    late = F.col("reason").isNull() & (F.col(order) > F.col("_first"))
    return rows.join(firsts, "_key", "left").withColumn("reason", F.when(late, "duplicate").otherwise(F.col("reason"))).drop("_key", "_first")


def training_rows(pairs: DataFrame, question: str = "question", answer: str = "answer", source: str | None = None, mojibake: str | None = None) -> DataFrame:
    """The pairs fit for training (a question of 10 characters, an answer of 120 to 6000 without placeholders), with their score."""
    from corpusloom.functions import scores as S

    q, a = F.col(question), F.col(answer)
    fit = (F.length(q) >= 10) & F.length(a).between(120, 6000) & ~T.contains_any(F.lower(a), LEGACY_PLACEHOLDERS)
    origin = F.col(source) if source else F.lit(None).cast("string")
    return pairs.where(fit).withColumn("score", S.row_quality(q, a, origin, F.col(mojibake) if mojibake else F.lit(0)))


def canonical_pair(question: str = "question", answer: str = "answer", **rest: str) -> list[Column]:
    """The canonical columns of a legacy pair; rest: input, source_file and paragraph_index columns, null where absent."""
    bare = lambda c: T.strip(F.coalesce(F.col(c), F.lit("")))
    return [
        F.lit(1).alias("schema_version"),
        bare(question).alias("instruction"),
        (bare(rest["input"]) if "input" in rest else F.lit("")).alias("input"),
        bare(answer).alias("output"),
        (F.col(rest["source_file"]) if "source_file" in rest else F.lit(None).cast("string")).alias("source_file"),
        (F.col(rest["paragraph_index"]) if "paragraph_index" in rest else F.lit(None).cast("int")).alias("paragraph_index"),
        F.length(bare(answer)).alias("char_count"),
    ]


def guard_single_value(df: DataFrame, column: str, expected: str) -> None:
    """Raise if any row's column is not the expected value (a config hash)."""
    if not df.where(~F.col(column).eqNullSafe(F.lit(expected))).limit(1).isEmpty():
        raise ValueError(f"rows with another {column} than {expected}")
