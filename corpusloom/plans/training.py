"""Training sets by generation: a queue of evidence from training sources, the gate for what comes back, and the best of it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import scores as S
from corpusloom.functions import text as T
from corpusloom.operators import audit, dedup, gates, generation, selection
from corpusloom.sources.tables import checkpointed

DUPLICATES = [
    dedup.Rule("duplicate_question", "question_key"), dedup.Rule("duplicate_answer", "answer_key"), dedup.Rule("duplicate_evidence", "evidence_id"),
    dedup.Rule("near_duplicate_question", "question_hash", 14), dedup.Rule("near_duplicate_answer", "answer_hash", 8),
]
FIELDS = ("question", "answer", "evidence_quote", "question_type")


@dataclass(frozen=True)
class TrainingRules:
    evidence: tuple[int, int] = (240, 1800)
    question: tuple[int, int] = (35, 280)
    answer: tuple[int, int] = (120, 900)
    quote: tuple[int, int] = (30, 500)
    min_overlap: float = 0.35
    copy_tokens: int = 40
    queue_size: int = 1100
    per_source: int = 50
    target: int = 500
    seed: int = 3407


def evidence_candidates(paragraphs: DataFrame, sources: Sequence[str], rules: TrainingRules = TrainingRules()) -> DataFrame:
    """Paragraphs (text, source_file, paragraph_index, line_no) of the sources with evidence, its id and score, and reason: the
    first failed rule, or duplicate_evidence for a usable one that an earlier usable one equals."""
    rows = T.with_nfkc(paragraphs.where(F.col("source_file").isin(*sources)), "text").withColumn("evidence", T.clean_text(F.col("text")))
    rows = rows.withColumn("reason", gates.evidence_reason(F.col("evidence"), *rules.evidence)).withColumn("evidence_id", T.fingerprint(F.col("evidence")))
    rows = rows.withColumn("evidence_quality_score", S.paragraph_quality(F.col("evidence")))
    firsts = rows.where("reason is null").groupBy("evidence_id").agg(F.min("line_no").alias("_first"))
    late = F.col("reason").isNull() & (F.col("line_no") > F.col("_first"))
    return rows.join(firsts, "evidence_id", "left").withColumn("reason", F.when(late, "duplicate_evidence").otherwise(F.col("reason"))).drop("_first")


def prepare_queue(paragraphs: DataFrame, sources: Sequence[str], holdouts: Sequence[str], rules: TrainingRules = TrainingRules()) -> tuple[DataFrame, DataFrame]:
    """The queue (queue_index from 1) and the reason counts; raises if a source is held out or too few paragraphs are usable."""
    if shared := sorted(set(sources) & set(holdouts)):
        raise ValueError(f"training and held-out sources overlap: {shared}")
    rows = checkpointed(evidence_candidates(paragraphs, sources, rules))
    usable = rows.where("reason is null")
    ids = selection.evidence_queue(usable, rules.queue_size, rules.per_source, rules.seed, "evidence_id", "source_file", "evidence_quality_score")
    spark = paragraphs.sparkSession
    places = spark.createDataFrame(list(enumerate(ids, 1)), "queue_index int, evidence_id string")
    queue = usable.join(F.broadcast(places), "evidence_id")  # queue_size rows
    queue = queue.select("queue_index", "evidence_id", "source_file", "paragraph_index", "evidence", F.length("evidence").alias("evidence_chars"), "evidence_quality_score")
    return queue, rows.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def tagged_or_json(raw: Column) -> Column:
    """question, answer, evidence_quote and question_type of a model's text, null if one of the first three is missing: tags
    first, else a JSON object, in which a question_type that stands after the closing brace is taken back in."""
    tagged = F.struct(*(T.clean_text(T.tagged_field(raw, f)).alias(f) for f in FIELDS))
    object_ = F.regexp_replace(T.json_payload(raw), r'\}\s*,\s*"question_type"\s*:', ',"question_type":')
    read = F.from_json(object_, ", ".join(f"{f} string" for f in FIELDS))
    parsed = F.struct(*(T.clean_text(read[f]).alias(f) for f in FIELDS))
    full = lambda s: (s["question"] != "") & (s["answer"] != "") & (s["evidence_quote"] != "")
    kind = lambda s: F.when(s["question_type"] != "", s["question_type"]).otherwise(gates.classify_question(s["question"]))
    whole = lambda s: F.struct(*(s[f].alias(f) for f in FIELDS[:3]), kind(s).alias("question_type"))
    return T.let(tagged, lambda t: F.when(full(t), whole(t)).otherwise(T.let(parsed, lambda p: F.when(full(p), whole(p)))))


def generation_reasons(question: Column, answer: Column, evidence: Column, quote: Column, rules: TrainingRules = TrainingRules()) -> Column:
    """All failed rules, in order; generic_source_reference stands once for the question and once for the answer."""
    low_question, low_answer = F.lower(question), F.lower(answer)
    copied = lambda key: (F.size(T.tokens(answer)) >= rules.copy_tokens) & F.contains(key, T.comparison_key(answer))
    # the evidence's words are found once
    return T.let(T.comparison_key(evidence), lambda key: gates.reasons(
        (gates.outside(F.length(question), *rules.question), "question_length"), (~F.endswith(question, F.lit("?")), "question_not_interrogative"),
        (T.contains_any(low_question, gates.META_QUESTIONS), "meta_question"), (T.contains_any(low_question, generation.GENERIC), "generic_source_reference"),
        (T.contains_any(low_question, generation.AMBIGUOUS), "ambiguous_question_reference"), (gates.outside(F.length(answer), *rules.answer), "answer_length"),
        (T.repeated_ngram(T.tokens(answer)), "repetitive_answer"), (T.contains_any(low_answer, generation.GENERIC), "generic_source_reference"),
        (gates.outside(F.length(quote), *rules.quote), "evidence_quote_length"),
        (~F.contains(key, T.comparison_key(quote)), "evidence_quote_not_exact"),
        (T.overlap(T.content_tokens(answer), T.content_words(T.split_key(key))) < rules.min_overlap, "low_answer_evidence_overlap"), (copied(key), "long_direct_copy"),
    ))


def filter_generations(records: DataFrame, queue: DataFrame, sources: Sequence[str], rules: TrainingRules = TrainingRules()) -> tuple[DataFrame, DataFrame]:
    """(accepted rows with sft_id, messages and quality_score, best first by `place`; reason counts).

    records: line_no, evidence_id, raw_generation. A record whose evidence is not queued, or of another source, is rejected.
    """
    places = queue.select("evidence_id", "source_file", "paragraph_index", "evidence", "evidence_quality_score")
    # texts are composed before they are parsed, which changes no tag or brace
    rows = T.with_nfkc(records, "raw_generation").join(places, "evidence_id", "left").withColumn("g", tagged_or_json(F.col("raw_generation")))
    rows = checkpointed(rows.select("line_no", "evidence_id", *places.columns[1:], "g.*"))
    asked, found, evidence = F.col("question"), F.col("answer"), F.coalesce("evidence", F.lit(""))
    failed = F.array(F.lit("generation_parse_error"))
    reasons = F.when(asked.isNull(), failed).otherwise(generation_reasons(asked, found, evidence, F.col("evidence_quote"), rules))
    known = F.coalesce(F.col("source_file").isin(*sources), F.lit(False))
    more = gates.reasons((F.col("evidence").isNull(), "not_in_current_queue"), (~known, "holdout_source"))
    rows = rows.withColumn("reasons", F.concat(reasons, more)).withColumn("question_type", gates.classify_question(asked))
    rows = checkpointed(rows.withColumns({f"{c}_hash": T.simhash(F.col(c)) for c in ("question", "answer")}))
    good, bad = gates.split_by(rows)
    good = good.withColumns({f"{c}_key": T.fingerprint(F.col(c)) for c in ("question", "answer")})
    done = checkpointed(dedup.greedy_deduplicate(good, "line_no", [F.col("line_no")], DUPLICATES))
    repeats = done.where("duplicate_of is not null").groupBy(F.col("duplicate_reason").alias("reason")).agg(F.count("*").alias("n"))
    share = T.overlap(T.content_tokens(F.col("answer")), T.content_tokens(F.col("evidence")))
    kept = done.where("duplicate_of is null").withColumn("answer_evidence_overlap", F.round(share, 4))
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    kept = kept.select(
        T.fingerprint(F.concat("question", F.lit("\n"), "answer")).alias("sft_id"), F.array(message("user", "question"), message("assistant", "answer")).alias("messages"),
        *FIELDS, "answer_evidence_overlap", "source_file", "paragraph_index", "evidence", "evidence_id",
        S.training_quality(F.col("answer_evidence_overlap"), F.col("evidence_quality_score"), F.length("answer")).alias("quality_score"),
    )
    return kept, gates.reason_counts(bad).unionByName(repeats)


def build(accepted: DataFrame, holdouts: Sequence[str], rules: TrainingRules = TrainingRules(), allow_partial: bool = False) -> tuple[DataFrame, dict[str, bool]]:
    """The best `target` rows and the checks; raises if a check fails (too few rows only where partial sets are not allowed)."""
    best = checkpointed(accepted.orderBy(F.desc("quality_score"), F.desc("sft_id")).limit(rules.target))
    unique = lambda c: F.count("*") == F.countDistinct(c)
    tests = {
        "holdout_source_isolation": F.count_if(F.col("source_file").isin(*holdouts)) == 0 if holdouts else F.lit(True),
        "unique_questions": unique(T.fingerprint(F.col("question"))), "unique_answers": unique(T.fingerprint(F.col("answer"))), "unique_evidence": unique("evidence_id"),
    }
    if not allow_partial:
        tests["target_met"] = F.count("*") == rules.target
    return best, audit.require(audit.checks(best, tests))
