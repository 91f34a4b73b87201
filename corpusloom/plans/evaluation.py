"""Evaluation sets out of question-answer pairs: quality, provenance, greedy de-duplication, held-out sources, source caps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import audit, dedup, gates, provenance, selection
from corpusloom.sources.tables import checkpointed

RULES = [
    dedup.Rule("duplicate_answer", "answer_fingerprint"),
    dedup.Rule("duplicate_question", "question_fingerprint"),
    dedup.Rule("duplicate_evidence", "evidence_fingerprint"),
]
REVIEW_FIELDS = ("qa_id", "split", "question_type", "question", "answer", "evidence", "source_file", "paragraph_index", "provenance_score", "reviewer", "verdict", "notes")


@dataclass(frozen=True)
class EvaluationRules:
    validation_size: int = 250
    test_size: int = 250
    seed: int = 3407
    per_source: int = 50
    minimum_provenance: float = 0.72
    answers: gates.AnswerRules = gates.AnswerRules(35, 280, 160, 1800)


def candidates(pairs: DataFrame, paragraphs: DataFrame, rules: EvaluationRules = EvaluationRules()) -> DataFrame:
    """pairs (line_no, question, answer) with quality, provenance and reasons. paragraphs: text, source_file, paragraph_index,
    line_no. Only pairs that pass the rules are looked for in the paragraphs."""
    rows = checkpointed(gates.assess_quality(pairs.select("line_no", "question", "answer"), rules.answers))
    index = provenance.paragraph_index(T.with_nfkc(paragraphs, "text"), source="source_file")
    found = provenance.match(rows.where(F.size("reasons") == 0), index, "line_no", "answer").withColumnsRenamed(
        {"id": "_line", "source": "source_file", "score": "provenance_score", "method": "provenance_method"}
    )
    rows = rows.join(found, rows["line_no"] == found["_line"], "left").drop("_line")
    lost = (F.size("reasons") == 0) & (F.coalesce("provenance_score", F.lit(0.0)) < rules.minimum_provenance)
    rows = rows.withColumn("reasons", F.when(lost, F.array(F.lit("provenance_not_recovered"))).otherwise(F.col("reasons")))
    return rows.withColumns(
        {"qa_id": T.fingerprint(F.concat("question", F.lit("\n"), "answer")), **{f"{c}_fingerprint": T.fingerprint(F.col(c)) for c in ("question", "answer", "evidence")}}
    )


def build(pairs: DataFrame, paragraphs: DataFrame, rules: EvaluationRules = EvaluationRules(), version: str = "evaluation_v1") -> dict:
    """validation and test (DataFrames), rejections (reason counts), training_sources and checks; raises where sources do not
    fill the sets or a check fails."""
    rows = checkpointed(candidates(pairs, paragraphs, rules))
    good, bad = gates.split_by(rows)
    order = [-F.col("quality_score"), -F.col("provenance_score"), T.descending(F.col("qa_id")), F.col("line_no")]
    # pairs with equal texts have equal answers, so all but the first go
    done = checkpointed(dedup.greedy_deduplicate(good, "line_no", order, RULES))
    kept = done.where("duplicate_of is null")
    repeats = done.where("duplicate_of is not null").groupBy(F.col("duplicate_reason").alias("reason")).agg(F.count("*").alias("n"))
    first = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("first")
    sizes = {r["source_file"]: r["n"] for r in kept.groupBy("source_file").agg(first, F.count("*").alias("n")).orderBy("first").collect()}
    validation, test, training = selection.reserve_holdouts(sizes, (rules.validation_size, rules.test_size), rules.seed, rules.per_source)
    sets = {}
    for name, size, sources in (("validation", rules.validation_size, validation), ("test", rules.test_size, test)):
        pool = kept.where(F.col("source_file").isin(*sources))
        ids = selection.select_with_source_cap(pool, size, rules.per_source, "qa_id", "question_type", "source_file", ["quality_score", "provenance_score"])
        columns = {"split": F.lit(name), "dataset_version": F.lit(version), "review_status": F.lit("pending_human_review")}
        sets[name] = checkpointed(pool.where(F.col("qa_id").isin(*ids)).withColumns(columns).drop("duplicate_reason", "duplicate_of", "duplicate_distance", "reasons"))
    both = sets["validation"].unionByName(sets["test"])
    shared = {k: selection.leaked(sets["validation"], sets["test"], k).count() for k in ("source_file", "question_fingerprint", "answer_fingerprint", "evidence_fingerprint")}
    tests = {f"{k}_disjoint": F.lit(n == 0) for k, n in shared.items()}
    tests |= {
        "validation_size": F.count_if(F.col("split") == "validation") == rules.validation_size, "test_size": F.count_if(F.col("split") == "test") == rules.test_size,
        "training_sources_left": F.lit(bool(training)), "provenance": F.min("provenance_score") >= rules.minimum_provenance,
        "answers_unique": F.count("*") == F.countDistinct("answer_fingerprint"),
    }
    checks = audit.require(audit.checks(both, tests))
    return sets | {"rejections": gates.reason_counts(bad).unionByName(repeats), "training_sources": sorted(training), "checks": checks}
