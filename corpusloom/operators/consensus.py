"""Strict consensus of two reviewer passes, and which rows a pass still has to see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import scores as S
from corpusloom.operators.gates import reasons
from corpusloom.operators.selection import CHALLENGE_TYPES, REGULAR_TYPES

FLAGS = ("answerable", "faithful", "evidence_supports_answer", "self_contained", "overclaim", "contradiction", "challenge_valid")
SCORES = ("answerability", "faithfulness", "evidence_support", "self_contained")
PAYLOAD = (
    "struct<" + ",".join(f"{f}:boolean" for f in FLAGS) + ",scores:struct<" + ",".join(f"{s}:int" for s in SCORES) + ">,"
    "canonical_question_type:string,unsupported_claims:array<string>,reason_codes:array<string>,reason:string>"
)
MINIMUM = 4


def latest(records: DataFrame, key: str, order: str) -> DataFrame:
    """The last record of each key."""
    rest = [c for c in records.columns if c != key]
    return records.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def pending(queue: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of the queue that no record is about."""
    return queue.join(done.select(key).distinct(), key, "left_anti")


def valid_payload(p: Column) -> Column:
    fine = p.isNotNull()
    for f in FLAGS:
        fine = fine & p[f].isNotNull()
    for s in SCORES:
        fine = fine & p["scores"][s].between(1, 5)
    fine = fine & p["canonical_question_type"].isin(*REGULAR_TYPES, *CHALLENGE_TYPES)
    for f in ("unsupported_claims", "reason_codes", "reason"):
        fine = fine & p[f].isNotNull()
    return F.coalesce(fine, F.lit(False))


def consensus_reasons(first: Column, second: Column, split: Column, category: Column, minimum: int = MINIMUM) -> Column:
    """Why two payloads do not agree to accept a row; empty if they do."""
    pair = (first, second)
    either = lambda test: test(first) | test(second)
    kind = lambda p: p["canonical_question_type"]
    category = F.coalesce(category, F.lit(""))
    challenge = split == "challenge"
    strict = ~challenge | (category == "cross_concept")
    no = lambda *names: lambda p: _any(~p[n] for n in names)
    allowed = F.when(challenge, F.array(*map(F.lit, CHALLENGE_TYPES))).otherwise(F.array(*map(F.lit, REGULAR_TYPES)))
    per_payload = []
    for p in pair:
        per_payload += [
            (strict & ~p["answerable"], "judge_not_answerable"), (strict & ~p["faithful"], "judge_not_faithful"),
            (strict & ~p["evidence_supports_answer"], "judge_evidence_not_supportive"),
            (strict & ~p["self_contained"], "judge_not_self_contained"), (strict & ~p["challenge_valid"], "judge_invalid_ordinary_qa"),
        ]
    unanswerable = either(lambda p: p["answerable"] | no("challenge_valid", "faithful", "evidence_supports_answer", "self_contained")(p))
    ambiguous = either(lambda p: p["answerable"] | p["self_contained"] | no("challenge_valid", "faithful")(p))
    confusion = either(no("challenge_valid", "faithful", "evidence_supports_answer", "self_contained"))
    verdicts = []
    for p in pair:
        low = F.least(*(p["scores"][s] for s in SCORES)) < minimum
        verdicts += [(p["overclaim"], "judge_overclaim"), (p["contradiction"], "judge_contradiction"), (strict & low, "judge_score_below_threshold")]
    found = reasons(
        (kind(first) != kind(second), "judge_type_disagreement"),
        (~F.array_contains(allowed, kind(first)) | ~F.array_contains(allowed, kind(second)), "judge_type_out_of_scope"),
        (challenge & ((kind(first) != category) | (kind(second) != category)), "judge_challenge_type_mismatch"),
        *per_payload,
        (~strict & (category == "unanswerable") & unanswerable, "invalid_unanswerable_challenge"),
        (~strict & (category == "ambiguous") & ambiguous, "invalid_ambiguous_challenge"),
        (~strict & (category == "concept_confusion") & confusion, "invalid_concept_confusion_challenge"),
        *verdicts,
    )
    return F.array_distinct(found)


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def build_consensus(rows: DataFrame, rubric: DataFrame, adversarial: DataFrame, key: str = "candidate_id", order: str = "line_no") -> DataFrame:
    """rows with rubric and adversarial payloads, reasons, and for accepted ones question_type, quality_score and grade.

    Judge tables have key, order and judge_result (PAYLOAD); the last record of a key counts.
    """
    sides = []
    for name, table in (("rubric", rubric), ("adversarial", adversarial)):
        last = latest(table.select(key, order, "judge_result"), key, order)
        sides.append(last.select(key, F.col("judge_result").alias(name), F.lit(True).alias(f"_{name}")))
    both = rows.join(sides[0], key, "left").join(sides[1], key, "left")
    missing = F.col("_rubric").isNull() | F.col("_adversarial").isNull()
    valid = valid_payload(F.col("rubric")) & valid_payload(F.col("adversarial"))
    why = consensus_reasons(F.col("rubric"), F.col("adversarial"), F.col("split"), F.col("challenge_category"))
    one = lambda text: F.array(F.lit(text))
    both = both.withColumn("reasons", F.when(missing, one("missing_judge_pass")).when(~valid, one("invalid_judge_payload")).otherwise(why))
    accepted = F.size("reasons") == 0
    score = S.consensus_score(F.col("rubric.scores"), F.col("adversarial.scores"), F.col("answer_source_overlap"))
    return both.withColumns(
        {
            "question_type": F.when(accepted, F.col("rubric.canonical_question_type")),
            "quality_score": F.when(accepted, score),
            "review_status": F.when(accepted, F.lit("automated_consensus")),
            "benchmark_grade": F.when(accepted & (F.col("split") != "train"), F.lit("silver")),
        }
    ).drop("_rubric", "_adversarial")
