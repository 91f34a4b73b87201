"""Scores as columns, rounded to four places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.fixed import MEETING_MARKERS as MEETING
from corpusloom.functions.fixed import QUOTE_MARKS
from corpusloom.functions.fixed import TYPE_SIGNALS as SIGNALS

CONCEPTS = SIGNALS["cross_concept"]


def rounded(value: Column) -> Column:
    """To four places, by the binary value (Spark's own round goes by its decimal notation)."""
    return F.round(value * 10_000) / 10_000


def least(value: Column, bound: float) -> Column:
    return F.least(value, F.lit(bound))


def paragraph_quality(text: Column) -> Column:
    return rounded(1 - least(F.abs(F.length(text) - 700) / 7000, 0.2))


def signal_hits(lowered: Column, signals: list[str]) -> Column:
    return sum((T.occurrences(lowered, s) for s in signals), F.lit(0))


def type_suitability(text: Column, kind: str, low: Column | None = None, concepts: Column | None = None) -> Column:
    """low and concepts: the lower-cased text and its concept hits, where several types share them."""
    low = F.lower(text) if low is None else low
    concepts = signal_hits(low, CONCEPTS) if concepts is None else concepts
    score = 0.65 * paragraph_quality(text) + 0.07 * F.least(signal_hits(low, SIGNALS.get(kind, [])), F.lit(5))
    score = score + 0.025 * F.least(concepts, F.lit(4))
    if kind == "textual_interpretation":
        score = score + F.when(T.contains_any(text, QUOTE_MARKS), 0.08).otherwise(0.0)
    if kind == "definition":
        score = score - F.when(T.contains_any(low, MEETING), 0.15).otherwise(0.0)
    return rounded(score)


def pair_quality(question_chars: Column, answer_chars: Column, failed: Column) -> Column:
    score = 1 - least(F.abs(answer_chars - 650) / 5000, 0.15) - least(F.abs(question_chars - 110) / 2000, 0.08) - 0.08 * failed
    return rounded(F.greatest(score, F.lit(0.0)))


def training_quality(overlap: Column, evidence_quality: Column, answer_chars: Column) -> Column:
    return rounded(0.55 * overlap + 0.25 * evidence_quality + 0.2 * (1 - least(F.abs(answer_chars - 350) / 1800, 0.2)))


def hard_quality(overlap: Column, evidence_quality: Column) -> Column:
    return rounded(0.7 * overlap + 0.3 * evidence_quality)


def row_quality(question: Column, answer: Column, source: Column, mojibake: Column, preferred: int = 1200) -> Column:
    """Whole number: nearness to the preferred length, a question mark, a source, no damage."""
    return (
        1000 - F.abs(F.length(answer) - preferred)
        + F.when(F.contains(question, F.lit("?")), 50).otherwise(0)
        + F.when(F.coalesce(source, F.lit("")) != "", 25).otherwise(0)
        - F.when(F.coalesce(mojibake, F.lit(0)) != 0, 250).otherwise(0)
    )


WEIGHTS = {"faithfulness": 0.30, "evidence_support": 0.25, "answerability": 0.20, "self_contained": 0.15}


def consensus_score(first: Column, second: Column, overlap: Column) -> Column:
    """first and second: structs of scores from 1 to 5."""
    score = sum((w * ((first[k] + second[k]) / 2) / 5 for k, w in WEIGHTS.items()), F.lit(0.0))
    return rounded(score + 0.10 * F.least(overlap, F.lit(1.0)))
