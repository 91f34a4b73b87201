"""Prompts as columns: templates with {named} places that columns fill."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

GENERATION = """Write one question and its answer for a study set, from the source below and nothing else.
Type of question: {kind}. {guidance}
The question names what it is about, so that a reader without the source understands it. The answer is two to five sentences
in your own words. Quote {quotes} unbroken piece(s) of the source, {least} to {most} characters each, that prove the answer.
Return one JSON object: question, answer, evidence_quotes (a list), question_type.

Source:
{source}
"""
JUDGE = """Review a question, its answer and the quoted evidence against the source. {stance}
Return one JSON object with the booleans answerable, faithful, evidence_supports_answer, self_contained, overclaim, contradiction
and challenge_valid; scores, an object of whole numbers from 1 to 5 for answerability, faithfulness, evidence_support and
self_contained; canonical_question_type; the lists unsupported_claims and reason_codes; and reason.

Split: {split}. Intended type: {kind}.
Question: {question}
Answer: {answer}
Evidence: {evidence}

Source:
{source}
"""
GUIDANCE = {
    "definition": "Ask what a concept in the source means.",
    "explanation": "Ask why or how something in the source works.",
    "comparison": "Ask how two things in the source differ or agree.",
    "textual_interpretation": "Ask what a wording in the source says.",
    "cross_concept": "Ask how two concepts, one from each part of the source, are related; quote both parts.",
    "clinical_application": "Ask how the source bears on practice with patients.",
    "other": "Ask for something else that the source settles.",
    "unanswerable": "Ask something near the source that it does not answer, and answer that it does not.",
    "ambiguous": "Ask something that can be read in two ways, and say in the answer which ways.",
    "concept_confusion": "Ask with a mistaken use of a concept, and put it right in the answer.",
}
STANCES = {
    "rubric": "Judge each point on its own, by the source alone.",
    "adversarial": "Look for any reason to reject: claims without support, missing context, evidence that proves something else.",
}


def render(template: str, places: Mapping[str, Column]) -> Column:
    """The template with each {name} replaced by that column's text (null as nothing); braces of the texts stay as they are."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(F.coalesce(places[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)))


def looked_up(table: Mapping[str, str], key: Column) -> Column:
    out = F.lit("")
    for name, text in table.items():
        out = F.when(key == name, F.lit(text)).otherwise(out)
    return out


def generation_prompt(kind: Column, source: Column, quote_chars: tuple[int, int] = (30, 500), template: str = GENERATION) -> Column:
    places = {"kind": kind, "guidance": looked_up(GUIDANCE, kind), "source": source, "least": F.lit(quote_chars[0]), "most": F.lit(quote_chars[1])}
    return render(template, places | {"quotes": F.when(kind == "cross_concept", F.lit("two")).otherwise(F.lit("one"))})


def judge_prompt(name: str, template: str = JUDGE) -> Column:
    """The prompt of a pass over rows with split, target_question_type, question, answer, evidence_quotes and source_text."""
    columns = {"split": "split", "kind": "target_question_type", "question": "question", "answer": "answer", "source": "source_text"}
    places = {k: F.col(c) for k, c in columns.items()} | {"stance": F.lit(STANCES[name]), "evidence": F.array_join("evidence_quotes", "\n")}
    return render(template, places)
