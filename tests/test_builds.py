import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import gates
from corpusloom.plans import evaluation, training
from corpusloom.plans.training import TrainingRules

R = random.Random(11)


def word():
    return "".join(R.choice("bdklmnprst") + R.choice("aeiou") for _ in range(R.randint(2, 4)))


PARAGRAPHS = [(n, " ".join(word() for _ in range(60)).capitalize() + ".", f"s{n % 5}", n // 5) for n in range(40)]


def paragraph_frame(spark):
    return spark.createDataFrame(PARAGRAPHS, "line_no int, text string, source_file string, paragraph_index int")


def test_evaluation_sets(spark):
    rules = evaluation.EvaluationRules(4, 4, 1, 3, answers=gates.AnswerRules(20, 300, 80, 1600))
    rows = [(n, f"What is {' '.join(t.split()[:4])}?", t) for n, t, *_ in PARAGRAPHS]
    rows += [(100, "What is this that was asked before?", PARAGRAPHS[0][1]), (101, "No question", PARAGRAPHS[1][1]), (102, "What is it that no source says?", "lorem " * 30 + ".")]
    built = evaluation.build(spark.createDataFrame(rows, "line_no int, question string, answer string"), paragraph_frame(spark), rules)
    assert all(built["checks"].values())
    reasons = {r["reason"]: r["n"] for r in built["rejections"].collect()}
    assert reasons["duplicate_answer"] == 1 and reasons["question_not_interrogative"] == 1 and reasons["repetitive_answer"] == 1
    a, b = ({r.source_file for r in built[s].collect()} for s in ("validation", "test"))
    assert not a & b and not (a | b) & set(built["training_sources"])
    assert all(r.provenance_method == "exact" for r in built["test"].collect())
    with pytest.raises(ValueError, match="do not fill"):
        evaluation.build(spark.createDataFrame(rows, "line_no int, question string, answer string"), paragraph_frame(spark), evaluation.EvaluationRules(100, 100, 1, 3))


def test_training_set(spark):
    rules = TrainingRules(queue_size=12, per_source=5, target=6)
    sources = ["s0", "s1", "s2"]
    twice = spark.createDataFrame([(90, PARAGRAPHS[0][1], "s0", 90), (91, "short", "s0", 91), (92, None, "s1", 92)], "line_no int, text string, source_file string, paragraph_index int")
    queue, reasons = training.prepare_queue(paragraph_frame(spark).union(twice), sources, ["s4"], rules)
    assert {r.reason: r.n for r in reasons.collect()} == {"duplicate_evidence": 1, "evidence_length": 2}
    rows = queue.orderBy("queue_index").collect()
    assert [r.queue_index for r in rows] == list(range(1, 13)) and {r.source_file for r in rows} == set(sources)
    with pytest.raises(ValueError, match="overlap"):
        training.prepare_queue(paragraph_frame(spark), sources, ["s0"], rules)

    def text(r, form="tags"):
        w = r.evidence.split()
        asked, told, quote = f"What do {' '.join(w[2:10])} mean here?", f"They mean {' and '.join(w[20:40])}.", " ".join(w[5:15])
        if form == "tags":
            return f"<question>{asked}</question>\n<answer>{told}</answer><evidence_quote>{quote}</evidence_quote>"
        return f'{{"question": "{asked}", "answer": "{told}", "evidence_quote": "{quote}"}}, "question_type": "definition"}}'

    records = [(i, r.evidence_id, text(r, "tags" if i % 2 else "json")) for i, r in enumerate(rows)]
    records += [(50, rows[0].evidence_id, text(rows[0])), (51, rows[1].evidence_id, "nothing"), (52, "unknown", text(rows[2])), (53, rows[3].evidence_id, text(rows[3]).replace("They mean", "The text states"))]
    accepted, why = training.filter_generations(spark.createDataFrame(records, "line_no int, evidence_id string, raw_generation string"), queue, sources, rules)
    counts = {r["reason"]: r["n"] for r in why.collect()}
    assert counts["duplicate_question"] == 1 and counts["generation_parse_error"] == 1 and counts["not_in_current_queue"] == 1 and counts["generic_source_reference"] == 1
    assert accepted.count() == 12
    best, checks = training.build(accepted, ["s4"], rules)
    assert all(checks.values()) and best.count() == 6
    assert best.agg(F.min("quality_score")).first()[0] >= sorted((r.quality_score for r in accepted.collect()), reverse=True)[5]
    with pytest.raises(ValueError, match="target_met"):
        training.build(accepted.limit(3), ["s4"], rules)
    assert training.build(accepted.limit(3), ["s4"], rules, allow_partial=True)[1]["unique_evidence"]
