import json
import random
import re

import pytest

from corpusloom.plans.curation import SPLITS, Curation

SOURCES = [f"book{i}" for i in range(6)]
CONFIG = {
    "pipeline_version": "p1", "sft_version": "sft1", "benchmark_version": "b1", "seed": 7, "validation_sources": ["book1"], "test_sources": ["book2", "book3"],
    "final_quotas": {
        "train": {"definition": 4, "cross_concept": 2}, "validation": {"definition": 2}, "test": {"definition": 2},
        "challenge": {"unanswerable": 1, "ambiguous": 1, "cross_concept": 1},
    },
    "initial_candidate_multiplier": 1.5, "max_attempts": {"train": 40, "validation": 20, "test": 20, "challenge": 20},
    "candidate_source_caps": {"train": 20, "validation": 20, "test": 20, "challenge": 20}, "final_source_caps": {"train": 3, "validation": 9, "test": 9, "challenge": 9},
    "final_source_floors": {"test": 1},
    "cleaning": {"min_chars": 240, "max_chars": 1800, "min_alphabetic_ratio": 0.6, "repeated_ngram_size": 8, "repeated_ngram_count": 3},
    "hard_filter": {
        "min_question_chars": 35, "max_question_chars": 280, "min_answer_chars": 120, "max_answer_chars": 900, "min_quote_chars": 30, "max_quote_chars": 500,
        "min_answer_source_overlap": 0.35, "long_copy_min_tokens": 40, "question_simhash_distance": 4, "answer_simhash_distance": 4,
    },
    "generation": {"prompt_version": "g1", "batch_size": 2}, "judge": {"parse_retries": 1},
}


def paragraphs():
    r = random.Random(5)
    word = lambda: "".join(r.choice("bdklmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4)))
    rows = []
    for s in SOURCES:
        for i in range(24):
            rows.append((f"{' '.join(word() for _ in range(60)).capitalize()}.", s, i))
    rows += [("too short", "book0", 99), (rows[0][0], "book0", 100), (rows[1][0] + " more", None, 3), (None, "book4", 77)]
    return [(n, *r) for n, r in enumerate(rows, 1)]


def write(prompts):
    """A generator that fails on two prompts at once, and on every seventh source at all."""
    if len(prompts) > 1:
        raise RuntimeError("one at a time")
    kind = re.search(r"Type of question: (\w+)", prompts[0])[1]
    source = prompts[0].split("Source:\n", 1)[1].strip()
    parts = source.split("\n\n")
    words = source.split()
    if len(words[0]) % 7 == 0:
        return ["no payload"]
    quotes = [" ".join(p.split()[5:15]) for p in parts[: 2 if kind == "cross_concept" else 1]]
    question = f"What do {' '.join(words[2:9])} mean here?"
    payload = {"question": question, "answer": f"They mean {' and '.join(words[20:40])}.", "evidence_quotes": quotes, "question_type": kind}
    return [f"```json\n{json.dumps(payload)}\n```"]


def judge(prompts):
    out = []
    for p in prompts:
        kind = re.search(r"Intended type: (\w+)", p)[1]
        flags = dict.fromkeys(("answerable", "faithful", "evidence_supports_answer", "self_contained", "challenge_valid"), True)
        flags["answerable"] = kind not in ("unanswerable", "ambiguous")
        flags["self_contained"] = kind != "ambiguous"
        scores = dict.fromkeys(("answerability", "faithfulness", "evidence_support", "self_contained"), 5)
        more = {"overclaim": False, "contradiction": False, "unsupported_claims": [], "reason_codes": [], "reason": "fine"}
        out.append(json.dumps(flags | more | {"scores": scores, "canonical_question_type": kind}))
    return out


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("curation")
    raw = spark.createDataFrame(paragraphs(), "line_no bigint, text string, source_file string, paragraph_index bigint")
    plan = Curation(spark, CONFIG, f"file://{root}/stages", lambda: write, lambda: judge, lambda: "2020-01-01T00:00:00")
    return plan, plan.run(raw, expected=(3, 1, 2)), str(root)


def test_cleaning_counts(made):
    clean = made[1]["clean"]
    assert clean["accepted"] == 144 and clean["rejected"] == 4
    assert clean["rejection_counts"] == {"exact_duplicate": 1, "length": 2, "low_alphabetic_ratio": 1, "missing_provenance": 1}


def test_quotas_caps_and_isolation(made):
    plan, result, _ = made
    rows = plan.read("final").collect()
    for split in SPLITS:
        own = [r for r in rows if r.split == split]
        types = {}
        for r in own:
            types[r.question_type] = types.get(r.question_type, 0) + 1
            assert r.source_file in plan.sources(split)
        assert types == CONFIG["final_quotas"][split]
    assert {r.source_file for r in rows if r.split == "test"} == {"book2", "book3"}
    assert all(result["audit"].values())
    contexts = [c for r in plan.read("queues").collect() for c in r.context_ids]
    assert len(contexts) == len(set(contexts))


def test_offsets_and_quotes(made):
    plan = made[0]
    for r in plan.read("final").collect():
        assert len(r.evidence_spans) == (2 if r.challenge_category == "cross_concept" else 1)
        texts = {c.paragraph_id: c.text for c in r.contexts}
        for s in r.evidence_spans:
            assert texts[s.paragraph_id][s.start : s.end] == s.source_quote


def test_passes_resume(made):
    plan = made[0]
    assert plan.generate("train") == 0 and plan.judge("train", "rubric") == 0
    status = {r["split"]: r for r in plan.status().collect()}
    assert status["train"]["queues"] == status["train"]["generations"] >= 6


def test_export_and_release(made):
    plan, _, root = made
    exported = plan.export(f"{root}/out")
    assert exported["test_seal"]["sealed"] and plan.audit(exported=exported, folder=f"{root}/out")
    again = plan.export(f"{root}/again")
    assert again["artifact_sha256"] == exported["artifact_sha256"]
    quotas = {"train": {"definition": 2}, "validation": {"definition": 1}, "test": {"definition": 2}, "challenge": {"unanswerable": 1}}
    profile = {"release_version": "r1", "excluded_question_types": ["other", "ambiguous"], "final_quotas": quotas, "source_floors": {"test": 1}}
    chosen = plan.select(profile=profile)
    assert {s: chosen[s]["rows"] for s in SPLITS} == {"train": 2, "validation": 1, "test": 2, "challenge": 1}
    assert all(plan.audit(profile=profile).values())
    with pytest.raises(ValueError, match="excluded"):
        plan.select(profile=profile | {"excluded_question_types": ["definition"]})
    with pytest.raises(RuntimeError, match="lacks"):
        plan.select(profile=profile | {"final_quotas": quotas | {"train": {"definition": 400}}})


def test_foreign_configuration_is_refused(spark, made):
    plan = made[0]
    other = Curation(spark, CONFIG | {"seed": 8}, plan.root, lambda: write)
    with pytest.raises(ValueError, match="another configuration"):
        other.sources("train")
    with pytest.raises(ValueError, match="lacks"):
        Curation(spark, {}, plan.root)
