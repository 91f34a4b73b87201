import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import audit, consensus, dedup, gates, generation, provenance, selection
from corpusloom.sources import files, sinks


def distance(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


def sequential(rows, rules):
    """rows: (id, values) in order."""
    kept, out = [], {}
    for i, v in rows:
        out[i] = None
        for name, k, d in rules:
            if d is None:
                hits = [(0, j) for j, w in kept if v[k] is not None and w[k] == v[k]]
            else:
                hits = [(distance(v[k], w[k]), j) for j, w in kept if distance(v[k], w[k]) <= d]
            if hits:
                n, j = min(hits)
                out[i] = (name, j, n)
                break
        else:
            kept.append((i, v))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_deduplication_is_the_sequential_loop(spark, seed):
    r = random.Random(seed)
    centers = [r.getrandbits(63) for _ in range(4)]
    rows = []
    for i in range(60):
        h = r.choice(centers)
        for _ in range(r.randint(0, 5)):
            h ^= 1 << r.randrange(63)
        rows.append((i, (r.choice(["a", "b", None, *(f"k{x}" for x in range(30))]), h)))
    frame = spark.createDataFrame([(i, *v) for i, v in rows], "id int, k string, h bigint")
    rules = [dedup.Rule("exact", "k"), dedup.Rule("near", "h", 3)]
    got = dedup.greedy_deduplicate(frame, "id", [F.col("id")], rules).collect()
    want = sequential(rows, [("exact", 0, None), ("near", 1, 3)])
    assert {r.id: r.duplicate_reason and (r.duplicate_reason, r.duplicate_of, r.duplicate_distance) for r in got} == want


@pytest.mark.parametrize(("bits", "block"), [(3, 16), (8, 16), (8, 1000), (14, 64)])
def test_near_pairs_are_those_of_brute_force(spark, bits, block):
    r = random.Random(bits)
    values = {r.getrandbits(64) - 2**63 for _ in range(150)} | {0, -1}
    for v in sorted(values)[:60]:
        for _ in range(r.randint(1, 4)):
            for _ in range(r.randint(1, bits // 2 + 1)):
                v ^= 1 << r.randrange(63)
            values.add(v)
    frame = spark.createDataFrame([(v,) for v in [*values, *values, None]], "h bigint")
    got = [tuple(x) for x in dedup.near_pairs(frame, bits, block).collect()]
    want = {(a, b, distance(a, b)) for a in values for b in values if a < b and distance(a, b) <= bits}
    assert len(got) == len(want) > 50 and set(got) == want


def test_near_pairs_of_many_hashes_make_few_rows(spark):
    # keys of three bands made 165 rows a hash, and candidates were rows of a join
    r = random.Random(5)
    values = [r.getrandbits(64) - 2**63 for _ in range(3000)]
    frame = dedup.near_pairs(spark.createDataFrame([(v,) for v in values], "h bigint"), 8)
    assert frame.count() == sum(distance(a, b) <= 8 for i, a in enumerate(values) for b in values[:i])
    written = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in written and "bit_count" not in written


def test_chain_keeps_both_ends(spark):
    frame = spark.createDataFrame([(1, 0b0), (2, 0b11), (3, 0b1111)], "id int, h bigint")
    got = dedup.greedy_deduplicate(frame, "id", [F.col("id")], [dedup.Rule("near", "h", 2)]).collect()
    assert {r.id for r in got if r.duplicate_of is None} == {1, 3}


def test_paragraph_reasons(spark):
    rows = [(1, "ISBN 123456789 �", "s"), (2, "word " * 60, "s"), (3, " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)), "s")]
    rows += [(4, rows[2][1], "s"), (5, rows[2][1], None), (6, None, "s")]
    found = gates.clean_corpus(spark.createDataFrame(rows, "line_no int, text string, source string")).collect()
    got = {r.line_no: r.reasons for r in found}
    assert got == {
        1: ["length", "publisher_metadata", "mojibake", "low_alphabetic_ratio"], 2: ["repeated_ngram"], 3: [], 4: ["exact_duplicate"],
        5: ["exact_duplicate", "missing_provenance"], 6: ["length", "low_alphabetic_ratio"],
    }


def test_a_rejected_row_makes_no_duplicate(spark):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    found = gates.clean_corpus(spark.createDataFrame([(1, text, None), (2, text, "s")], "line_no int, text string, source string"))
    assert {r.line_no: r.reasons for r in found.collect()} == {1: ["missing_provenance"], 2: []}


def test_quality_and_legacy_rules(spark):
    answer = "Desire is structured like a language and speaks in the gaps of what the subject means to say. " * 2
    rows = [(1, "What is the structure of desire?", answer), (2, "Could you clarify this please", "As an AI I cannot"), (3, "What is the structure of desire?", answer)]
    frame = spark.createDataFrame(rows, "line_no int, question string, answer string")
    got = {r.line_no: r for r in gates.assess_quality(frame).collect()}
    assert got[1].reasons == [] and got[1].question_type == "definition"
    assert got[2].reasons == ["question_not_interrogative", "meta_question", "answer_length", "placeholder_answer"]
    assert {r.line_no: r.reason for r in gates.legacy_validate(frame).collect()} == {1: None, 2: "invalid_question", 3: "duplicate"}


def test_provenance_methods(spark):
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(10)]
    p = [" ".join(words[:20]), " ".join(words[20:40]), " ".join(words[40:])]
    paragraphs = [(p[0], "s", 7, 1), (p[1], "s", 8, 2), (p[2], "t", 1, 3), (p[2], "t", 5, 4), (None, "t", 6, 5)]
    index = provenance.paragraph_index(spark.createDataFrame(paragraphs, "text string, source string, paragraph_index int, line_no int"))
    answers = [("exact", p[1]), ("both", f"{p[0]} {p[1]}"), ("part", f"{p[2]} and more that no source has at all"), ("twice", p[2]), ("none", "other words")]
    got = {r.id: r for r in provenance.match(spark.createDataFrame(answers, "id string, answer string"), index).collect()}
    assert set(got) == {"exact", "both", "part", "twice"}
    assert (got["exact"].method, got["exact"].paragraph_index, got["exact"].score) == ("exact", 8, 1.0)
    assert (got["both"].method, got["both"].score, got["both"].evidence) == ("consecutive_prefix", 1.0, f"{p[0]} {p[1]}")
    assert got["part"].method == "normalized_prefix" and 0.6 < got["part"].score < 0.75 and got["part"].paragraph_index == 1
    assert got["twice"].method == "normalized_prefix" and got["twice"].score == 1.0


def greedy_quota(rows, quotas, cap):
    loads, out = {}, []
    for kind, target in quotas.items():
        left = [r for r in rows if r[1] == kind]
        for _ in range(target):
            fits = [r for r in left if loads.get(r[2], 0) < cap]
            if not fits:
                break
            best = min(fits, key=lambda r: (loads.get(r[2], 0), -r[3], r[0]))
            left.remove(best)
            out.append(best[0])
            loads[best[2]] = loads.get(best[2], 0) + 1
    return out


def test_quota_selection_is_the_sequential_loop(spark):
    r = random.Random(3)
    rows = [(f"c{i:03}", r.choice("xyz"), r.choice("abcde"), r.randint(0, 9) / 10) for i in range(120)]
    frame = spark.createDataFrame(rows, "candidate_id string, question_type string, source_file string, quality_score double")
    quotas = {"y": 20, "x": 15, "z": 30}
    chosen, deficits = selection.select_with_quotas(frame, quotas, 11)
    want = greedy_quota(rows, quotas, 11)
    assert sorted(r[0] for r in chosen.collect()) == sorted(want)
    assert sum(deficits.values()) == 65 - len(want) and all(n > 0 for n in deficits.values())


def test_floors_and_source_cap(spark):
    rows = [(f"{s}{i}", "definition", s, 1 - i / 100) for s in "ab" for i in range(3)]
    frame = spark.createDataFrame(rows, "candidate_id string, question_type string, source_file string, quality_score double")
    chosen, deficits = selection.select_with_quotas(frame, {"definition": 4}, 3, 2, ["a", "b"])
    assert sorted(r[0] for r in chosen.collect()) == ["a0", "a1", "b0", "b1"] and deficits == {}
    ids = selection.select_with_source_cap(frame, 4, 2, "candidate_id", "question_type", "source_file", ["quality_score"])
    assert len(set(ids)) == 4 and sum(i[0] == "a" for i in ids) == 2
    with pytest.raises(ValueError, match="under source cap"):
        selection.select_with_source_cap(frame, 5, 2, "candidate_id", "question_type", "source_file", ["quality_score"])


def test_holdouts_and_refills():
    sizes = {f"s{i}": 10 for i in range(6)}
    a, b, rest = selection.reserve_holdouts(sizes, (10, 10), 3, 5)
    assert len(a) == len(b) == 2 and len(rest) == 2 and not a & b
    with pytest.raises(ValueError, match="do not fill"):
        selection.reserve_holdouts(sizes, (100, 100), 3, 5)
    assert selection.refill_requests({"x": 2, "y": 10}, {}, ["x", "y"]) == {"x": 10, "y": 22}
    assert selection.refill_requests({}, {"s": 2}, ["x", "y"]) == {"x": 5, "y": 5}
    assert selection.refill_requests({"x": 20}, {"s": 2}, ["x", "y"]) == {"x": 44}


def test_queue_pairs_are_the_sequential_loop(spark):
    r = random.Random(4)
    rows = [(f"p{i:02}", "s", i + i // 7 * 6, f"real other desire {'word ' * r.randint(20, 500)}") for i in range(24)]
    frame = spark.createDataFrame(rows, "paragraph_id string, source_file string, paragraph_index int, cleaned_text string")
    from corpusloom.functions import scores as S

    fit = {x.paragraph_id: x.s for x in frame.select("paragraph_id", S.type_suitability(F.col("cleaned_text"), "cross_concept").alias("s")).collect()}
    used, want = set(), []
    for a in sorted(rows, key=lambda x: (fit[x[0]], x[0]), reverse=True):
        near = [b for b in rows if 1 <= abs(a[2] - b[2]) <= 10 and len(a[3]) + len(b[3]) <= 3000 and b[0] not in used]
        if a[0] not in used and near and len(want) < 6:
            b = max(near, key=lambda x: (fit[x[0]], x[0]))
            used |= {a[0], b[0]}
            want.append((a[0], b[0]))
    got = selection.queue_pairs(frame, "cross_concept", 6).orderBy("turn").collect()
    assert [(x.first_id, x.second_id) for x in got] == want


def test_consensus_rules(spark):
    flags = "true,true,true,true,false,false,true"
    frame = spark.createDataFrame([("train", None), ("challenge", "unanswerable"), ("challenge", "cross_concept")], "split string, category string")

    def payload(kind, **changed):
        values = dict(zip(consensus.FLAGS, (f == "true" for f in flags.split(",")), strict=True)) | {k: v for k, v in changed.items() if k in consensus.FLAGS}
        scores = F.struct(*(F.lit(changed.get(s, 5)).alias(s) for s in consensus.SCORES))
        none = F.array().cast("array<string>")
        parts = [F.lit(v).alias(k) for k, v in values.items()]
        return F.struct(*parts, scores.alias("scores"), F.lit(kind).alias("canonical_question_type"), none.alias("unsupported_claims"), none.alias("reason_codes"), F.lit("").alias("reason"))

    why = lambda a, b: [r[0] for r in frame.select(consensus.consensus_reasons(a, b, F.col("split"), F.col("category"))).collect()]
    assert why(payload("definition"), payload("definition")) == [[], ["judge_type_out_of_scope", "judge_challenge_type_mismatch", "invalid_unanswerable_challenge"], ["judge_type_out_of_scope", "judge_challenge_type_mismatch"]]
    low = why(payload("definition", answerability=3), payload("definition", faithful=False, overclaim=True))
    assert low[0] == ["judge_not_faithful", "judge_score_below_threshold", "judge_overclaim"] or low[0] == ["judge_not_faithful", "judge_overclaim", "judge_score_below_threshold"]
    fine = payload("unanswerable", answerable=False, answerability=1)
    assert why(fine, fine)[1] == []
    assert why(payload("definition"), payload("comparison"))[0] == ["judge_type_disagreement"]


def test_hard_filter_quotes(spark):
    source = "Desire is born in the gap between need and demand. The subject speaks—before it knows what it says, and the other hears it."
    context = [("p1", "s", 0, source)]
    question = "How does the text relate desire, need and demand to one another?"
    answer = "Desire is born between need and demand, since the subject speaks before it knows what the other hears in what it says."
    fine = question.replace("How does the text relate", "What relates")
    raw = [
        f'{{"question": "{fine}", "answer": "{answer}", "evidence_quotes": ["The subject speaks before it knows", "desire is born in the gap between need"]}}',
        f'{{"question": "{question}", "answer": "{answer}", "evidence_quote": "words that the source does not have at all"}}', "nothing",
    ]
    rows = [(f"c{i}", r, context, source, "train", None, 0.9) for i, r in enumerate(raw)] + [("c3", raw[0].split(', "evidence_quotes"')[0] + "}", context, source, "challenge", "unanswerable", 0.9)]
    schema = "candidate_id string, raw_generation string, contexts array<struct<paragraph_id:string,source_file:string,paragraph_index:int,text:string>>, source_text string, split string, challenge_category string, evidence_quality_score double"
    got = {r.candidate_id: r for r in generation.hard_filter(spark.createDataFrame(rows, schema), generation.HardRules((20, 300), (80, 1600))).collect()}
    assert got["c0"].reasons == [] and len(got["c0"].evidence_quotes) == 1 and len(got["c0"].discarded_extra_quotes) == 1
    span = got["c0"].evidence_spans[0]
    assert source[span.start : span.end] == span.source_quote
    assert "evidence_quote_not_contiguous" in got["c1"].reasons and got["c2"].reasons == ["generation_parse_error"]
    assert got["c3"].derived_evidence_quote and got["c3"].reasons == []


def test_checks_and_seal(spark):
    frame = spark.createDataFrame([(2, "b"), (1, "a")], "id int, t string")
    assert audit.require(audit.checks(frame, {"rows": F.count("*") == 2})) == {"rows": True}
    with pytest.raises(ValueError, match="rows"):
        audit.require(audit.checks(frame, {"rows": F.count("*") == 3}))
    import hashlib

    assert audit.seal(frame, "id", F.col("t")).first().seal == hashlib.sha256(b"a\nb").hexdigest()
    assert audit.canonical_sha256({"b": 1, "a": "é"}) == hashlib.sha256('{"a":"é","b":1}'.encode()).hexdigest()
    metrics = spark.createDataFrame([("x", 1, 0.5), ("x", 1, 0.5), ("y", 1, None)], "experiment string, step int, eval_loss double")
    assert audit.best_experiment(metrics).first().experiment == "x"
    joined = audit.join_metrics(spark.createDataFrame([("x",), ("z",)], "experiment string"), metrics).orderBy("experiment").collect()
    assert len(joined[0].evaluations) == 1 and joined[1].evaluations is None


def test_files(spark, tmp_path):
    path = f"{tmp_path}/x.jsonl"
    with open(path, "w") as f:
        f.write('{"a":1,"b":"x"}\n\nnot json\n[1]\n{"a":2,"c":null}\n')
    assert [(r.line_no, r.a) for r in files.read_lenient(spark, path, "a int").orderBy("line_no").collect()] == [(1, 1), (5, 2)]
    assert [(r.line_no, r.error) for r in files.read_audited(spark, path, "a int").orderBy("line_no").collect()] == [(1, None), (3, "invalid_json"), (4, "invalid_json"), (5, None)]
    with pytest.raises(ValueError, match="line 3"):
        files.read_strict(spark, path, "a int")
    with open(path, "w") as f:
        f.writelines(f'{{"a": {i}}}\n' for i in range(1, 3001))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = files.read_strict(spark, path, "a int")
        assert rows.rdd.getNumPartitions() > 1 and rows.where("a <> line_no").count() == 0 and rows.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    frame = spark.createDataFrame([(2, "é"), (1, None)], "b int, a string")
    assert sinks.write_canonical(frame, f"{tmp_path}/c.jsonl", "b") == 2
    assert open(f"{tmp_path}/c.jsonl", encoding="utf-8").read() == '{"a": null, "b": 1}\n{"a": "é", "b": 2}\n'
    assert sinks.write_review(frame, f"{tmp_path}/r.csv", ["a", "z", "b"], "b") == 2
    assert open(f"{tmp_path}/r.csv", "rb").read() == "﻿a,z,b\n,,1\né,,2\n".encode()
    for name in "ab":
        with open(f"{tmp_path}/{name}.txt", "w") as f:
            f.write(f"{name} line\n\nnext {name}")
    assert sorted(r.source_file for r in files.read_texts(spark, f"{tmp_path}/*.txt").collect()) == ["a.txt", "b.txt"]
    assert files.row_count(spark, f"{tmp_path}/none") == 0 and files.optional(spark, f"{tmp_path}/none", "a int").count() == 0
    sinks.append_event(f"{tmp_path}/log.md", "clean", "completed", {"rows": 1}, "now")
    assert "## now clean: completed" in open(f"{tmp_path}/log.md").read()


def test_paragraphs_of_files(spark):
    body = "A first para-\ngraph with many plain words that says something of use to the reader and does not end too soon, as it must be long."
    text = f"﻿{body}\r\n\r\n12\r\n\r\nshort\n\n{body.replace('first', 'second')}\n\nISBN {body}"
    got = generation.file_paragraphs(spark.createDataFrame([("a.txt", text)], "source_file string, value string")).orderBy("paragraph_index").collect()
    assert [r.paragraph_index for r in got] == [0, 1] and "paragraph with" in got[0].text and "second" in got[1].text


def test_stream_answers_each_row_once(spark, tmp_path):
    from corpusloom.streaming import resume

    queue, records = f"{tmp_path}/queue", f"{tmp_path}/records"
    echo = lambda: lambda prompts: [p.upper() for p in prompts]
    go = lambda: resume.answer_stream(spark, queue, "candidate_id string, prompt string", records, f"{tmp_path}/check", echo).awaitTermination()
    spark.createDataFrame([("1", "a"), ("2", "b")], "candidate_id string, prompt string").write.parquet(queue)
    go()
    spark.createDataFrame([("2", "b"), ("3", "c")], "candidate_id string, prompt string").write.mode("append").parquet(queue)
    go()
    got = spark.read.parquet(records).collect()
    assert sorted((r.candidate_id, r.raw_generation) for r in got) == [("1", "A"), ("2", "B"), ("3", "C")]


def test_lines_of_a_folder_are_numbered_file_after_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part-{i}.txt").write_text("".join(f"{i}-{j}\n" for j in range(5 + i)))
    lines = files.numbered_lines(spark, str(tmp_path))
    assert [(r.line_no, r.value) for r in lines.orderBy("line_no").collect()] == [(n, v) for n, v in enumerate((f"{i}-{j}" for i in range(3) for j in range(5 + i)), 1)]
    assert "ResolvedHint (strategy=broadcast)" in lines._jdf.queryExecution().analyzed().toString() or "strategy=broadcast" in lines._jdf.queryExecution().optimizedPlan().toString()


def test_matching_writes_keys_and_compares_equal_paragraphs_once(spark):
    start = " ".join(f"w{i}" for i in range(12))
    paragraphs = [(f"{start} x{i % 3}", f"s{i}", 0, i) for i in range(300)] + [("next one", "s0", 1, 300), ("and one more", "s0", 2, 301)]
    index = provenance.paragraph_index(spark.createDataFrame(paragraphs, "text string, source string, paragraph_index int, line_no int"))
    assert "tokens" not in index.columns
    answers = [("a", f"{start} x0 next one and"), ("b", f"{start} x2"), ("c", f"{start} x1 y"), ("d", "next one")]
    got = {r.id: (r.source, r.paragraph_index, r.evidence, r.score, r.method) for r in provenance.match(spark.createDataFrame(answers, "id string, answer string"), index).collect()}
    near = "consecutive_prefix"
    assert got == {
        "a": ("s0", 0, f"{start} x0 next one and one more", 1.0, near), "b": ("s2", 0, f"{start} x2", 1.0, "normalized_prefix"),
        "c": ("s1", 0, f"{start} x1", round(13 / 14, 4), "normalized_prefix"), "d": ("s0", 1, "next one", 1.0, "exact"),
    }


def test_clean_corpus_writes_the_wanted_columns_only(spark):
    raw = spark.createDataFrame([(1, "some text", "s"), (2, "some text", None)], "line_no int, text string, source string")
    found = gates.clean_corpus(raw, keep=["fingerprint"])
    assert set(found.columns) == {"line_no", "source", "fingerprint", "reasons"}
    assert {r.line_no: r.reasons for r in found.collect()} == {r.line_no: r.reasons for r in gates.clean_corpus(raw).collect()}


@pytest.mark.parametrize("names", ["ab", "ba"])
def test_best_experiment_of_equal_losses_is_the_first(spark, names):
    metrics = spark.createDataFrame([("z", 0.5, 0), *((n, 0.0, i) for i, n in enumerate(names, 1)), ("y", None, 3)], "experiment string, eval_loss double, first int")
    for rows in (metrics, metrics.orderBy("experiment"), metrics.orderBy(F.desc("experiment"))):
        assert audit.best_experiment(rows.coalesce(1), order="first").first().experiment == names[0]
