import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline as P
from corpusloom.llm import byte_bpe, common, decontaminate, simhash, toxicity
from tests.llm.test_secrets import brute as base_spans
from tests.llm.test_simhash import brute_components


def test_stages_match_a_brute_force_version(spark, tmp_path):
    docs = [
        (0, "alpha beta gamma delta " * 30, "en", "s"), (1, "Alpha beta gamma delta " * 30, "en", "s"), (2, None, "en", "s"), (3, "", "de", "s"),
        (4, "my password = abcdefghijklmnop and more words to follow here", "en", "t"),
        (5, "intro words " + "one two three four five six seven eight nine ten" + " outro words", "en", "t"),
        (6, "the quick brown fox jumps over a lazy dog again", "en", "t"), (6, "the quick brown fox jumps over a lazy dog again", "en", "t"),
    ] + [(10 + i, f"grobble number {i} is " + " ".join(f"w{i}x{k}" for k in range(20)), "en", "u") for i in range(15)] + [
        (40 + i, f"clean number {i} is " + " ".join(f"w{i}y{k}" for k in range(20)), "en", "u") for i in range(40)
    ]
    rows = [(i, t, lang, source, len(t or "")) for i, t, lang, source in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(10 + i, 0, 1) for i in range(15)] + [(40 + i, 1, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(0, "One two three four five; six seven eight nine ten!")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    field = toxicity.fit(frame, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    left = [r for r in docs if field.score([r[1]])[0][0] < 0.5]
    assert not any("grobble" in (r[1] or "") for r in left) and sum(r[0] >= 40 for r in left) == 40
    fps = [int(x) for x in simhash.fingerprints([r[1] for r in left])]
    groups = brute_components(fps, [r[0] for r in left])
    left = [r for k, r in enumerate(left) if groups[r[0]] == r[0] and r[0] not in {x[0] for x in left[:k]}]
    matcher = decontaminate.Matcher(items)
    left = [r for r in left if not matcher.match(r[1])]
    want, encoding = set(), None
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text, *_ in left:
        text = text or ""
        for s, _, e in sorted(base_spans(text), reverse=True):
            text = text[:s] + "[SECRET]" + text[e:]
        ids = encoding.encode_ordinary(text)
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in P.run(spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want
    assert {4, 6, 40} <= {r[0] for r in got} and not {1, 3, 5} & {r[0] for r in got}


def test_stages_keep_the_columns_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES[1:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() > 0, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_stages_take_nulls_repeats_clashing_columns_and_empty_tables(spark, tmp_path):
    names = ("_tag", "tag", "id", "fp", "doc", "spans", "row", "label", "score", "h", "word", "ids", "group", "key", "item_id")
    long = "word and other words " * 20_000
    rows = [
        (1, "some words that stand here for once", "en", "s", 36), (None, None, None, None, None), (2, "", "en", "s", 0), (3, long, "de", "s", len(long)), (3, long, "de", "s", len(long)),
        (4, None, "en", None, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(*r, *(f"{n}!" for n in names)) for r in rows], schema)
    for name, kind in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in P.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert {r.doc_id for r in got} >= {1, 3} and all(r[n] == f"{n}!" for r in got for n in names), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    got = P.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert len(got) == len(rows) and {r.n_tokens for r in got if r.doc_id in (None, 2, 4)} == {0}
    assert P.STAGES[4][1](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_byte_bpe_takes_small_blocks_and_workers_keep_one_table(spark, monkeypatch):
    made = []
    kept = lambda kind, key: common.kept(kind, key, lambda: made.append((kind, key)) or (kind, key))
    monkeypatch.setattr(common, "_kept", {})
    assert [kept("matcher", 1), kept("matcher", 1), kept("word cutter", 1)] == [("matcher", 1), ("matcher", 1), ("word cutter", 1)]
    assert len(made) == 2 and len(common._kept) == 1
    taken = {}
    monkeypatch.setattr(byte_bpe, "round_trip", lambda *a, **k: taken.update(k))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    dict(P.STAGES)["byte_bpe"](spark, None, "")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert taken["block_words"] <= 1 << 16 and taken["block_codes"] <= 1 << 22


def test_stages_have_heaps_collected_and_the_fit_starts_no_python_workers(spark, monkeypatch):
    # one process has both heaps here: the driver's share is taken out, so what is counted is what tasks have collected
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    docs = spark.createDataFrame([(i, f"{'grobble' if i % 3 == 0 else 'clean'} text w{i}x w{i}y") for i in range(60)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int").repartition(3)
    docs.count(), labels.count()
    before = full()
    spark.sparkContext._jvm.System.gc()
    alone = full() - before
    before = full()
    common.spare_heaps(spark)
    assert full() - before > alone >= 1
    seen = []
    monkeypatch.setattr(P, "spare_heaps", lambda s: seen.append("heaps"))
    P._in_small_batches(lambda *a: seen.append("stage"))(spark, None, "")
    assert seen == ["heaps", "stage", "heaps"]
    # rows handed to createDataFrame one by one become an RDD of Python workers on every executor
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **k: 1 / 0)
    field = toxicity.fit(docs, labels)
    assert field.trained and field.score(["grobble", "clean"])[0].tolist()[0] > 0.5
