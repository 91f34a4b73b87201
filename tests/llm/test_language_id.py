import numpy as np

from corpusloom.llm import language_id as L

EN, DE = "the house and the river with others ", "das haus und der fluss mit anderen "


def test_batch_is_the_sum_over_ngrams():
    rng = np.random.default_rng(0)
    model = L.Model(["a", "b"], np.log(rng.random((L.BUCKETS, 2))).astype(np.float32), np.log([0.4, 0.6]))
    texts = [None, "", "12 !", "x", "Hello wörld", "²", "a b c " * 50, "ab"]
    names, scores = model.predict(texts)
    for text, name, score in zip(texts, names, scores, strict=True):
        plain = L.letters(text)
        if not plain:
            assert (name, score) == ("und", 0)
            continue
        total = model.prior + sum(model.table[b].sum(axis=0, dtype=float) for b in L.ngram_buckets(plain))
        chance = np.exp(total - total.max())
        assert name == ["a", "b"][int(total.argmax())] and abs(score - (chance / chance.sum()).max()) < 1e-4
    assert [names[i] for i in (0, 1, 2, 5)] == ["und"] * 4


def test_very_long_texts_are_scored_in_slices(monkeypatch):
    rng = np.random.default_rng(1)
    model = L.Model(["a", "b", "c"], np.log(rng.random((L.BUCKETS, 3))).astype(np.float32), np.log([0.3, 0.3, 0.4]))
    texts = ["".join(rng.choice(list("abc défg"), size=n)) for n in (1, 9, 10, 11, 40, 3000, 7)]
    want = model.predict(texts)
    monkeypatch.setattr(L, "GATHERED", 30)
    got = model.predict(texts)
    assert got[0] == want[0] and np.allclose(got[1], want[1])


def test_rows(spark):
    rows = [(i, (EN if i % 2 else DE) * (1 + i % 3), "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame([*rows, (40, None, "en"), (41, "", None), (42, EN, None), (42, EN, None)], "doc_id long, text string, lang string")
    docs = docs.selectExpr("*", "'x' as score")
    model = L.fit(docs)
    got = L.predict_languages(docs, model).collect()
    assert len(got) == 44 and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "de") for r in got if r.doc_id < 40)
    assert [r.lang_pred for r in got if r.doc_id >= 40] == ["und", "und", "en", "en"]
    nothing = L.fit(docs.limit(0))
    assert {r.lang_pred for r in L.predict_languages(docs, nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from corpusloom.llm.queries import op5_language_id

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op5_language_id(spark, sf).collect() if r.held_out and truth[r.doc_id]]
    assert len(rows) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in rows) > 0.97 * len(rows)
