import itertools
import random

import numpy as np

from corpusloom.llm import toxicity as T


def brute_marginals(emission, moves, start):
    n = len(emission)
    total, hot = 0.0, np.zeros(n)
    for tags in itertools.product((0, 1), repeat=n):
        logp = start[tags[0]] + sum(e for e, t in zip(emission, tags, strict=True) if t) + sum(moves[a][b] for a, b in zip(tags, tags[1:], strict=False))
        p = np.exp(logp)
        total += p
        hot += p * np.array(tags)
    return hot / total


def test_marginals_match_enumeration(monkeypatch):
    rng = np.random.default_rng(3)
    moves, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    sizes = [1, 5, 9, 2, 7, 1]
    emission = rng.normal(scale=3, size=sum(sizes))
    first = np.zeros(len(emission), dtype=bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    want = np.concatenate([brute_marginals(e, moves, start) for e in np.split(emission, np.cumsum(sizes)[:-1])])
    for width in (1, 4, 256):
        monkeypatch.setattr(T, "BLOCK", width)
        got, moved, begun = T.marginals(emission, first, moves, start, pairs=True)
        assert np.allclose(got, want, atol=1e-9)
        assert np.isclose(moved.sum(), len(emission) - len(sizes)) and np.isclose(begun.sum(), len(sizes))
        assert np.isclose(moved[:, 1].sum() + begun[1], want.sum())


CLEAN = [f"{a}{b}" for a in ("bo", "la", "nim", "ter") for b in ("ra", "sol", "vik", "un", "do")]


def corpus(seed, n):
    r, out = random.Random(seed), []
    for i in range(n):
        words = [r.choice(CLEAN) for _ in range(r.randint(5, 60))]
        label = int(r.random() < 0.3)
        if label:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(["grobble", "xyzzq" + r.choice(CLEAN)]))
        out.append((" ".join(words).capitalize(), label))
    return out


def test_learns_words_and_stems():
    field = T.fit_field(corpus(1, 300))
    texts = corpus(2, 200)
    scores, spans = field.score([t for t, _ in texts])
    assert sum((s >= 0.5) == bool(label) for s, (_, label) in zip(scores, texts, strict=True)) >= 196
    for s, (text, label), score in zip(spans, texts, scores, strict=True):
        if label and score >= 0.5:
            assert all(text[a:b].lower().startswith(("grobble", "xyzzq")) for a, b, _ in s)


def test_rows(spark):
    texts = corpus(1, 200)
    docs = spark.createDataFrame([(i, t, 0) for i, (t, _) in enumerate(texts)] + [(200, None, 0), (201, "", 0), (0, texts[0][0], 0)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, k) for i, (_, k) in enumerate(texts)] + [(999, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    field = T.fit(docs, labels)
    got = T.score_documents(docs, field).collect()
    assert len(got) == 203 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.score for r in got}[200] == {r.doc_id: r.score for r in got}[201] == 0
    left = T.without_toxic(docs, field)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in got if r.score < 0.5}
    nothing = T.fit(docs, labels.limit(0))
    assert {r.score for r in T.score_documents(docs, nothing).collect()} == {0.0}
    assert T.score_documents(docs.limit(0), field).count() == 0


def test_held_out_accuracy(spark):
    from corpusloom.llm.queries import op9_toxicity

    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op9_toxicity(spark, sf).collect() if r.held_out and r.doc_id in truth]
    bad = [r for r in rows if truth[r.doc_id] == 1]
    # an eighth of the toxic labels stands on junk without any toxic word
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad)
    assert sum(r.predicted for r in rows if truth[r.doc_id] == 0) <= 0.01 * len(rows)
