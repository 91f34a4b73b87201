import re

import numpy as np
import pytest
import xxhash

from corpusloom.llm import simhash as S
from corpusloom.llm.components import connected_components


def brute_fp(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(fps, ids):
    group = list(range(len(fps)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                group[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: least[find(i)] for i, d in enumerate(ids)}


TEXTS = [
    None, "", " \t\n", "One", "one two", "one two three", "ONE two  three", "a b c a b c a b c a", "É é É é", "x y z w",
    "the quick brown fox jumps over the lazy dog " * 30, "the quick brown fox jumps over the lazy dog " * 30 + "end",
]


def test_fingerprints_match_the_definition():
    assert [int(x) for x in S.fingerprints(TEXTS)] == [brute_fp(t) for t in TEXTS]


def test_chunked_long_text(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    monkeypatch.setattr(S, "CHUNK", 256)
    assert int(S.fingerprints([text, "a b"])[0]) == brute_fp(text)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n // 4, dtype=np.uint64) * np.uint64(2)
    values = np.repeat(base, 4)
    for _ in range(2):
        values ^= np.uint64(1) << rng.integers(0, 64, len(values), dtype=np.uint64)
    return np.unique(values)


@pytest.mark.parametrize("n", [2, 40, 900])
def test_index_finds_every_link(n):
    values = clustered(max(4, n), n)
    found = set()
    for a, b in S.GrayIndex(values).links(values, 2):
        found |= {(int(x), int(y)) for x, y in zip(a, b, strict=True) if x < y}
    i, j = np.triu_indices(len(values), 1)
    near = S.popcount(values[i] ^ values[j]) <= 2
    assert found == set(zip(i[near].tolist(), j[near].tolist(), strict=True))


@pytest.mark.parametrize("hot", [4096, 3])
def test_components_match_brute_force(spark, hot):
    values = clustered(240, 7)
    few = np.uint64(0xABCD0000ABCD0000) ^ (np.arange(60, dtype=np.uint64) * np.uint64(0x10001))
    values = np.unique(np.concatenate([values, few]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    groups = {r.node: r.component for r in connected_components(S.fingerprint_edges(frame, hot_key=hot)).collect()}
    ids = [int(v) for v in values.view(np.int64)]
    want = brute_components([int(v) for v in values], ids)
    assert {i: groups.get(i, i) for i in ids} == want


def test_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "x"), (None, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = [brute_fp(t) for t in TEXTS]
    want = brute_components(fps, list(range(len(TEXTS))))
    assert {r.id: r.component_id for r in got if r.id is not None} == want
    assert [r.component_id for r in got if r.id is None] == [0]
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_components_that_do_not_settle_raise(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)], "a bigint, b bigint")
    with pytest.raises(RuntimeError):
        connected_components(edges, max_rounds=1)
