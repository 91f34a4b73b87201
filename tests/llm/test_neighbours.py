import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import neighbours as N


def brute(rows, k):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine[i] = np.array(v, dtype=float)
    out = {}
    for q in fine:
        if q % 20 == 0:
            near = sorted((-float(sum(fine[q] * fine[i])), i) for i in fine if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def found(frame, **more):
    out = {}
    for r in N.nearest(frame, F.col("id") % 20 == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def frame_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(map(lambda x: None if x is None else float(x), v)), 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")


def test_small_table_with_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(60, None), (61, [0.0] * 8), (62, [float("nan")] * 8), (63, [None] * 8), (80, [1.0] * 7), (None, [1.0] * 8)]
    got, want = found(frame_of(spark, rows)), brute(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)
    assert found(frame_of(spark, rows).limit(0)) == {}
    assert found(frame_of(spark, rows[:1])) == {}


def test_recall_with_unequal_norms(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(1500, 8)) * rng.uniform(0.5, 2, size=(1500, 1))
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    got, want = found(frame_of(spark, rows), cell=128), brute(rows, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.95 * sum(map(len, want.values()))


def test_introductions_are_better_than_what_is_listed():
    rng = np.random.default_rng(0)
    v = rng.integers(-100, 100, size=(6, 5)).astype(np.int8)
    members = []
    for i in range(6):
        head = np.zeros(1, dtype=N._MEMBER)
        head["name"], head["least"], head["fresh"] = i + 10, 50, i < 2
        members.append(head.tobytes() + v[i].tobytes())
    near = v.astype(int) @ v.astype(int).T
    got = N._introduced(members, 6)
    want = {(a + 10, b + 10) for a in range(6) for b in range(6) if a != b and (a < 2 or b < 2) and near[a, b] > 50}
    assert set(zip(got["a"], got["b"], strict=True)) == want


@pytest.mark.parametrize("cell", [64])
def test_large_cells_are_dealt(spark, cell):
    rng = np.random.default_rng(4)
    center = rng.normal(size=8)
    rows = [(i, (center + 1e-3 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(400)]
    share = recall(frame_of(spark, rows), rows, cell=cell)
    assert share.mean() >= 0.9


def recall(frame, rows, **more):
    """The least recall of a query; other vectors with the score of the last wanted count as well."""
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], dtype=np.float32).astype(np.float64)
    got, share = found(frame, **more), []
    for q in np.flatnonzero(ids % 20 == 0):
        score = v @ v[q]
        score[q] = -np.inf
        last = np.sort(score)[-20]
        at = {int(i): x for i, x in zip(ids, score, strict=True)}
        share.append(np.mean([at[i] >= last - 1e-14 * abs(last) for i, _ in got[int(ids[q])]]))
        assert len(got[int(ids[q])]) == 20
    return np.array(share)


def spread(seed, n, noise):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 16))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v[: n // 3] = v[0] + noise * rng.normal(size=(n // 3, 16))
    v /= np.linalg.norm(v, axis=1)[:, None]
    return rng.permutation(v)


def vectors_of(spark, v):
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    return frame_of(spark, rows), rows


def test_recall_in_a_tight_group(spark):
    share = recall(*vectors_of(spark, spread(5, 3000, 1e-3)), cell=128)
    assert share.mean() >= 0.95 and np.mean(share >= 0.9) >= 0.95


def test_recall_with_one_long_row(spark):
    v = spread(6, 3000, 1e-2)
    v[1] *= 1000
    share = recall(*vectors_of(spark, v), cell=128)
    assert share.mean() >= 0.95 and np.mean(share >= 0.9) >= 0.95


def test_recall_of_independent_vectors_with_production_parameters(spark):
    share = recall(*vectors_of(spark, np.random.default_rng(0).normal(size=(6000, 64))))
    assert share.mean() >= 0.9


def test_recall_of_clusters_with_production_parameters(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(40, 32))[rng.integers(40, size=4000)] + 0.3 * rng.normal(size=(4000, 32))
    share = recall(*vectors_of(spark, v))
    assert share.mean() >= 0.9


def test_every_node_is_reached_and_descent_runs_on_small_tables(spark, monkeypatch):
    turns = []
    descend = N._descend
    monkeypatch.setattr(N, "_descend", lambda *a: turns.append(a[5]) or descend(*a))
    frame, rows = vectors_of(spark, np.random.default_rng(3).normal(size=(300, 8)))
    assert recall(frame, rows).mean() >= 0.9 and turns
    edges = spark.createDataFrame([(a, b, -float(abs(a - b))) for a in range(50) for b in range(3) if a != b], "a long, b long, near double")
    lists = {(r.at, r.node) for r in N.both_ways(edges, 2).collect()}
    assert {node for _, node in lists} == set(range(50)) and max(sum(at == x for at, _ in lists) for x in range(3, 50)) <= 4


@pytest.mark.parametrize("held", [1 << 20, 8])
def test_a_shard_is_searched_as_by_brute_force(monkeypatch, held):
    monkeypatch.setattr(N, "HELD", held)
    rng = np.random.default_rng(8)
    v, q = rng.integers(-3, 4, size=(300, 4)).astype("<f4"), rng.integers(-3, 4, size=(40, 4)).astype(float)
    names, cells = rng.permutation(300) + 1000, rng.integers(12, size=300)
    shard = N.Shard([names[:100], names[100:]], [cells[:100], cells[100:]], [v[:100], v[100:]])
    wanted = [rng.permutation(15)[: rng.integers(1, 15)].astype("<i4") for _ in q]
    low = np.where(np.arange(40) % 3 == 0, 5.0, -np.inf)
    who, name, score = shard.search(q, [w.tobytes() for w in wanted], low, 5, 64, 1e-9)
    for i in range(40):
        near = sorted((-float(v[n] @ q[i]), int(names[n])) for n in range(300) if cells[n] in wanted[i] and v[n] @ q[i] >= low[i])
        got = sorted((-float(s), int(n)) for s, n in zip(score[who == i], name[who == i], strict=True))
        assert got[:5] == near[:5] and set(got) <= set(near)


def test_beams_are_widened_and_queries_go_once_to_a_shard(spark, monkeypatch):
    v = np.random.default_rng(10).normal(size=(4000, 12))
    widths, asked = [], []
    measured, asks = N.measured_beam, N._asks
    monkeypatch.setattr(N, "measured_beam", lambda *a: widths.append((len(a[2].centres), *measured(*a))) or widths[-1][1:])
    monkeypatch.setattr(N, "_asks", lambda *a: asked.append(asks(*a)) or asked[-1])
    frame, rows = vectors_of(spark, v)
    share = recall(frame, rows, cell=16, beam=4)
    (count, beam, found), = widths
    assert 4 < beam < count and found >= N.WANTED and share.mean() >= 0.9
    pairs = [(r.q, r.shard, len(r.cells) // 4) for a in asked for r in a.select("q", "shard", "cells").collect()]
    assert len({(q, s) for q, s, _ in pairs}) == len(pairs) and sum(n for _, _, n in pairs) == 200 * beam
