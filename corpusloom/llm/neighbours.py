"""Approximate nearest neighbours by inner product: cells of near vectors, a graph of the cells built by NN-descent, searched greedily.

Equal vectors are one node, named by their least id; the KEEP least ids of each are kept, which is all that a list of KEEP - 1
neighbours can need. Nodes are lengthened by one component to equal norms, so nearness (minus the squared distance then) is
symmetric while the index is built; searches go by inner products. Vectors are kept as they are given (32 or 64 bits) and
compared in double precision everywhere, so neither tight groups nor a few long rows blur what is nearer.

Cells: centres are fitted by k-means on a sample of nodes by hash (SAMPLED a centre, bounded in rows and bytes, the only
sample of the index); then every node goes to the cell of its nearest centre. A centre stands for `cell` nodes, and for more
where MOST_CELLS centres are not enough. Near cells share a shard, which is what one task holds.

Graph: random hyperplanes deal the centres in TREES ways, and the START nearest of each part begin the lists of DEGREE
neighbours. Then, however few the centres, NN-descent rounds follow until few lists change: a centre introduces its neighbours
and some of those that list it to each other, in Spark joins, and pairs better than what a member lists replace it.

Search: each query keeps a beam of cells, starting from its own; each round the neighbours of its best unexpanded cells are
scored, until the beam has no unexpanded cell. All nodes of the beam's cells are compared with the query, by matrix
products in the tasks that hold the shards: a query goes to a shard as one row, not once for each node. The query's nearest shard comes
first, and only nodes that reach the k-th best found there are taken from the others, which loses none. How wide beams
must be depends on the vectors, so the index measures it: the neighbours of SAMPLE queries, the first by hash, are found
exactly, and beams are widened until their cells hold WANTED of them. A beam of all cells is an exact search.

Defined results: null vectors and ids, zero vectors, those with null or non-finite components and those of a length other
than the commonest (the greatest of equally common ones) take no part; where there are fewer candidates all are listed;
ties go to smaller ids; repeated ids are separate candidates only if their vectors differ; other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import discard, materialize

K = 20
#: Nodes of a cell on average, cells at most, and sampled nodes a centre, at most and in bytes.
CELL = 64
MOST_CELLS = 8192
SAMPLED = 8
SAMPLE_BYTES = 64 << 20
#: Turns of k-means.
TURNS = 3
#: Bytes of a shard's vectors.
SHARD_BYTES = 64 << 20
DEGREE = 32
GRAPH_CELL = 512
TREES = 8
START = 16
PART = 12
GIVEN = 12
CHANGED = 0.05
#: Cells of a beam at least; measured beams are wider.
BEAM = 32
#: A beam's cells that are expanded in one round: this part of it.
EXPAND = 2
#: Cells that list a cell and that a search goes on to from it, besides those that it alone must lead to.
BACK = 16
SAMPLE = 64
WANTED = 0.95
#: Found nodes of a query in a shard that are kept, at most, where rounding leaves open which are the best.
RESCORED = 64
#: Rounds after which building raises, a safety: it ends far before.
MOST_ROUNDS = 100
#: Halvings of cells that the hyperplanes leave large, at most.
HALVINGS = 32
#: Rounding error of an inner product, as a part of the greatest squared norm.
ROUNDING = 1e-12
#: Cells of the greatest centres, from which every search starts too: near many queries though few cells list them.
ENTRIES = 32
#: Queries that walk the graph together, and that a shard is compared with together; found pairs held before the best are kept.
WALKED, ASKED, HELD = 256, 2048, 1 << 20


def _top(rows: DataFrame, key: str | list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key; Spark also cuts to k before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def _kind(vectors: DataFrame, vector_col: str) -> str:
    """The numpy type in which vectors are kept."""
    return "<f4" if isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), FloatType) else "<f8"


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    kind = "float" if _kind(vectors, vector_col) == "<f4" else "double"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (length[0] if length else 0))


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """node (least id), v and ids (the keep least ids) of each distinct vector."""
    some = _top(rows.distinct(), "v", [F.col("id")], keep)
    some = some.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return some.select(F.get("ids", 0).alias("node"), "v", "ids")


def _norm2(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def _matrix(data: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(data), dtype=kind).reshape(len(data), -1).astype(np.float64)


def _near(v: np.ndarray, w: np.ndarray, norm2: float | None) -> np.ndarray:
    """Nearness of the rows of v to those of w, lengthened to the squared norm norm2; inner products where it is None."""
    dot = v @ w.T
    if norm2 is None:
        return dot
    a, b = (v * v).sum(axis=1)[:, None], (w * w).sum(axis=1)[None, :]
    # the difference of the added components, without taking long ones from each other
    both = np.sqrt(np.maximum(norm2 - a, 0.0)) + np.sqrt(np.maximum(norm2 - b, 0.0))
    step = (a - b) / np.where(both > 0, both, 1.0)
    return -(np.maximum(a + b - 2 * dot, 0.0) + step * step)


# --- cells -------------------------------------------------------------------------------------------------------------


def _lengthened(v: np.ndarray, norm2: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(norm2 - (v * v).sum(axis=1), 0.0))[:, None]])


def _nearest_centres(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each lengthened vector."""
    out, half = np.empty(len(x), dtype=np.int64), (centres * centres).sum(axis=1) / 2
    for at in range(0, len(x), 1024):
        out[at : at + 1024] = (x[at : at + 1024] @ centres.T - half).argmax(axis=1)
    return out


def _dealt(centres: np.ndarray, weights: np.ndarray, shards: int) -> np.ndarray:
    """A shard of each centre: halves along the direction of most spread, of equal weight, down to one shard."""
    out, todo, used = np.zeros(len(centres), dtype=np.int32), [(np.arange(len(centres)), shards)], 0
    while todo:
        own, parts = todo.pop()
        if parts <= 1 or len(own) <= 1:
            out[own], used = used, used + 1
            continue
        x = centres[own] - centres[own].mean(axis=0)
        along = np.linalg.eigh(x.T @ x)[1][:, -1]
        own = own[np.argsort(x @ along, kind="stable")]
        left = parts // 2
        cut = np.searchsorted(np.cumsum(weights[own]), weights[own].sum() * left / parts)
        cut = min(max(1, int(cut)), len(own) - 1)
        todo += [(own[:cut], left), (own[cut:], parts - left)]
    return out


class Cells:
    """Centres of lengthened vectors about their mean, and the shard of each."""

    def __init__(self, sample: np.ndarray, count: int, norm2: float, shards: int):
        self.norm2 = norm2
        x = _lengthened(sample, norm2)
        self.mean = x.mean(axis=0)
        x -= self.mean
        self.centres = x[np.random.default_rng(7).permutation(len(x))[:count]]
        for _ in range(TURNS):
            own = _nearest_centres(x, self.centres)
            order = np.argsort(own, kind="stable")
            some, starts = np.unique(own[order], return_index=True)
            sums = np.add.reduceat(x[order], starts, axis=0)
            self.centres[some] = sums / np.diff([*starts, len(x)])[:, None]
        weights = np.bincount(_nearest_centres(x, self.centres), minlength=len(self.centres)) + 1e-3
        self.shard = _dealt(self.centres, weights, shards)

    def of(self, v: np.ndarray) -> np.ndarray:
        return _nearest_centres(_lengthened(v, self.norm2) - self.mean, self.centres)

    def given(self) -> np.ndarray:
        """The centres without the added component."""
        return (self.centres + self.mean)[:, :-1]


def fit_cells(classes: DataFrame, count: int, norm2: float, cell: int, kind: str) -> Cells:
    """Cells fitted on a sample of the classes by hash."""
    size = np.dtype(kind).itemsize * len(classes.first()["v"])
    cells = min(MOST_CELLS, math.ceil(count / cell))
    rows = min(count, max(cells, min(SAMPLED * cells, SAMPLE_BYTES // size)))
    part = math.ceil(rows / count * (1 << 30))
    sample = classes.where(F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 30)) < part).orderBy("node").select("v").toArrow()
    v = np.array(sample["v"].combine_chunks().flatten(), dtype=np.float64).reshape(sample.num_rows, -1)
    if not len(v):  # so few rows that none is taken
        v = np.array([classes.first()["v"]], dtype=np.float64)
    cores = classes.sparkSession.sparkContext.defaultParallelism
    return Cells(v, min(cells, len(v)), norm2, max(math.ceil(count * size / SHARD_BYTES), 2 * cores))


def _members(classes: DataFrame, cells: Cells, kind: str) -> DataFrame:
    """node, base (the components as bytes of a numpy type), cell and shard of every class."""
    sent = classes.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            base = [np.asarray(v).astype(kind).tobytes() for v in batch["v"]]
            cell = sent.value.of(_matrix(base, kind))
            yield pd.DataFrame({"node": batch["node"], "base": base, "cell": cell.astype(np.int32), "shard": sent.value.shard[cell]})

    return classes.select("node", "v").mapInPandas(run, "node bigint, base binary, cell int, shard int")


# --- the graph of cells ------------------------------------------------------------------------------------------------


def _cells(nodes: DataFrame, count: int, cell: int, trees: int, kind: str) -> DataFrame:
    """node, base, tree, code, part: each tree deals the nodes by the sides of its hyperplanes."""
    depth = max(0, int(np.ceil(np.log2(max(1, count) / cell))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            v = _matrix(batch["base"].tolist(), kind)
            for tree in range(trees):
                planes = np.random.default_rng([7, tree]).normal(size=(v.shape[1], max(1, depth)))
                sides = (v @ planes > 0)[:, :depth].astype(np.int64)
                code = (sides << np.arange(depth)).sum(axis=1) if depth else np.zeros(len(v), dtype=np.int64)
                yield pd.DataFrame({"node": batch["node"], "tree": tree, "code": code})

    dealt = materialize(nodes.select("node", "base").mapInPandas(run, "node bigint, tree int, code bigint"), "cells")
    for turn in range(HALVINGS):
        large = dealt.groupBy("tree", "code").count().where(F.col("count") > 2 * cell).select("tree", "code")
        large = materialize(large, "large-cells")
        if large.isEmpty():
            break
        whole = dealt.join(large, ["tree", "code"], "left_semi").join(nodes.select("node", "base"), "node")

        def along(batches: Iterator[pd.DataFrame], turn: int = turn) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                v = _matrix(batch["base"].tolist(), kind)
                planes = np.stack([np.random.default_rng([7, t, turn]).normal(size=v.shape[1]) for t in range(trees)])
                yield batch[["node", "tree", "code"]].assign(x=np.einsum("ij,ij->i", v, planes[batch["tree"].to_numpy()]))

        lines = materialize(whole.mapInPandas(along, "node bigint, tree int, code bigint, x double"), "lines")
        middle = lines.groupBy("tree", "code").agg(F.percentile_approx("x", 0.5, 1000).alias("middle"))
        halves = lines.join(middle, ["tree", "code"]).select("node", "tree", F.xxhash64("code", F.col("x") > F.col("middle")).alias("code"))
        rest = dealt.join(large, ["tree", "code"], "left_anti").select("node", "tree", "code")
        dealt = materialize(rest.union(halves), "cells")
    sizes = dealt.groupBy("tree", "code").count().withColumn("parts", F.ceil(F.col("count") / (2 * cell)))
    large = materialize(sizes.where("parts > 1").select("tree", "code", "parts"), "large-cells")
    dealt = dealt.join(large, ["tree", "code"], "left")
    part = F.pmod(F.xxhash64("node", "tree"), F.coalesce("parts", F.lit(1).cast("bigint")))
    dealt = dealt.select("node", "tree", "code", part.alias("part"))
    return dealt.join(nodes.select("node", "base"), "node").select("node", "base", "tree", "code", "part")


def _cell_neighbours(names: np.ndarray, data: list[bytes], k: int, kind: str, norm2: float) -> pd.DataFrame:
    v = _matrix(data, kind)
    out = []
    for at in range(0, len(v), 1024):
        near = _near(v[at : at + 1024], v, norm2)
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        kk = min(k, len(v) - 1)
        if kk < 1:
            break
        best = np.argpartition(-near, kk - 1, axis=1)[:, :kk]
        value = np.take_along_axis(near, best, axis=1)
        out.append(pd.DataFrame({"a": np.repeat(names[at : at + len(near)], kk), "b": names[best].ravel(), "near": value.ravel()}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "near": []})


def _first_edges(nodes: DataFrame, count: int, degree: int, cell: int, trees: int, start: int, kind: str, norm2: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, names, data = None, [], []
        for batch in batches:
            for key, group in batch.groupby(["tree", "code", "part"], sort=False):
                if key != at:
                    if names:
                        yield _cell_neighbours(np.array(names), data, k, kind, norm2)
                    at, names, data = key, [], []
                names += group["node"].tolist()
                data += group["base"].tolist()
        if names:
            yield _cell_neighbours(np.array(names), data, k, kind, norm2)

    k = min(start, degree)
    cells = _cells(nodes, count, cell, trees, kind)
    cells = cells.repartition("tree", "code", "part").sortWithinPartitions("tree", "code", "part")
    edges = cells.mapInPandas(run, "a bigint, b bigint, near double").groupBy("a", "b").agg(F.max("near").alias("near"))
    return _top(edges, "a", [F.desc("near"), F.col("b")], degree).withColumn("fresh", F.lit(True))


#: least is a double in decimal digits, which SQL can write.
_MEMBER = np.dtype([("name", ">i8"), ("least", "S25"), ("fresh", "u1")])


def _introduced(members: list[bytes], given: int, kind: str = "i1", norm2: float | None = None) -> pd.DataFrame | None:
    """Of each center's packed members, pairs (a, b, near) with a fresh one that are nearer than a's farthest neighbour."""
    raw = np.frombuffer(b"".join(members), dtype=np.uint8).reshape(len(members), -1)
    head = np.ascontiguousarray(raw[:, : _MEMBER.itemsize]).view(_MEMBER).ravel()
    v = np.ascontiguousarray(raw[:, _MEMBER.itemsize :]).view(kind).astype(np.float64)
    near = _near(v, v, norm2)
    fresh = head["fresh"].astype(bool)
    fits = (near > head["least"].astype(np.float64)[:, None]) & (fresh[:, None] | fresh[None, :])
    np.fill_diagonal(fits, False)
    if not fits.any():
        return None
    near = np.where(fits, near, -np.inf)
    given = min(given, len(near))
    best = np.argpartition(-near, given - 1, axis=1)[:, :given]
    value = np.take_along_axis(near, best, axis=1)
    rows, places = np.nonzero(value > -np.inf)
    names = head["name"].astype(np.int64)
    return pd.DataFrame({"a": names[rows], "b": names[best[rows, places]], "near": value[rows, places]})


def _descend(edges: DataFrame, nodes: DataFrame, degree: int, part: int, given: int, turn: int, kind: str, norm2: float) -> DataFrame:
    """One round of NN-descent."""
    order = F.xxhash64("center", "member", F.lit(turn))
    ahead = edges.select(F.col("a").alias("center"), F.col("b").alias("member"), "fresh")
    behind = edges.select(F.col("b").alias("center"), F.col("a").alias("member"), "fresh")
    members = _top(ahead, ["center", "fresh"], [order], part).union(_top(behind, ["center", "fresh"], [order], part))
    members = members.groupBy("center", "member").agg(F.max("fresh").alias("fresh"))
    # only those with someone new: vectors are joined to no others
    members = members.withColumn("any", F.max("fresh").over(Window.partitionBy("center"))).where("any").drop("any")
    least = edges.groupBy("a").agg(F.min("near").alias("least"), F.count("*").alias("n"))
    none = F.lit(float("-inf"))
    least = least.select(F.col("a").alias("node"), F.when(F.col("n") < degree, none).otherwise(F.col("least")).alias("least"))
    facts = nodes.join(least, "node", "left").select(F.col("node").alias("member"), F.coalesce("least", none).alias("least"), "base")
    name = F.unhex(F.lpad(F.hex("member"), 16, "0"))
    digits = F.encode(F.rpad(F.col("least").cast("string"), 25, " "), "UTF-8")
    flag = F.when(F.col("fresh"), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    packed = members.join(facts, "member").select("center", "fresh", F.concat(name, digits, flag, "base").alias("x"))
    groups = packed.groupBy("center").agg(F.collect_list("x").alias("xs")).select("xs")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [x for x in (_introduced(list(xs), given, kind, norm2) for xs in batch["xs"] if len(xs) > 1) if x is not None]
            if found:
                yield pd.concat(found).drop_duplicates(["a", "b"])

    offered = groups.mapInPandas(run, "a bigint, b bigint, near double").withColumn("fresh", F.lit(True))
    both = edges.withColumn("fresh", F.lit(False)).unionByName(offered).groupBy("a", "b")
    both = both.agg(F.max("near").alias("near"), F.min("fresh").alias("fresh"))
    return _top(both, "a", [F.desc("near"), F.col("b")], degree)


def build_graph(nodes: DataFrame, kind: str, norm2: float, degree: int = DEGREE, cell: int = GRAPH_CELL, trees: int = TREES, part: int = PART) -> DataFrame:
    """Edges (a, b, near): the neighbours that each node lists. nodes: node, base (of numpy type kind); norm2: the greatest squared norm."""
    count = nodes.count()
    edges = materialize(_first_edges(nodes, count, degree, cell, trees, START, kind, norm2), "graph")
    for turn in range(MOST_ROUNDS):
        edges, before = materialize(_descend(edges, nodes, degree, part, GIVEN, turn, kind, norm2), "graph"), edges
        discard(before)
        if edges.where("fresh").count() <= CHANGED * count * degree:
            return edges.select("a", "b", "near")
    raise RuntimeError(f"the graph has not settled in {MOST_ROUNDS} rounds")


def both_ways(edges: DataFrame, back: int = BACK) -> DataFrame:
    """(at, node): whom a search goes on to from a node. Besides its own list these are the nearest `back` of those that list it,
    and those that it alone must lead to: every node is reached from that of its neighbours which the fewest list."""
    ahead = edges.select(F.col("a").alias("at"), F.col("b").alias("node"), "near")
    behind = edges.select(F.col("b").alias("at"), F.col("a").alias("node"), "near")
    listed = edges.groupBy("b").agg(F.count("*").alias("times"))
    sought = edges.join(listed, "b").groupBy("a").agg(F.min(F.struct("times", "b")).alias("least"))
    sought = sought.select(F.col("least.b").alias("at"), F.col("a").alias("node"))
    return ahead.select("at", "node").union(_top(behind, "at", [F.desc("near"), F.col("node")], back).select("at", "node")).union(sought).distinct()


# --- search ------------------------------------------------------------------------------------------------------------


class Walker:
    """Greedy beam search along the graph of cells."""

    def __init__(self, centres: np.ndarray, at: np.ndarray, cell: np.ndarray, entries: int = ENTRIES):
        order = np.argsort(at, kind="stable")
        self.centres, self.listed = centres, cell[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(centres)))])
        self.entries = np.argsort(-(centres * centres).sum(axis=1), kind="stable")[:entries]

    def _neighbours(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in cells, cell) of all that the cells list."""
        sizes = self.first[cells + 1] - self.first[cells]
        place = np.repeat(np.arange(len(cells)), sizes)
        within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return place, self.listed[self.first[cells][place] + within]

    def walk(self, queries: np.ndarray, own: np.ndarray, beam: int) -> list[np.ndarray]:
        """The cells of each query's beam, best first."""
        n, count = len(queries), len(self.centres)
        if beam >= count:
            return list(np.argsort(-(queries @ self.centres.T), axis=1, kind="stable"))
        near, fresh = np.full((n, count), -np.inf), np.zeros((n, count), dtype=bool)

        def visit(who: np.ndarray, cells: np.ndarray) -> None:
            pairs = np.unique(who * count + cells)
            pairs = pairs[near.ravel()[pairs] == -np.inf]
            for at in range(0, len(pairs), 1 << 16):
                who, cells = np.divmod(pairs[at : at + (1 << 16)], count)
                near[who, cells] = np.einsum("ij,ij->i", queries[who], self.centres[cells])
                fresh[who, cells] = True

        visit(np.repeat(np.arange(n), 1 + len(self.entries)), np.hstack([own[:, None], np.tile(self.entries, (n, 1))]).ravel())
        while True:
            best = np.argpartition(-near, beam - 1, axis=1)[:, :beam]
            value = np.take_along_axis(near, best, axis=1)
            order = np.argsort(-value, axis=1, kind="stable")
            best, value = np.take_along_axis(best, order, axis=1), np.take_along_axis(value, order, axis=1)
            still = np.take_along_axis(fresh, best, axis=1)
            if not still.any():
                return [b[v > -np.inf] for b, v in zip(best, value, strict=True)]
            who, place = np.nonzero(still & (np.cumsum(still, axis=1) <= max(1, beam // EXPAND)))
            cells = best[who, place]
            fresh[who, cells] = False
            at, cells = self._neighbours(cells)
            visit(who[at], cells)


def _asks(queries: DataFrame, walker: Walker, shards: np.ndarray, beam: int, kind: str, first: bool) -> DataFrame:
    """shard, q, base, cells, low: each query (q, base, cell, low) once for each shard that has cells of its beam; the first
    shard, that of the best cell, or all others."""
    sent = queries.sparkSession.sparkContext.broadcast((walker, shards))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walker, shards = sent.value
        for batch in batches:
            for at in range(0, len(batch), WALKED):
                some = batch[at : at + WALKED]
                out = []
                for i, cells in enumerate(walker.walk(_matrix(some["base"].tolist(), kind), some["cell"].to_numpy(), beam)):
                    dealt = shards[cells]
                    for shard in [dealt[0]] if first else np.setdiff1d(dealt, dealt[:1]):
                        out.append((int(shard), i, cells[dealt == shard].astype("<i4").tobytes()))
                shard, place, wanted = map(list, zip(*out, strict=True)) if out else ([], [], [])
                yield pd.DataFrame({"shard": shard, "q": some["q"].to_numpy()[place], "base": some["base"].to_numpy()[place], "cells": wanted, "low": some["low"].to_numpy()[place]})

    return queries.select("q", "base", "cell", "low").mapInPandas(run, "shard int, q bigint, base binary, cells binary, low double")


def _best_of(who: np.ndarray, place: np.ndarray, near: np.ndarray, names: np.ndarray, low: np.ndarray, k: int, kept: int, slack: float):
    """The k best of each query and what rounding may have put behind them, `kept` at most; low rises to the least that still counts."""
    order = np.lexsort((names[place], -near, who))
    who, place, near = who[order], place[order], near[order]
    starts = np.flatnonzero(np.diff(who, prepend=-1))
    sizes = np.diff([*starts, len(who)])
    rank = np.arange(len(who)) - np.repeat(starts, sizes)
    last = np.where(sizes >= k, near[np.minimum(starts + k - 1, len(near) - 1)], -np.inf) - slack
    low[who[starts]] = np.maximum(low[who[starts]], last)
    fits = (rank < k) | (near >= low[who]) & (rank < kept)
    return who[fits], place[fits], near[fits]


class Shard:
    """Nodes of a shard by cell."""

    def __init__(self, names: list[np.ndarray], cells: list[np.ndarray], vectors: list[np.ndarray]):
        cell = np.concatenate(cells)
        order = np.argsort(cell, kind="stable")
        self.names, self.vectors = np.concatenate(names)[order], np.concatenate(vectors)[order]
        self.cells, starts = np.unique(cell[order], return_index=True)
        self.starts = np.append(starts, len(cell))

    def search(self, queries: np.ndarray, wanted: list[bytes], low: np.ndarray, k: int, kept: int, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, name, score) of the best nodes in the cells that each query wants, of those that reach low."""
        cells = [np.frombuffer(x, "<i4") for x in wanted]
        who, cell = np.repeat(np.arange(len(cells)), list(map(len, cells))), np.concatenate(cells)
        order = np.argsort(cell, kind="stable")
        who, cell = who[order], cell[order]
        found, held, low = [], 0, low.copy()

        def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return _best_of(*map(np.concatenate, zip(*found, strict=True)), self.names, low, k, kept, slack)

        ends = np.append(np.flatnonzero(np.diff(cell)) + 1, len(cell))
        for s, e in zip([0, *ends], ends, strict=False):
            at = np.searchsorted(self.cells, cell[s])
            if at == len(self.cells) or self.cells[at] != cell[s]:
                continue  # a cell without nodes
            for b in range(self.starts[at], self.starts[at + 1], 4096):
                v = self.vectors[b : min(b + 4096, self.starts[at + 1])].astype(np.float64)
                for a in range(s, e, 512):
                    asking = who[a : min(a + 512, e)]
                    near = queries[asking] @ v.T
                    i, j = np.nonzero(near >= low[asking][:, None])
                    found.append((asking[i], j + b, near[i, j]))
                    held += len(i)
                    if held > HELD:
                        found = [best()]
                        held = len(found[0][0])
                        held = held if held <= HELD // 2 else 0  # then again when as many more have come
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        who, place, _ = best()
        score = np.empty(len(who))
        for at in range(0, len(who), 1 << 14):
            # one component after another, so that equal products have equal sums
            part = slice(at, at + (1 << 14))
            score[part] = np.add.accumulate(queries[who[part]] * self.vectors[place[part]].astype(np.float64), axis=1)[:, -1]
        return who, self.names[place], score


def _scan(members: DataFrame, asks: DataFrame, k: int, kept: int, slack: float, kind: str) -> DataFrame:
    """q, node, score: the best nodes that asks (of _asks) find in each shard."""
    nothing = F.lit(None)
    rows = members.select("shard", F.lit(0).alias("kind"), F.col("node").alias("name"), "base", "cell", nothing.cast("binary").alias("cells"), nothing.cast("double").alias("low"))
    rows = rows.unionByName(asks.select("shard", F.lit(1).alias("kind"), F.col("q").alias("name"), "base", F.lit(0).alias("cell"), "cells", "low"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, nodes, shard = None, ([], [], []), None
        for batch in batches:
            keys = batch["shard"].to_numpy() * 2 + batch["kind"].to_numpy()
            ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
            for s, e in zip([0, *ends], ends, strict=False):
                if s == e:
                    continue
                some, key = batch[s:e], int(keys[s])
                if key // 2 != at:
                    at, nodes, shard = key // 2, ([], [], []), None
                if key % 2 == 0:
                    v = np.frombuffer(b"".join(some["base"]), dtype=kind).reshape(len(some), -1)
                    for to, x in zip(nodes, (some["name"].to_numpy(), some["cell"].to_numpy(), v), strict=True):
                        to.append(x)
                    continue
                if not nodes[0] and shard is None:
                    continue  # a shard without nodes
                if shard is None:
                    shard, nodes = Shard(*nodes), ([], [], [])
                for b in range(0, len(some), ASKED):
                    part = some[b : b + ASKED]
                    who, name, score = shard.search(_matrix(part["base"].tolist(), kind), part["cells"].tolist(), part["low"].to_numpy(), k, kept, slack)
                    yield pd.DataFrame({"q": part["name"].to_numpy()[who], "node": name, "score": score})

    rows = rows.repartition("shard").sortWithinPartitions("shard", "kind")
    return rows.mapInPandas(run, "q bigint, node bigint, score double")


def exact_search(nodes: DataFrame, queries: list[tuple[int, bytes]], k: int, kind: str) -> DataFrame:
    """q, node, cell, near: the k nearest nodes of a few queries, by comparing each with all nodes."""
    names, v = np.array([q for q, _ in queries], dtype=np.int64), [base for _, base in queries]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, best = _matrix(v, kind), None
        for batch in batches:
            for at in range(0, len(batch), 4096):
                some = batch[at : at + 4096]
                new = [asked @ _matrix(some["base"].tolist(), kind).T, *(np.broadcast_to(some[c].to_numpy(), (len(names), len(some))) for c in ("node", "cell"))]
                near, node, cell = new if best is None else map(np.hstack, zip(best, new, strict=True))
                top = np.lexsort((node, -near), axis=1)[:, :k]
                best = [np.take_along_axis(x, top, axis=1) for x in (near, node, cell)]
        if best is not None:
            near, node, cell = best
            yield pd.DataFrame({"q": np.repeat(names, near.shape[1]), "node": node.ravel(), "cell": cell.ravel(), "near": near.ravel()})

    found = nodes.select("node", "base", "cell").mapInPandas(run, "q bigint, node bigint, cell int, near double")
    return _top(found, "q", [F.desc("near"), F.col("node")], k)


def measured_beam(members: DataFrame, queries: DataFrame, walker: Walker, kind: str, k: int, beam: int = BEAM) -> tuple[int, float]:
    """The width of beams, widened until the cells of a sample of queries hold WANTED of their true k nearest, and what they hold."""
    asked = queries.orderBy(F.xxhash64("q"), "q").limit(SAMPLE).select("q", "base", "cell").collect()
    if not asked:
        return beam, 1.0
    cells: dict[int, list[int]] = {}
    for r in exact_search(members, [(r["q"], bytes(r["base"])) for r in asked], k, kind).select("q", "cell").collect():
        cells.setdefault(r["q"], []).append(r["cell"])
    v, own = _matrix([bytes(r["base"]) for r in asked], kind), np.array([r["cell"] for r in asked], dtype=np.int64)
    while True:
        beams = walker.walk(v, own, beam)
        found = float(np.mean([np.isin(cells[r["q"]], b).mean() for r, b in zip(asked, beams, strict=True)]))
        if found >= WANTED or beam >= len(walker.centres):
            return beam, found
        beam += max(1, beam // 4)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", degree: int = DEGREE,
    cell: int = CELL, rescored: int = RESCORED, beam: int = BEAM,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each row for which is_query (a condition on `id`) holds."""
    spark, kind = vectors.sparkSession, _kind(vectors, vector_col)
    rows = materialize(_valid(vectors, id_col, vector_col), "vectors")
    classes = materialize(_classes(rows, k + 1), "vector-classes")
    asking = rows.where(is_query).distinct().join(classes.select("v", F.col("node").alias("q")), "v").select("id", "q")
    asking = materialize(asking, "asking")
    discard(rows)
    norm2, count = classes.agg(F.max(_norm2(F.col("v"))), F.count("*")).first()
    if not count:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    cells = fit_cells(classes, count, norm2, cell, kind)
    members = materialize(_members(classes, cells, kind), "members")
    ids = materialize(classes.select("node", "ids"), "class-ids")
    discard(classes)
    centres = materialize(spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(cells.centres)], "node long, base binary"), "centres")
    edges = build_graph(centres, "<f8", float((cells.centres**2).sum(axis=1).max()) or 1.0, degree)
    lists = both_ways(edges).toArrow()
    walker = Walker(cells.given(), lists["at"].to_numpy(), lists["node"].to_numpy())
    queries = asking.select("q").distinct().join(members.select(F.col("node").alias("q"), "base", "cell"), "q")
    queries = materialize(queries.withColumn("low", F.lit(float("-inf"))), "queries")
    beam, _ = measured_beam(members, queries, walker, kind, k + 1, beam)
    slack = ROUNDING * norm2
    search = lambda asked, first: _scan(members, _asks(asked, walker, cells.shard, beam, kind, first), k + 1, rescored, slack, kind)
    found = materialize(search(queries, True), "found-first")
    low = _top(found, "q", [F.desc("score"), F.col("node")], k + 1).groupBy("q").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    low = low.select("q", F.when(F.col("n") > k, F.col("least") - slack).alias("reached"))
    queries = queries.join(low, "q", "left").select("q", "base", "cell", F.coalesce("reached", "low").alias("low"))
    found = found.unionByName(materialize(search(queries, False), "found"))
    best = _top(found, "q", [F.desc("score"), F.col("node")], k + 1)
    scored = best.join(ids, "node").select("q", "score", F.explode("ids").alias("vec_id"))
    best = _top(scored, "q", [F.desc("score"), F.col("vec_id")], k + 1)
    best = best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))).alias("best"))
    found = asking.join(best, "q").select(
        F.col("id").alias("query_id"), F.slice(F.filter("best", lambda x: x["i"] != F.col("id")), 1, k).alias("best")
    )
    found = found.select("query_id", F.posexplode("best").alias("place", "x"))
    return found.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))
