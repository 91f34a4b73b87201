"""Greedy de-duplication: keep a row if it conflicts with no kept row before it.

That is the lexicographically first maximal independent set of the conflict graph under the rows' rank: in rounds, undecided
rows without an undecided or kept earlier neighbour are kept, and undecided rows with a kept earlier neighbour are rejected.
Exact conflicts are equi-joins on a key; near ones join 64-bit SimHashes on bands that any two values within the distance
must share one of, then compare bits. Exact keys never make all pairs: a row is compared with the key's kept row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.sources.tables import checkpointed, discard


@dataclass(frozen=True)
class Rule:
    """A reason to reject: equal keys (distance None) or SimHashes within a distance. column holds the key or BIGINT hash."""

    name: str
    column: str
    distance: int | None = None


#: Hashes of a block: a task compares two blocks at once.
BLOCK = 1 << 14
#: Comparisons at once, few enough for a core's cache.
TILE = 1 << 17


def cuts_of(count: int) -> list[int]:
    """Where count bands of 64 bits, as equal as can be, begin and end."""
    return [64 * i // count for i in range(count + 1)]


def bands(value: Column, count: int) -> list[Column]:
    """count pieces of a 64-bit value, as equal as can be."""
    cuts = cuts_of(count)
    return [
        F.shiftrightunsigned(value, s).bitwiseAND(F.lit((1 << (e - s)) - 1).cast("bigint")) for s, e in zip(cuts, cuts[1:], strict=False)
    ]


def near_pairs(values: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """(a, b, distance) of distinct hashes a < b within the distance. values: one column, BIGINT.

    Of distance + 2 bands two at least are equal in such a pair. Up to distance 10 a hash stands under each of its bands but the
    last, and is compared with those that share this band and a later one: with distance 8, 9 rows a hash and 1 of 158 pairs.
    Beyond, bands leave about half of all pairs or more, so every pair is compared, once. Hashes that share a band are cut in
    blocks, and a row that goes to a task has two of them, so no key's hashes meet in one task and memory is bounded.
    """
    distinct = checkpointed(values.toDF("a").where(F.col("a").isNotNull()).distinct())
    count = distance + 2 if distance <= 10 else 0
    keys = F.array(*bands(F.col("a"), count)[:-1]) if count else F.array(F.lit(0).cast("bigint"))
    keyed = distinct.select("a", F.posexplode(keys).alias("band", "key"))
    spark = distinct.sparkSession
    least = 1 if count else _sides(spark.sparkContext.defaultParallelism)
    sizes = keyed.groupBy("band", "key").agg(F.greatest(F.lit(least), F.ceil(F.count("*") / block)).cast("int").alias("blocks"))
    # a few thousand rows: 12 bands at most, of 7 bits at most where distance is 7 or more
    dealt = keyed.join(F.broadcast(sizes), ["band", "key"]) if distance >= 7 else keyed.join(sizes, ["band", "key"])
    dealt = dealt.groupBy("band", "key", "blocks", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"))
    blocks = checkpointed(dealt.agg(F.collect_list("a").alias("a")))
    # every block goes to each pair of blocks of its key that it is in, so that pairs are dealt out evenly
    cells, tasks = ["band", "key", "i", "j"], max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left = blocks.select("band", "key", F.col("block").alias("i"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("j"), "a")
    right = blocks.select("band", "key", F.explode(F.expr("sequence(0, block)")).alias("i"), F.col("block").alias("j"), F.col("a").alias("b"))
    pairs = left.repartition(tasks, *cells).join(right.repartition(tasks, *cells), cells)
    pairs = pairs.select("band", (F.col("i") == F.col("j")).alias("same"), "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy().view(np.uint64) for c in (2, 3))
                for x, y in _near_values(a, b, batch.column(1)[i].as_py(), batch.column(0)[i].as_py(), count, distance):
                    bits = np.bitwise_count(x ^ y).astype(np.int32)
                    x, y = x.view(np.int64), y.view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(bits)], names=["a", "b", "distance"])

    return pairs.mapInArrow(compare, "a bigint, b bigint, distance int")


def _sides(cores: int) -> int:
    """Blocks of all hashes whose pairs are some for every core."""
    return math.ceil(math.sqrt(4 * cores))


def _near_values(a: np.ndarray, b: np.ndarray, same: bool, band: int, count: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the distance of two blocks of hashes that share a band: those whose first two equal bands are this one and a
    later one. Without bands (count 0), all pairs. Of one block twice (same), each pair once."""
    if not count:
        yield from _near_tiles(a, b, same, distance)
        return
    cuts = cuts_of(count)
    piece = lambda v, j: (v >> np.uint64(cuts[j])) & np.uint64((1 << (cuts[j + 1] - cuts[j])) - 1)
    for j in range(band + 1, count):
        parts = []
        for v in (a, b):
            own = piece(v, j)
            order = np.argsort(own, kind="stable")
            parts.append((v[order], *np.unique(own[order], return_index=True)))
        (av, ak, a0), (bv, bk, b0) = parts
        a1, b1 = np.append(a0[1:], len(av)), np.append(b0[1:], len(bv))
        _, at, bt = np.intersect1d(ak, bk, assume_unique=True, return_indices=True)
        for i, k in zip(at, bt, strict=True):
            for x, y in _near_tiles(av[a0[i] : a1[i]], bv[b0[k] : b1[k]], same, distance):
                alone = np.ones(len(x), dtype=bool)
                for other in range(j):
                    if other != band:
                        alone &= piece(x ^ y, other) != 0
                if alone.any():
                    yield x[alone], y[alone]


def _near_tiles(a: np.ndarray, b: np.ndarray, same: bool, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a and b within the distance, in slices; each once where a and b are the same hashes."""
    width = min(len(b), TILE // 16)
    height = max(1, TILE // max(1, width))
    for s in range(0, len(a), height):
        some = a[s : s + height, None]
        for t in range(s - s % width if same else 0, len(b), width):
            n, m = np.nonzero(np.bitwise_count(some ^ b[t : t + width]) <= distance)
            if len(n):
                n, m = n + s, m + t
                once = n < m if same else slice(None)
                yield a[n[once]], b[m[once]]


def greedy_deduplicate(rows: DataFrame, id_col: str, order: list[Column], rules: list[Rule]) -> DataFrame:
    """rows with duplicate_reason, duplicate_of (id of the kept row) and duplicate_distance; null for kept rows.

    order: columns whose ascending order is the rank (negate a number to turn it round); it must be total. Every round decides
    the first undecided row of each chain of conflicts at least, so rounds end, and replaces the last one's table. Of several reasons the first in rules counts; of several near rows the nearest, then the least id.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    base = checkpointed(rows.select(F.col(id_col).alias("id"), rank.alias("rank"), *{r.column for r in rules}))
    exact = [r for r in rules if r.distance is None]
    near = [r for r in rules if r.distance is not None]
    links = {r.name: checkpointed(_both_ways(near_pairs(base.select(r.column), r.distance))) for r in near}
    state = base.withColumn("kept", F.lit(None).cast("boolean"))
    undecided, last = True, state
    while undecided:
        blocked, beaten = _standing(state, exact, near, links)
        state = state.join(blocked, "id", "left").join(beaten, "id", "left")
        open_ = F.col("kept").isNull()
        kept = F.when(open_ & F.coalesce("beaten", F.lit(False)), False)
        kept = kept.when(open_ & ~F.coalesce("blocked", F.lit(False)), True).otherwise(F.col("kept"))
        state, before = checkpointed(state.select(*base.columns, kept.alias("kept"))), last
        discard(before)
        undecided, last = not state.where("kept is null").isEmpty(), state
    return rows.join(_explained(state, rules, links), rows[id_col] == F.col("_id"), "left").drop("_id")


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))


def _standing(state: DataFrame, exact: list[Rule], near: list[Rule], links: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """ids with an earlier undecided or kept conflict (blocked), and with an earlier kept one (beaten)."""
    alive = state.where("kept is null or kept")
    blocked, beaten = [], []
    for rule in exact:
        # the least rank of a key is enough: any row after it is blocked
        firsts = alive.where(F.col(rule.column).isNotNull()).groupBy(rule.column)
        firsts = firsts.agg(F.min("rank").alias("first"), F.min(F.when(F.col("kept"), F.col("rank"))).alias("kept_first"))
        joined = state.where("kept is null").join(firsts, rule.column)
        blocked.append(joined.where("first < rank").select("id"))
        beaten.append(joined.where("kept_first < rank").select("id"))
    for rule in near:
        # rows of one hash are near each other too (distance 0)
        by_hash = alive.groupBy(rule.column).agg(F.min("rank").alias("first"), F.min(F.when(F.col("kept"), F.col("rank"))).alias("kept_first"))
        by_hash = by_hash.where(F.col(rule.column).isNotNull())
        around = links[rule.name].join(by_hash, F.col("b") == F.col(rule.column)).select("a", "first", "kept_first")
        own = by_hash.select(F.col(rule.column).alias("a"), "first", "kept_first")
        least = around.union(own).groupBy("a").agg(F.min("first").alias("first"), F.min("kept_first").alias("kept_first"))
        joined = state.where("kept is null").join(least, F.col(rule.column) == F.col("a"))
        blocked.append(joined.where("first < rank").select("id"))
        beaten.append(joined.where("kept_first < rank").select("id"))
    return (
        reduce(DataFrame.union, blocked).distinct().withColumn("blocked", F.lit(True)),
        reduce(DataFrame.union, beaten).distinct().withColumn("beaten", F.lit(True)),
    )


def _explained(state: DataFrame, rules: list[Rule], links: dict[str, DataFrame]) -> DataFrame:
    """_id, duplicate_reason, duplicate_of, duplicate_distance of rejected rows."""
    kept, lost = state.where("kept"), state.where("not kept")
    found = []
    for n, rule in enumerate(rules):
        c = rule.column
        if rule.distance is None:
            # two kept rows never share a key, so this makes one row for each lost one
            by_key = kept.where(F.col(c).isNotNull()).select(F.col(c).alias("_k"), F.col("id").alias("of"), F.col("rank").alias("of_rank"))
            part = lost.join(by_key, F.col(c) == F.col("_k")).where("of_rank < rank").select("id", "of", F.lit(0).alias("distance"))
        else:
            own = state.select(F.col(c).alias("a"), F.col(c).alias("b"), F.lit(0).alias("distance")).where("a is not null").distinct()
            by_hash = kept.select(F.col(c).alias("b"), F.col("id").alias("of"), F.col("rank").alias("of_rank"))
            around = links[rule.name].union(own).join(by_hash, "b").select("a", "of", "of_rank", "distance")
            part = lost.join(around, F.col(c) == F.col("a")).where("of_rank < rank").select("id", "of", "distance")
        found.append(part.select("id", F.struct(F.lit(n).alias("n"), "distance", "of").alias("why")))
    best = reduce(DataFrame.union, found).groupBy("id").agg(F.min("why").alias("why"))
    names = F.array(*(F.lit(r.name) for r in rules))
    return best.select(
        F.col("id").alias("_id"), F.get(names, F.col("why.n")).alias("duplicate_reason"), F.col("why.of").alias("duplicate_of"),
        F.col("why.distance").alias("duplicate_distance"),
    )


def cluster_ids(rows: DataFrame, id_col: str, prefix: str = "duplicate") -> Column:
    """Cluster id of each row of greedy_deduplicate's result."""
    own = F.when(F.col("duplicate_of").isNull(), F.concat(F.lit("singleton:"), F.col(id_col).cast("string")))
    return T.fingerprint(own.otherwise(F.concat(F.lit(f"{prefix}:"), F.col("duplicate_of").cast("string"))))


def first_of_each(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")
