"""SimHash near-duplicates: XXH64 fingerprints of 3-word shingles, linked at 2 or fewer differing bits through a Gray-order index.

Fingerprints are reduced to distinct values first, each with its smallest id, so copies cost one row. The 64 bits are cut in
four bands; two values at distance 2 or less agree in at least two bands, so six tables keyed by a pair of bands hold
every link. In a table, values that share a key are sorted by Gray rank and become leaves of a hierarchical index: a node
keeps the bits that all of its values share (mask and pattern), an upper node those that its children share. Two nodes whose
shared bits differ in more than the limit are pruned with everything below them. Each task unites what it links and returns
one edge a value at most (a spanning forest), never the pairs of a group. The values of a key that very many share are set
apart again by three ranges of their other bits, of which two values at distance 2 or less agree in one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components

SEED = 42
WORDS = 3
MAX_BITS = 2
BANDS = 4
LEAF = 16
FANOUT = 4
#: A key with more distinct values than this is split by ranges of its 32 other bits.
HOT_KEY = 4096
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 16
_PAIRS = [(a, b) for a in range(BANDS) for b in range(a + 1, BANDS)]
_WIDTH = 64 // BANDS


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def shingle_hashes(text: str | None) -> list[int]:
    """XXH64 (seed 42) of every 3-word shingle, repeats included; of the whole sequence where it is shorter."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only
    words = data.split()  # at 0x20 and 0x09-0x0D
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= WORDS:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - WORDS].tolist()]
    return [digest(joined[s:e], SEED) for s, e in zip(starts, (ends[WORDS - 1 :] - 1).tolist(), strict=True)]


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """A bit is 1 if it is set in over half of the text's hashes; 0 for a text without words."""
    out = np.zeros(len(texts), dtype=np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    held: list[int] = []
    owners: list[int] = []
    sizes: list[int] = []

    def flush() -> None:
        if not held:
            return
        bits = np.unpackbits(np.array(held, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        set_ = 2 * sums > np.array(sizes, dtype=np.int64)[:, None]
        out[owners] = (set_ * weights).sum(axis=1, dtype=np.uint64)
        held.clear(), owners.clear(), sizes.clear()

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text)
        if not hashes:
            continue
        if len(hashes) > CHUNK:
            total = np.zeros(64, dtype=np.int64)
            for at in range(0, len(hashes), CHUNK):
                part = np.array(hashes[at : at + CHUNK], dtype="<u8").view(np.uint8).reshape(-1, 8)
                total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = (np.where(2 * total > len(hashes), weights, np.uint64(0))).sum(dtype=np.uint64)
            continue
        held.extend(hashes), owners.append(i), sizes.append(len(hashes))
        if len(held) >= CHUNK:
            flush()
    flush()
    return out


def fingerprint_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tag: Column | None = None) -> DataFrame:
    """id, fp (the fingerprint as a signed BIGINT) and, if given, tag (a string expression) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["id"]].assign(fp=fingerprints(batch["text"].tolist()).view(np.int64), **{c: batch[c] for c in batch.columns[2:]})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([] if tag is None else [tag.alias("tag")]))
    return rows.mapInPandas(run, f"id {kind}, fp bigint" + ("" if tag is None else ", tag string"))


# --- Gray-order hierarchical index -------------------------------------------------------------------------------------


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the Gray sequence: the inverse Gray code."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Leaves of LEAF values in Gray order; nodes[level] = (mask of shared bits, shared pattern), from leaves to top."""

    def __init__(self, values: np.ndarray):
        self.order = np.argsort(gray_rank(values), kind="stable")
        self.values = values[self.order]
        starts = np.arange(0, len(values), LEAF)
        ands, ors = np.bitwise_and.reduceat(self.values, starts), np.bitwise_or.reduceat(self.values, starts)
        self.levels = [(~(ands ^ ors), ands)]
        while len(ands) > FANOUT:
            starts = np.arange(0, len(ands), FANOUT)
            ands, ors = np.bitwise_and.reduceat(ands, starts), np.bitwise_or.reduceat(ors, starts)
            self.levels.append((~(ands ^ ors), ands))

    def links(self, probes: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(probe number, value number) at limit or fewer differing bits, in slices of bounded size."""
        for at in range(0, len(probes), 512):
            some = probes[at : at + 512]
            mask, pattern = self.levels[-1]
            who, node = (x.ravel() for x in np.meshgrid(np.arange(len(some)), np.arange(len(mask)), indexing="ij"))
            for level in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[level]
                near = popcount((some[who] ^ pattern[node]) & mask[node]) <= limit
                who, node = who[near], node[near]
                width, count = (LEAF, len(self.values)) if level == 0 else (FANOUT, len(self.levels[level - 1][0]))
                who = np.repeat(who, width)
                node = (node[:, None] * width + np.arange(width)).ravel()
                there = node < count
                who, node = who[there], node[there]
            near = popcount(some[who] ^ self.values[node]) <= limit
            yield who[near] + at, self.order[node[near]]


class Forest:
    """Union-find; unite() takes arrays and keeps the links that joined two trees."""

    def __init__(self, size: int):
        self.up = np.arange(size)

    def find(self, x: np.ndarray) -> np.ndarray:
        root = self.up[x]
        while True:
            higher = self.up[root]
            if (higher == root).all():
                return root
            root = higher

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            low, high = np.minimum(a, b), np.maximum(a, b)
            apart = low != high
            low, high = low[apart], high[apart]
            if not len(low):
                break
            np.minimum.at(self.up, high, low)
            a, b = low, high
        root = self.up
        while not (root[root] == root).all():
            root = root[root]
        self.up = root


def group_edges(values: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Edges (n, 2) of a spanning forest of the values that link, each value to the first of its tree."""
    if len(values) < 2:
        return np.empty((0, 2), dtype=np.uint64)
    forest = Forest(len(values))
    if len(values) <= 2 * LEAF:
        a, b = np.triu_indices(len(values), 1)
        near = popcount(values[a] ^ values[b]) <= limit
        forest.unite(a[near], b[near])
    else:
        index = GrayIndex(values)
        for a, b in index.links(values, limit):
            forest.unite(a, b)
    child = np.flatnonzero(forest.up != np.arange(len(values)))
    return np.stack([values[child], values[forest.up[child]]], axis=1)


def _keyed(distinct: DataFrame) -> DataFrame:
    """Every value under each pair of bands: key has the pair's number and the bands' bits."""
    band = lambda i: F.shiftrightunsigned("fp", i * _WIDTH).bitwiseAND(F.lit((1 << _WIDTH) - 1).cast("bigint"))
    keys = [F.struct(F.lit(n).alias("t"), (F.shiftleft(band(a), _WIDTH) + band(b)).alias("k")) for n, (a, b) in enumerate(_PAIRS)]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.t", "key.k")


def _split_hot(keyed: DataFrame, hot_key: int) -> DataFrame:
    """Adds u: 0 for common keys. The 32 free bits of a hot key's values are cut in three, and two values at distance 2 agree
    in one of them; each value then stands under its three parts. Of one part only 11 bits are known to agree, so a part's
    group has at most 2**21 values, and no text can add to that."""
    hot = keyed.groupBy("t", "k").count().where(F.col("count") > hot_key).select("t", "k")
    hot = materialize(hot, "hot-keys")
    free = F.lit(0).cast("bigint")
    for n, pair in enumerate(_PAIRS):
        rest = [i for i in range(BANDS) if i not in pair]
        bits = lambda i: F.shiftrightunsigned("fp", i * _WIDTH).bitwiseAND(F.lit((1 << _WIDTH) - 1).cast("bigint"))
        free = F.when(F.col("t") == n, F.shiftleft(bits(rest[0]), _WIDTH) + bits(rest[1])).otherwise(free)
    parts = [(0, 11), (11, 11), (22, 10)]
    subs = F.array(
        *(
            F.shiftleft(F.shiftrightunsigned(free, at).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")), 2) + (n + 1)
            for n, (at, width) in enumerate(parts)
        )
    )
    marked = keyed.join(hot.withColumn("hot", F.lit(True)), ["t", "k"], "left")
    none = F.array(F.lit(0).cast("bigint"))
    return marked.select("fp", "t", "k", F.explode(F.when(F.col("hot"), subs).otherwise(none)).alias("u"))


def fingerprint_edges(distinct: DataFrame, limit: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """Edges (a, b) between distinct fingerprints; their components are those of all links. distinct: one column fp."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        at = None
        for batch in batches:
            keys = batch[["t", "k", "u"]].to_numpy()
            values = batch["fp"].to_numpy(np.int64).view(np.uint64)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            found = []
            for s, e in zip([0, *cuts], [*cuts, len(values)], strict=True):
                if e == s:
                    continue
                key = tuple(keys[s])
                if key != at:
                    found.append(group_edges(np.concatenate(held or [values[:0]]), limit))
                    held, at = [], key
                held.append(values[s:e])
            out = np.concatenate(found) if found else np.empty((0, 2), dtype=np.uint64)
            yield pd.DataFrame({"a": out[:, 0].view(np.int64) if len(out) else [], "b": out[:, 1].view(np.int64) if len(out) else []}).astype("int64")
        out = group_edges(np.concatenate(held or [np.empty(0, dtype=np.uint64)]), limit)
        yield pd.DataFrame({"a": out[:, 0].copy().view(np.int64), "b": out[:, 1].copy().view(np.int64)})

    rows = _split_hot(_keyed(distinct), hot_key)
    rows = rows.repartition("t", "k", "u").sortWithinPartitions("t", "k", "u")
    return rows.mapInPandas(run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_BITS, tag: Column | None = None
) -> DataFrame:
    """id, fp, component_id (the smallest id reachable by links, itself included), group (a fingerprint that names the
    component) and, if given, tag of every row.

    A null text counts as empty; texts without words have fingerprint zero and are linked like any other; a null id is
    kept and never a component's name unless all of its ids are null; repeated rows stay; other columns take no part.
    """
    marks = materialize(fingerprint_rows(docs, id_col, text_col, tag), "fingerprints")
    distinct = marks.groupBy("fp").agg(F.min("id").alias("least"))
    edges = materialize(fingerprint_edges(distinct.select("fp"), limit), "fingerprint-edges")
    groups = connected_components(edges)
    named = distinct.join(groups, distinct["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group")
    )
    named = materialize(named, "fingerprint-groups")
    names = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = named.join(names, "group").select("fp", "group", "component_id")
    return marks.join(named, "fp").select("id", "fp", "component_id", "group", *([] if tag is None else ["tag"]))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the least id (null ids last), then of the least
    digest of id and text; of rows that repeat both, any one."""
    text = F.coalesce(F.col(text_col), F.lit("~"))
    tag = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("~")), F.lit("|"), text).cast("binary"))
    groups = near_duplicates(docs, id_col, text_col, limit, tag)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("tag"))).alias("first")
    chosen = groups.groupBy("group").agg(first).select(F.col("first.tag").alias("_tag"))
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), tag.alias("_tag")).join(chosen, "_tag", "left_semi")
    return kept.dropDuplicates(["_tag"]).select(*(F.col(f"doc.`{c}`") for c in docs.columns))


def hex_fingerprint(fp) -> object:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
