"""Toxic spans by a linear-chain conditional random field over words, with forward-backward marginals.

Labels mark documents, so token labels are derived first: a feature (a word, its first 3 to 8 or last 3 to 5 letters) is toxic if
it stands in toxic documents only, or nearly so (PURITY), and in so many that chance cannot explain it (ALPHA over all
features seen). Copies are taken once for that (by minima of hashed word triples). Words of toxic documents that have a toxic
feature are tagged, all other words are not; the field is fitted to these tags by full-batch adaptive gradient steps.

Inference runs over many documents at once: each word is a 2 x 2 matrix, those of a document's first word forget what
stood before, and blocked products give all forward and backward vectors. A document's score is its greatest marginal, or
over HALF the noisy-or of its offending words.

The sample: at most TRAIN_DOCS documents of each label, chosen by a hash of the id, and TRAIN_CHARS characters in all
(documents after that are left out whole); model size is fixed (2**BITS weights).

Defined results: null, empty or word-free texts score 0; with no label, or none toxic, all documents score 0; a document
with several labels counts as toxic if one of them is; repeated rows are scored one by one; other columns take no part.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from .common import kept
from .language_id import held_out

TRAIN_DOCS = 1500
TRAIN_CHARS = 5_000_000
BITS = 18
PURITY = 0.95
ALPHA = 0.01
EPOCHS = 20
RATE = 0.5
PENALTY = 1e-4
HALF = 0.5
LOG2 = math.log(2)
BLOCK = 256
#: Words scored at once, and words whose scores a worker keeps.
CHUNK = 200_000
CACHE_WORDS = 400_000

_WORD = re.compile(r"\w+")
_words = _WORD.findall


def features(word: str) -> list[str]:
    """The word, its first 3 to 8 and its last 3 to 5 letters, where it has more."""
    n = len(word)
    return ["w" + word, *["p" + word[:k] for k in range(3, min(n, 9))], *["s" + word[-k:] for k in range(3, min(n, 6))]]


def feature_numbers(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for f in features(word)]


# --- the field ---------------------------------------------------------------------------------------------------------


def marginals(emission: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Chance of the tag at each word. emission: the tag's score; first: which words begin a document; moves: 2 x 2 and
    start: 2 log potentials. With pairs, also the expected moves (2 x 2) and starts (2)."""
    n = len(emission)
    if not n:
        return (np.zeros(0), np.zeros((2, 2)), np.zeros(2)) if pairs else np.zeros(0)
    width = min(BLOCK, n)
    count = -(-n // width)
    own = np.zeros((count * width, 2))
    own[:n, 1] = np.clip(emission, -40, 40)
    own = np.exp(own - own.max(axis=1, keepdims=True))
    begin = np.ones(count * width, dtype=bool)
    begin[:n] = first
    step = np.where(begin[:, None, None], np.exp(start)[None, None, :], np.exp(moves)[None]) * own[:, None, :]
    step = step.reshape(count, width, 2, 2).transpose(1, 2, 3, 0)  # place, from, to, block

    ahead = np.empty_like(step)
    ahead[0] = step[0]
    for k in range(1, width):
        product = ahead[k - 1][:, 0, None] * step[k][None, 0] + ahead[k - 1][:, 1, None] * step[k][None, 1]
        ahead[k] = product / product.sum(axis=(0, 1))
    carry = np.empty((2, count))
    v = np.array([0.5, 0.5])
    last = ahead[-1].transpose(2, 0, 1)
    for b in range(count):
        carry[:, b] = v
        v = v @ last[b]
        v = v / v.sum()
    alpha = carry[0] * ahead[:, 0] + carry[1] * ahead[:, 1]
    alpha /= alpha.sum(axis=1, keepdims=True)

    behind = ahead  # reused: product of the block's steps after each place
    behind[width - 1] = np.eye(2)[:, :, None]
    for k in range(width - 2, -1, -1):
        product = step[k + 1][:, 0, None] * behind[k + 1][None, 0] + step[k + 1][:, 1, None] * behind[k + 1][None, 1]
        behind[k] = product / product.sum(axis=(0, 1))
    whole = (step[0][:, 0, None] * behind[0][None, 0] + step[0][:, 1, None] * behind[0][None, 1]).transpose(2, 0, 1)
    v = np.array([0.5, 0.5])
    for b in range(count - 1, -1, -1):
        carry[:, b] = v
        v = whole[b] @ v
        v = v / v.sum()
    beta = behind[:, :, 0] * carry[0] + behind[:, :, 1] * carry[1]
    beta /= beta.sum(axis=1, keepdims=True)
    both = alpha * beta
    chance = (both[:, 1] / both.sum(axis=1)).T.ravel()[:n]
    if not pairs:
        return chance
    alpha, beta = (x.transpose(2, 0, 1).reshape(-1, 2)[:n] for x in (alpha, beta))
    step = step.transpose(3, 0, 1, 2).reshape(-1, 2, 2)[:n]
    inner = np.flatnonzero(~first)
    joint = alpha[inner - 1][:, :, None] * step[inner] * beta[inner][:, None, :]
    moved = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    begun = chance[first].sum()
    return chance, moved, np.array([first.sum() - begun, begun])


def evidence(chance: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each document, minus the log of the chance that none of its offending words (marginal HALF or more) is toxic."""
    return np.add.reduceat(np.where(chance >= HALF, -np.log1p(-np.minimum(chance, 1 - 1e-12)), 0.0), starts)


class Field:
    def __init__(self, weights: np.ndarray, moves: np.ndarray, start: np.ndarray, limit: float = LOG2):
        """limit: the evidence (see evidence()) from which a document counts as toxic."""
        self.weights, self.moves, self.start, self.limit = weights, moves, start, limit
        self.known: dict[str, float] = {}
        self.trained = bool(weights.any())

    def emission(self, words: list[str]) -> np.ndarray:
        known, weights = self.known, self.weights
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words) - known.keys():
            known[w] = float(weights[feature_numbers(w)].sum())
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """A score for each text, and its offending words as (start, end, marginal)."""
        scores, spans = np.zeros(len(texts)), [[] for _ in texts]
        if not self.trained:
            return scores, spans
        held: list[str] = []
        sizes: list[int] = []
        owners: list[int] = []

        def flush() -> None:
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            first = np.zeros(len(held), dtype=bool)
            first[starts] = True
            chance = marginals(self.emission(held), first, self.moves, self.start)
            most = np.maximum.reduceat(chance, starts)
            bad = most >= HALF
            found = 1 - np.exp(-evidence(chance, starts) * LOG2 / self.limit)
            scores[owners] = np.where(bad, found, most * LOG2 / self.limit)
            for at in np.flatnonzero(most >= HALF).tolist():
                own = chance[starts[at] : starts[at] + sizes[at]]
                bad = np.flatnonzero(own >= HALF)
                places = [m.span() for m in _WORD.finditer(texts[owners[at]])]
                if len(places) == sizes[at]:
                    spans[owners[at]] = [(*places[i], float(own[i])) for i in bad.tolist()]
            held.clear(), sizes.clear(), owners.clear()

        for i, text in enumerate(texts):
            words = _words(text.lower()) if text else []
            if words:
                held.extend(words), sizes.append(len(words)), owners.append(i)
                if len(held) >= CHUNK:
                    flush()
        if held:
            flush()
        return np.clip(scores, 0.0, 1.0), spans


# --- fitting -----------------------------------------------------------------------------------------------------------


class Sample:
    """Labelled documents as word numbers, with the features of each distinct word."""

    def __init__(self, texts: list[tuple[str, int]]):
        number: dict[str, int] = {}
        docs = []
        for text, label in texts:
            words = _words(text.lower())
            for w in words:
                if w not in number:
                    number[w] = len(number)
            if words:
                docs.append((np.fromiter(map(number.__getitem__, words), np.int32, len(words)), label))
        self.docs, self.count = docs, len(number)
        # features are known by their 32-bit hash, so that the driver keeps no string of theirs
        sizes, hashes = array("H"), array("L")
        for w in number:
            found = [zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in features(w)]
            sizes.append(len(found))
            hashes.extend(found)
        number.clear()
        self.sizes = np.array(sizes, dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])[: self.count].astype(np.int64)
        self.hashes, self.flat = np.unique(np.array(hashes, dtype=np.uint32), return_inverse=True)
        self.flat = self.flat.astype(np.int32)

    def of(self, words: np.ndarray) -> np.ndarray:
        """Distinct features of some words."""
        sizes = self.sizes[words]
        places = np.repeat(self.begins[words] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        return np.unique(self.flat[places])


def _once(sample: Sample) -> list[int]:
    """Numbers of the documents that are no near copy of an earlier one: no equal minimum of hashed word triples, of 4."""
    seen: set[tuple] = set()
    kept_ = []
    factors = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint64)
    for i, (words, label) in enumerate(sample.docs):
        codes = words.astype(np.uint64) + np.uint64(1)
        if len(codes) > 2:
            codes = codes[:-2] * np.uint64(0x10001) + codes[1:-1] * np.uint64(0x3F1) + codes[2:] * np.uint64(0x7)
        mixed = (codes[:, None] * factors + np.uint64(0x12345)) & np.uint64(0xFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x2C1B3C6D) & np.uint64(0xFFFFFFFF)
        marks = [(label, k, m) for k, m in enumerate(mixed.min(axis=0).tolist())]
        if not any(m in seen for m in marks):
            kept_.append(i)
        seen.update(marks)
    return kept_


def toxic_features(sample: Sample) -> np.ndarray:
    """For each feature, whether toxic documents have it more than chance explains."""
    counts = np.zeros((2, len(sample.hashes)), dtype=np.int32)
    some = [sample.docs[i] for i in _once(sample)]
    for words, label in some:
        counts[label, sample.of(np.unique(words))] += 1
    found = np.zeros(len(sample.hashes), dtype=bool)
    bad = sum(label for _, label in some)
    if not bad or bad == len(some):
        return found
    rate = bad / len(some)
    # a feature in a toxic and b clean documents arises by chance with less than rate ** a * C(a + b, a)
    limit = math.log(ALPHA / max(1, np.count_nonzero(counts[1])))
    clean, toxic = counts
    for f in np.flatnonzero((toxic > 1) & (toxic >= PURITY * (toxic + clean))).tolist():
        a, b = int(toxic[f]), int(clean[f])
        found[f] = a * math.log(rate) + math.lgamma(a + b + 1) - math.lgamma(a + 1) - math.lgamma(b + 1) < limit
    return found


def fit_field(texts: list[tuple[str, int]], epochs: int = EPOCHS) -> Field:
    """texts: (text, label) pairs."""
    sample = Sample(texts)
    size = 1 << BITS
    weights = np.zeros(size, dtype=np.float64)
    moves, start = np.zeros((2, 2)), np.zeros(2)
    marks = toxic_features(sample)
    if not marks.any():
        return Field(weights, moves, start)
    tagged = np.bitwise_or.reduceat(marks[sample.flat], sample.begins)
    # a toxic document in which no word is known to be toxic would teach that its words are clean
    docs = [(words, label) for words, label in sample.docs if not label or tagged[words].any()]
    numbers = (sample.hashes & np.uint32(size - 1)).astype(np.int64)[sample.flat]
    parts, seen_moves, seen_start = [], np.zeros((2, 2)), np.zeros(2)
    for some in _parts(docs):
        word_of = np.concatenate([words for words, _ in some])
        tags = np.concatenate([tagged[words] & bool(label) for words, label in some])
        first = np.zeros(len(word_of), dtype=bool)
        first[np.cumsum([0, *(len(words) for words, _ in some[:-1])])] = True
        before = np.flatnonzero(~first)
        np.add.at(seen_moves, (tags[before - 1].astype(int), tags[before].astype(int)), 1)
        seen_start += np.bincount(tags[first].astype(int), minlength=2)
        parts.append((word_of, tags, first))
    squares, move_squares, start_squares = np.full(size, 1e-8), np.full((2, 2), 1e-8), np.full(2, 1e-8)
    for turn in range(epochs + 1):
        per_word = np.add.reduceat(weights[numbers], sample.begins)
        wrong, moved, begun, found = np.zeros(sample.count), np.zeros((2, 2)), np.zeros(2), []
        for word_of, tags, first in parts:
            chance, m, b = marginals(per_word[word_of], first, moves, start, pairs=True)
            wrong += np.bincount(word_of, weights=tags - chance, minlength=sample.count)
            moved, begun = moved + m, begun + b
            if turn == epochs:
                found.append(evidence(chance, np.flatnonzero(first)))
        if turn == epochs:
            break
        slope = np.bincount(numbers, weights=np.repeat(wrong, sample.sizes), minlength=size) - PENALTY * weights
        squares += slope * slope
        weights += RATE * slope / np.sqrt(squares)
        slope = seen_moves - moved
        move_squares += slope * slope
        moves += RATE * slope / np.sqrt(move_squares)
        slope = seen_start - begun
        start_squares += slope * slope
        start += RATE * slope / np.sqrt(start_squares)
    return Field(weights, moves, start, _limit(np.concatenate(found), np.array([bool(label) for _, label in docs])))


def _parts(docs: list) -> Iterator[list]:
    """docs in parts of about CHUNK words."""
    some, size = [], 0
    for doc in docs:
        some.append(doc)
        size += len(doc[0])
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


def _limit(found: np.ndarray, toxic: np.ndarray) -> float:
    """The least evidence that tells the labelled documents apart best, LOG2 (the plain noisy-or) at least."""
    levels = np.unique(np.maximum(found, LOG2))
    tries = np.concatenate([[LOG2], (levels[1:] + levels[:-1]) / 2])
    right = [np.count_nonzero((found >= t) == toxic) for t in tries]
    return float(tries[int(np.argmax(right))])


def fit(
    docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic",
) -> Field:
    """A field fitted to the labelled documents (see the sample above)."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    marks = marks.agg(F.max(F.when(F.col(label_col) == 1, F.lit(1)).otherwise(F.lit(0))).alias("label"))
    turn = F.xxhash64(F.col("id"))
    chosen = [marks.where(F.col("label") == k).orderBy(turn, "id").limit(train_docs) for k in (0, 1)]
    chosen = chosen[0].union(chosen[1])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    rows = rows.join(F.broadcast(chosen), "id")  # at most 2 * train_docs rows
    # one text for each chosen id, should it be repeated: at most 2 * train_docs rows
    sizes = rows.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.length("text").alias("n"))).alias("r")).select("id", "r.*").collect()
    sizes.sort(key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["h"]))
    kept_, total = [], 0
    for r in sizes:
        if total + r["n"] <= train_chars:
            total += r["n"]
            kept_.append((r["id"], r["h"]))
    if not kept_:
        return fit_field([])
    # as an Arrow table, which goes to the JVM as it is: rows would start Python workers of another kind on every executor
    kind = StructType([rows.schema["id"], StructField("h", LongType())])
    some = docs.sparkSession.createDataFrame(pa.Table.from_pylist([{"id": i, "h": h} for i, h in kept_], to_arrow_schema(kind)), kind)
    rows = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(some), ["id", "h"], "left_semi")
    rows = rows.select("id", "h", "text", "label").dropDuplicates(["id", "h"]).orderBy("id", "h")
    return fit_field([(r["text"], r["label"]) for r in rows.toLocalIterator()])


def _sent(docs: DataFrame, field: Field):
    parts = docs.sparkSession.sparkContext.broadcast((field.weights.astype(np.float32), field.moves, field.start, field.limit))
    key = hashlib.sha256(field.weights.tobytes() + field.moves.tobytes() + field.start.tobytes() + repr(field.limit).encode()).hexdigest()
    return lambda: kept("toxicity field", key, lambda: Field(*parts.value))


def score_documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score and spans (start, end, marginal of each offending word) of every row."""
    own = _sent(docs, field)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores, spans = own().score(batch["text"].tolist())
            listed = [[{"start": s, "end": e, "marginal": p} for s, e, p in x] for x in spans]
            yield pd.DataFrame({"id": batch["id"], "score": scores, "spans": listed})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInPandas(run, f"id {kind}, score double, spans array<struct<start:int,end:int,marginal:double>>")
    return rows.select(F.col("id").alias(id_col), "score", "spans")


def without_toxic(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The rows of docs that score under HALF, with all their columns."""
    own = _sent(docs, field)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(own().score(batch.tolist())[0])

    return docs.where(score(F.col(text_col)) < HALF)


__all__ = ["Field", "fit", "fit_field", "held_out", "marginals", "score_documents", "without_toxic"]
