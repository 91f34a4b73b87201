"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters of the lower-cased text, words set apart by one space, give n-grams of 1 to ORDERS characters, hashed to BUCKETS.
The model is a matrix of log probabilities (languages x BUCKETS floats), fitted on a sample of about TRAIN_DOCS documents a
language (chosen by a hash of the id; all of a language that has fewer) and broadcast. Scoring gathers matrix rows of many
documents at once and sums them by document.

Defined results: a null text, or one without a letter, is `und` with score 0, as is every text where nothing could be
learned; ties go to the first language in order; repeated rows are judged one by one; other columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept

ORDERS = 3
BUCKETS = 1 << 16
TRAIN_DOCS = 4000
SMOOTHING = 0.5
#: Numbers gathered at once: characters times languages. A longer text is scored in slices.
GATHERED = 1 << 22
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+").findall
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def letters(text: str | None) -> str:
    """Words of letters, each between single spaces; empty if there is no letter."""
    if not text:
        return ""
    words = _WORDS(text.lower())
    if not any(map(str.isalpha, words)) and not any(c.isalpha() for w in words for c in w):
        return ""
    return f" {' '.join(words)} "


def ngram_buckets(text: str) -> list[np.ndarray]:
    """For each order, the bucket of the n-gram that begins at each character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found, mixed = [], np.zeros(len(codes), dtype=np.uint32)
    for n in range(min(ORDERS, len(codes))):
        mixed = mixed[: len(codes) - n] * np.uint32(0x01000193) + (codes[n:] + np.uint32(n + 1)) * _MULTIPLIERS[n]
        hashed = mixed ^ (mixed >> np.uint32(15))
        found.append((hashed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return found


class Model:
    def __init__(self, languages: list[str], table: np.ndarray, prior: np.ndarray):
        """table: BUCKETS x languages log probabilities."""
        self.languages, self.table, self.prior = languages, table, prior

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        held: list[str] = []
        owners: list[int] = []
        chunk = max(1, GATHERED // len(self.languages))

        def decide(total: np.ndarray, owners: list[int]) -> None:
            total = total + self.prior
            best = total.argmax(axis=1)
            chance = np.exp(total - total.max(axis=1, keepdims=True))
            chance = chance.max(axis=1) / chance.sum(axis=1)
            for i, b, c in zip(owners, best.tolist(), chance.tolist(), strict=True):
                names[i], scores[i] = self.languages[b], c

        def flush() -> None:
            sizes = np.fromiter(map(len, held), np.int64, len(held))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            total = np.zeros((len(held), len(self.languages)))
            for n, buckets in enumerate(ngram_buckets("".join(held))):
                gathered = self.table[buckets]
                # n-grams across a border of two texts begin and end with its spaces: they are left out
                for back in range(1, n + 1):
                    gathered[starts[1:] - back] = 0
                total += np.add.reduceat(gathered, np.minimum(starts, len(gathered) - 1), axis=0, dtype=np.float64)
            decide(total, owners)
            held.clear(), owners.clear()

        size = 0
        for i, text in enumerate(texts):
            plain = letters(text)
            if len(plain) > chunk:
                decide(self._sliced(plain, chunk)[None, :], [i])
            elif plain:
                held.append(plain), owners.append(i)
                size += len(plain)
                if size >= chunk:
                    flush()
                    size = 0
        if held:
            flush()
        return names, scores

    def _sliced(self, plain: str, chunk: int) -> np.ndarray:
        """Log probability of a text by language, by slices of n-grams that begin in the same `chunk` characters."""
        total = np.zeros(len(self.languages))
        for at in range(0, len(plain), chunk):
            for buckets in ngram_buckets(plain[at : at + chunk + ORDERS - 1]):
                total += self.table[buckets[:chunk]].sum(axis=0, dtype=np.float64)
        return total


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the labelled documents; those with a null label or text are left out."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col)).count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), dtype=np.float32), np.zeros(0))
    chance = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30).cast("bigint")) / float(1 << 30)
    share = F.lit(0.0)
    for language, n in counts.items():
        share = F.when(F.col(lang_col) == language, F.lit(min(1.0, train_docs / n))).otherwise(share)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, group in batch.groupby("lang"):
                total = np.zeros(BUCKETS, dtype=np.int64)
                for text in group["text"]:
                    for buckets in ngram_buckets(letters(text)):
                        total += np.bincount(buckets, minlength=BUCKETS)
                there = np.flatnonzero(total)
                yield pd.DataFrame({"lang": language, "bucket": there.astype(np.int32), "n": total[there]})

    sample = rows.where(chance < share).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    found = sample.mapInPandas(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = found.toPandas()
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    where = {language: i for i, language in enumerate(languages)}
    np.add.at(table, (found["bucket"].to_numpy(np.int64), found["lang"].map(where).to_numpy(np.int64)), found["n"].to_numpy(float))
    table = np.log(table / table.sum(axis=0)).astype(np.float32)
    prior = np.log(np.array([counts[x] for x in languages], dtype=float) / sum(counts.values()))
    return Model(languages, table, prior)


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo folds, is fold; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def predict_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every row."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    parts = spark.sparkContext.broadcast((model.languages, model.table, model.prior))
    key = hashlib.sha256(repr(model.languages).encode() + model.table.tobytes() + model.prior.tobytes()).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = kept("language model", key, lambda: Model(*parts.value))
        for batch in batches:
            names, scores = own.predict(batch["text"].tolist())
            yield pd.DataFrame({"id": batch["id"], "lang_pred": names, "score": scores})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInPandas(run, f"id {kind}, lang_pred string, score double")
    return rows.select(F.col("id").alias(id_col), "lang_pred", "score")
