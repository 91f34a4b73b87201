"""Token counts by heap-and-linked-list byte-pair merging.

A word's bytes form a doubly linked list; a heap holds the adjacent pairs that have a rank. The lowest-rank (then leftmost)
pair is popped, skipped if what stands there now makes another symbol, or merged, and the pairs with its new neighbours
are pushed. The count is the initial symbols minus the merges; no identifiers are made. Words' counts are kept in a bounded
cache of each worker, so a frequent word is merged once for each time it is forgotten.

The vocabulary file is read by the driver and broadcast (its size is that of the file, some MB whatever the corpus).

Defined results: a null text counts as empty (0 bytes, 0 tokens); special strings inside texts are one token each, as the
library does by default; repeated rows are counted one by one; other columns take no part.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

OVER = 2048
CACHE_WORDS = 400_000


def byte_letters() -> list[str]:
    """The printable stand-in for each byte that byte-level vocabularies are written in."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Merges:
    """What counting needs of a tokenizer file of kind BPE: symbols by id, ranks of pairs, pattern, suffix, specials."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = model["end_of_word_suffix"] or ""
        self.ranks = {(vocab[a] << 20) | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        letters = byte_letters()
        self.inner = [vocab.get(c, -1) for c in letters]
        self.last = [vocab.get(c + suffix, -1) for c in letters]
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        self.nfc = any(s["type"] == "NFC" for s in steps)
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        splits = [p for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
        self.pattern = splits[0]["pattern"]["Regex"] if splits else None
        self.special = [t["content"] for t in spec["added_tokens"]]


def count_merges(symbols: list[int], ranks: dict[int, tuple[int, int]]) -> int:
    """The merges that byte-pair encoding makes of a list of symbols (which is changed)."""
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = ranks.get((symbols[i] << 20) | symbols[i + 1])
        if found is not None:
            heap.append((found[0], i, found[1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, new = heapq.heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j >= n:
            continue
        found = ranks.get((symbols[i] << 20) | symbols[j])
        if found is None or found[1] != new:
            continue
        symbols[i], symbols[j] = new, -1
        k = after[j]
        after[i] = k
        merges += 1
        if k < n:
            before[k] = i
            found = ranks.get((new << 20) | symbols[k])
            if found is not None:
                heapq.heappush(heap, (found[0], i, found[1]))
        h = before[i]
        if h >= 0:
            found = ranks.get((symbols[h] << 20) | new)
            if found is not None:
                heapq.heappush(heap, (found[0], h, found[1]))
    return merges


class Counter(dict):
    """word -> its tokens; a missing word is counted by merging."""

    def __init__(self, merges: Merges, cache_words: int = CACHE_WORDS):
        super().__init__()
        self.merges, self.cache_words = merges, cache_words
        self.words = regex.compile(merges.pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None

    def __missing__(self, word: str) -> int:
        if len(self) >= self.cache_words:
            self.clear()
        data = word.encode("utf-8", "surrogatepass")
        symbols = [*map(self.merges.inner.__getitem__, data[:-1]), self.merges.last[data[-1]]]
        symbols = [s for s in symbols if s >= 0]
        count = self[word] = len(symbols) - count_merges(symbols, self.merges.ranks)
        return count

    def plain(self, text: str) -> int:
        if self.merges.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.merges.lower:
            text = text.lower() if text.isascii() else simple_lower(text)
        return sum(map(self.__getitem__, self.words(text)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return sum(map(self.plain, self.special.split(text))) + len(self.special.findall(text))


#: Letters with a lower case since Unicode 16, which Python's tables may lack.
NEW_LOWER = {0xA7CB: 0x264, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B, **{c: c + 32 for c in range(0x10D50, 0x10D66)}}
HAS_NEW_LOWER = regex.compile("[" + "".join(map(chr, NEW_LOWER)) + "]").search


def simple_lower(text: str) -> str:
    """Lower case letter by letter: a final sigma stays an ordinary one."""
    text = text.replace("Σ", "σ").lower()
    return text.translate(NEW_LOWER) if HAS_NEW_LOWER(text) else text


def token_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", over: int = OVER, cache_words: int = CACHE_WORDS
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row; vocabulary: path of a tokenizer file on the driver."""
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    source, key = spark.sparkContext.broadcast(text), (hashlib.sha256(text.encode()).hexdigest(), cache_words)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = kept("token counter", key, lambda: Counter(Merges(source.value), cache_words))
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "n_bytes": batch["n_bytes"], "n_tokens": list(map(counter.count, batch["text"]))})

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    rows = rows.mapInPandas(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
