"""Benchmark decontamination: pigeonhole edit matching of test items in documents.

Items and documents are compared as lower-case words joined by single spaces, with a space at both ends, so a match without
edits stands between word boundaries. An item of n characters may differ by n // CHARS_PER_EDIT edits; it is cut in one piece
more, so at least one piece stands unchanged in every match. The pieces of all items are one sorted table of 64-bit hashes;
every place of a text is looked up in it for each length that pieces have, in numpy over many texts at once (a bit table turns
almost all places away first). Around each hit the item is verified with Myers' bit-parallel distance in the window that the
budget allows, neighbouring windows as one, so equal hashes of different pieces change nothing.

The table takes about three bytes a character of the items. Items go out in blocks of at most about BLOCK_CHARS characters;
a task takes its documents through one block after another, so the documents are read once however many items there are, and
holds one block's table at a time.

Defined results: a null text or item, or one without words, counts as empty and never matches; an item of any length is
sought, so one of a single common word is found wherever that word stands; items with the same words match alike; repeated
rows are judged one by one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

CHARS_PER_EDIT = 16
BLOCK_CHARS = 32_000_000
#: Characters of texts looked up at once, and pairs of a hit and an item's piece taken at once.
SLICE_CHARS = 1 << 20
SLICE_PAIRS = 1 << 20

_WORD = re.compile(r"\w+")


def plain(text: str | None) -> str:
    return " ".join(_WORD.findall(text.lower())) if text else ""


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """(least edit distance of pattern to a substring of text, that substring's end): the first of equal ends."""
    m = len(pattern)
    masks = pattern_masks(pattern) if masks is None else masks
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | minus
        d0 = (((eq & plus) + plus) ^ plus) | x
        hp = minus | ~(d0 | plus) & full
        hn = plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = (hp << 1) & full
        hn = (hn << 1) & full
        plus = hn | ~(d0 | hp) & full
        minus = hp & d0
        if score < best:
            best, end = score, i + 1
    return best, end


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of edits + 1 pieces, as equal as can be."""
    cuts = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(s, item[s:e]) for s, e in zip(cuts, cuts[1:], strict=False)]


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class WindowHashes:
    """Hashes of all windows of an array of code points: the same letters have the same hash wherever they stand."""

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        powers, back = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        powers[0] = back[0] = 1
        np.cumprod(powers, out=powers), np.cumprod(back, out=back)
        self.sums, self.back = np.zeros(n, np.uint64), back
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray | slice, sizes: np.ndarray | int) -> np.ndarray:
        if isinstance(starts, slice):
            plain_hash = (self.sums[sizes:] - self.sums[: len(self.sums) - sizes]) * self.back[: len(self.sums) - sizes]
        else:
            plain_hash = (self.sums[starts + sizes] - self.sums[starts]) * self.back[starts]
        plain_hash ^= plain_hash >> np.uint64(29)
        plain_hash *= np.uint64(0xBF58476D1CE4E5B9)
        return plain_hash ^ (plain_hash >> np.uint64(32))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Matcher:
    def __init__(self, items: list[tuple[object, str]], chars_per_edit: int = CHARS_PER_EDIT):
        groups: dict[str, list] = defaultdict(list)
        for name, text in items:
            if words := plain(text):
                groups[f" {words} "].append(name)
        self.items = list(groups.items())
        self.edits = [(len(words) - 2) // chars_per_edit for words, _ in self.items]
        self.masks: dict[int, dict[str, int]] = {}
        cuts = [(i, at, len(piece)) for i, (words, _) in enumerate(self.items) for at, piece in pieces(words, self.edits[i])]
        item, at, size = np.array(cuts or np.empty((0, 3)), dtype=np.int64).T
        begins = np.concatenate([[0], np.cumsum([len(words) for words, _ in self.items])]).astype(np.int64)
        hashes = WindowHashes(_codes("".join(words for words, _ in self.items))).of(begins[item] + at, size)
        order = np.argsort(hashes, kind="stable")
        #: Pieces by hash: their items and places in them; the distinct hashes, and where the pieces of each begin.
        self.of_item, self.at = item[order].astype(np.int32), at[order].astype(np.int32)
        self.hashes, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.sizes = np.unique(size).tolist()
        self.shift = np.uint64(64 - max(10, (16 * len(self.hashes)).bit_length()))
        self.bits = np.zeros(1 << int(np.uint64(64) - self.shift), bool)
        self.bits[self.hashes >> self.shift] = True

    def _hits(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(number of the text, item, start of the item if the piece's place is its own) of each hit."""
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        windows = WindowHashes(_codes("\0".join(texts)))
        for size in self.sizes:
            if size >= len(windows.sums):
                continue
            hashes = windows.of(slice(None), size)
            places = np.flatnonzero(self.bits[hashes >> self.shift])
            found = np.searchsorted(self.hashes, hashes[places])
            found[found == len(self.hashes)] = 0
            same = self.hashes[found] == hashes[places] if len(self.hashes) else np.zeros(0, bool)
            places, found = places[same], found[same]
            counts = self.first[found + 1] - self.first[found]
            ends = np.cumsum(counts)
            s = 0
            while s < len(places):  # a hit whose hash very many items have is taken alone
                e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + SLICE_PAIRS, side="right")))
                many = counts[s:e]
                within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                piece, place = np.repeat(self.first[found[s:e]], many) + within, np.repeat(places[s:e], many)
                text = np.searchsorted(begins, place, side="right") - 1
                yield text, self.of_item[piece], place - begins[text] - self.at[piece]
                s = e

    def match_all(self, texts: list[str | None]) -> list[list[tuple[object, int, int, int]]]:
        """match() of each text."""
        found: list[list] = [[] for _ in texts]
        begun = 0
        while begun < len(texts):
            ended, chars = begun, 0
            while ended < len(texts) and (ended == begun or chars < SLICE_CHARS):
                chars += len(texts[ended] or "")
                ended += 1
            words = [f" {w} " if (w := plain(t)) else "" for t in texts[begun:ended]]
            starts: dict[tuple[int, int], set[int]] = defaultdict(set)
            for text, item, start in self._hits(words) if self.items else ():
                for t, i, s in zip(text.tolist(), item.tolist(), start.tolist(), strict=True):
                    starts[t, i].add(s)
            for (t, i), places in sorted(starts.items()):
                if best := self.verify(words[t], i, sorted(places)):
                    distance, s, e = best
                    s += words[t][s:e].startswith(" ")
                    e -= words[t][s:e].endswith(" ")
                    span = original_span(texts[begun + t], s - 1, e - 1)
                    found[begun + t] += [(name, distance, *span) for name in self.items[i][1]]
            begun = ended
        return found

    def match(self, text: str | None) -> list[tuple[object, int, int, int]]:
        """(item, distance, start, end) of each item that the text holds, at its nearest place (the first of equals);
        start and end are code points of the text, end exclusive."""
        return self.match_all([text])[0]

    def verify(self, words: str, i: int, starts: list[int]) -> tuple[int, int, int] | None:
        item, edits = self.items[i][0], self.edits[i]
        for s in starts:
            if s >= 0 and words.startswith(item, s):
                return 0, s, s + len(item)
        if not edits:
            return None
        if i not in self.masks:
            self.masks[i] = pattern_masks(item)
        best = None
        windows: list[list[int]] = []
        for s in starts:
            low, high = max(0, s - edits), min(len(words), s + len(item) + edits)
            if windows and low <= windows[-1][1]:
                windows[-1][1] = max(high, windows[-1][1])
            else:
                windows.append([low, high])
        for low, high in windows:
            distance, end = myers(item, words[low:high], self.masks[i])
            if distance <= edits and (best is None or distance < best[0]):
                back = words[max(low, low + end - len(item) - edits) : low + end][::-1]
                _, size = myers(item[::-1], back)
                best = distance, low + end - size, low + end
        return best


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """The place in the text of a place in its words."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if len(text) != len(text.lower()):  # a letter with a longer lower case: count each word's own length
        sizes = [len(text[s:e].lower()) for s, e in spans]
    else:
        sizes = [e - s for s, e in spans]
    starts, at = [], 0
    for size in sizes:
        starts.append(at)
        at += size + 1
    first = max(0, bisect_right(starts, start) - 1)
    last = max(first, bisect_left(starts, end) - 1)
    return spans[first][0], spans[last][1]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[object, str]]]:
    rows = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == b) if blocks > 1 else rows
        yield [(r["id"], r["text"]) for r in part.toLocalIterator()]


def _matched(docs: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, block_chars: int):
    """A function from texts to their matches in all blocks, for the executors; a worker keeps the table that it used last."""
    blocks = []
    for items in item_blocks(benchmark, item_col, text_col, block_chars):
        key = hashlib.sha256(repr(sorted(items, key=repr)).encode()).hexdigest()
        blocks.append((key, docs.sparkSession.sparkContext.broadcast(items)))

    def match(texts: list[str | None]) -> list[list[tuple[object, int, int, int]]]:
        found: list[list] = [[] for _ in texts]
        for key, items in blocks:
            for own, more in zip(found, kept("matcher", key, lambda items=items: Matcher(items.value)).match_all(texts), strict=True):
                own += more
        return found

    return match


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row for each row of docs and item that it holds: id, item_id, distance, start, end. Clean rows have none."""
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    match = _matched(docs, benchmark, item_col, "text", block_chars)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [(name, *hit) for name, found in zip(batch["id"], match(batch["text"].tolist()), strict=True) for hit in found]
            if hits:
                yield pd.DataFrame(hits, columns=["id", "item_id", "distance", "start", "end"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.mapInPandas(run, f"id {kind}, item_id {item_kind}, distance int, start int, end int")
    return rows.withColumnRenamed("id", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs that hold no item, with all their columns."""
    match = _matched(docs, benchmark, item_col, "text", block_chars)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not found for found in match(texts.tolist())], dtype=bool)

    return docs.where(clean(F.col(f"`{text_col}`")))
