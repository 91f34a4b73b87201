"""Byte-level byte-pair encoding and decoding by ranked merges.

A text is cut in words by the pattern. A word's bytes are an array of pieces, and the leftmost of the lowest-ranked adjacent
pairs is merged until none has a rank; a text's ids are those of its words' pieces. Decoding concatenates the pieces of ids.

The distinct words of a block of documents are folded by Spark higher-order functions over a literal rank map. A block is what
one task reads until BLOCK_WORDS distinct words or BLOCK_CODES words in all are held; its documents become numbers of its
words. Words and numbers then go on in one stream, words first: the fold runs on the words' rows in the JVM, and the numbers
are replaced by the ids that came before them in the same task. Nothing is joined or broadcast but the vocabulary, nothing
shuffled (but a table of fewer splits than cores), and no word is sampled or left out. The rank map is an array with a place for each pair of pieces that merges, found by a
hash without collisions, since Spark looks a map up one entry at a time. A fold takes time with the square of the word's
length, so words of over LONG_WORD bytes are merged where they are cut, by a heap over linked pieces, with the same ids.

Defined results: a null text counts as empty (no id; the digests are those of empty bytes); special strings are ordinary
text; repeated rows are encoded one by one; other columns take no part.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, spare

BLOCK_WORDS = 1 << 20
BLOCK_CODES = 1 << 24
SPLITS = 3
#: Words of a row of the stream, and bytes from which a word is merged by a heap.
ROW_WORDS = 512
LONG_WORD = 512
#: Widths in bits of a piece's id and of a rank (its greatest value: no rank); a byte's place takes what LONG_WORD needs.
ID_BITS, RANK_BITS, PLACE_BITS = 18, 19, 10
NO_RANK = (1 << RANK_BITS) - 1


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# --- the fold in higher-order functions --------------------------------------------------------------------------------


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _ones(bits: int) -> Column:
    return _long((1 << bits) - 1)


class PairRanks:
    """The rank that two adjacent pieces merge to, as a literal that Spark reads at one place.

    A pair's 64-bit hash names a bucket by its upper bits and a place by lower ones; the bucket's shift, found here by trying,
    moves its pairs to places of their own (hash and displace).
    """

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= 1 << ID_BITS:
            raise ValueError(f"more than {1 << ID_BITS} pieces")
        pairs = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << ID_BITS | right] = rank
        self.place_bits = max(4, (2 * len(pairs)).bit_length())
        self.bucket_bits = max(2, self.place_bits - 2)
        shifts, slots = self._displace(np.array(list(pairs), dtype=np.uint64))
        places = np.full(1 << self.place_bits, -1, dtype=np.int64)
        places[slots] = np.fromiter((k << RANK_BITS | r for k, r in pairs.items()), np.int64, len(pairs))
        # what two bytes merge to has a place of its own, since half of all looks are for that
        two = [ranks.get(bytes([i, j]), NO_RANK) for i in range(256) for j in range(256)]
        tables = {"s": shifts.tolist(), "p": places.tolist(), "b": [ranks.get(bytes([i]), -1) for i in range(256)], "two": two}
        self.literal = F.from_json(F.lit(json.dumps(tables)), "struct<s:array<int>,p:array<bigint>,b:array<bigint>,two:array<bigint>>")

    def _displace(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shifts by bucket and places by key; another turn of the hash where two keys share bucket and place."""
        for self.turn in range(1 << 10):
            salted = (int(k) | self.turn << 2 * ID_BITS for k in keys)
            hashed = np.array([xxhash.xxh64_intdigest(k.to_bytes(8, "little"), 42) for k in salted], dtype=np.uint64)  # Spark's xxhash64
            bucket = (hashed >> np.uint64(64 - self.bucket_bits)).astype(np.int64)
            place = (hashed & np.uint64((1 << self.place_bits) - 1)).astype(np.int64)
            if len(np.unique(bucket << self.place_bits | place)) == len(keys):
                break
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(keys) else []
        shifts, used, rng = np.zeros(1 << self.bucket_bits, np.int64), np.zeros(1 << self.place_bits, bool), np.random.default_rng(1)
        for group in sorted(groups, key=len, reverse=True):
            shift = 0
            while used[place[group] ^ shift].any():
                shift = int(rng.integers(1 << self.place_bits))
            place[group] ^= shift
            used[place[group]] = True
            shifts[bucket[group[0]]] = shift
        return shifts, place

    def of(self, table: Column, left: Column, right: Column) -> Column:
        """The rank of two pieces, NO_RANK if they don't merge. table: the literal, or what stands for it in a lambda."""

        def look(pair: Column) -> Column:
            hashed = F.xxhash64(pair.bitwiseOR(_long(self.turn << 2 * ID_BITS)))
            shift = F.get(table["s"], F.shiftrightunsigned(hashed, 64 - self.bucket_bits).cast("int"))
            place = hashed.bitwiseAND(_ones(self.place_bits)).cast("int").bitwiseXOR(shift)
            found = lambda x: F.when(F.shiftright(x, RANK_BITS) == pair, x.bitwiseAND(_ones(RANK_BITS))).otherwise(_long(NO_RANK))
            return _let(F.get(table["p"], place), found)

        return _let(F.shiftleft(left, ID_BITS).bitwiseOR(right), look)


def fold_ids(word: Column, pairs: PairRanks, table: Column | None = None) -> Column:
    """The ids of a word (of LONG_WORD bytes at most) after all merges.

    An element of the folded array is a piece: the rank of its pair with the next one, the place of its first byte and its id,
    from the upper bits down, so the least element is the leftmost of the lowest-ranked pairs. A step puts that pair's piece
    in place of its first half, ranks it with both neighbours and takes the second half out.
    """
    if table is None:
        return _let(pairs.literal, lambda t: fold_ids(word, pairs, t))
    rank_at, low = ID_BITS + PLACE_BITS, _ones(ID_BITS)
    none = _long(NO_RANK << rank_at)
    ranked = lambda left, right: F.shiftleft(pairs.of(table, left, right), rank_at)
    letters = F.regexp_extract_all(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), F.lit("(?s)."), F.lit(0))

    def step(pieces: Column, _: Column) -> Column:
        def merge(least: Column) -> Column:
            new = F.shiftright(least, rank_at)

            def put(at: Column) -> Column:
                def each(piece: Column, i: Column) -> Column:
                    after = F.when(at + 2 < F.size(pieces), ranked(new, F.get(pieces, at + 2).bitwiseAND(low))).otherwise(none)
                    first = after.bitwiseOR(least.bitwiseAND(_long(((1 << PLACE_BITS) - 1) << ID_BITS))).bitwiseOR(new)
                    before = ranked(piece.bitwiseAND(low), new).bitwiseOR(piece.bitwiseAND(_ones(rank_at)))
                    away = i - at
                    return F.when(F.abs(away) > 1, piece).when(away == 0, first).when(away == -1, before).otherwise(_long(-1))

                return F.filter(F.transform(pieces, each), lambda x: x >= 0)

            return F.when(least >= none, pieces).otherwise(_let(F.array_position(pieces, least).cast("int") - 1, put))

        return _let(F.array_min(pieces), merge)

    def folded(codes: Column) -> Column:
        def ranked_with_next(c: Column, i: Column) -> Column:
            rank = F.coalesce(F.get(table["two"], F.shiftleft(c, 8).bitwiseOR(F.get(codes, i + 1))), _long(NO_RANK))
            return F.shiftleft(rank, rank_at).bitwiseOR(F.shiftleft(i.cast("bigint"), ID_BITS)).bitwiseOR(F.get(table["b"], c))

        done = F.aggregate(F.slice(codes, F.lit(2), F.size(codes)), F.transform(codes, ranked_with_next), step)
        return F.transform(done, lambda x: x.bitwiseAND(low).cast("int"))

    return _let(F.transform(letters, lambda c: F.ascii(c)), folded)


# --- cutting texts -----------------------------------------------------------------------------------------------------


def latin_pattern(pattern: str) -> str:
    """The pattern for texts of the first 256 characters, with its character properties spelt out as Python's re needs them."""
    chars = "".join(map(chr, range(256)))
    spelt = lambda p: "".join(f"\\x{ord(m[0]):02x}-\\x{ord(m[-1]):02x}" for m in regex.findall(f"(?:{p})+", chars))
    out, inside = [], False
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.DOTALL):
        if re.fullmatch(r"\\(?:[pP]\{\w+\}|[sSdDwW])", part):
            part = spelt(part) if inside else f"[{spelt(part)}]"
        inside = (inside or part == "[") and part != "]"
        out.append(part)
    return "".join(out)


def word_cutter(pattern: str) -> Callable[[str], list[str]]:
    """The pattern's matches in a text; texts of the first 256 characters go to re, which is faster, the others to regex."""
    narrow, wide = re.compile(latin_pattern(pattern)).findall, regex.compile(pattern).findall

    def cut(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return wide(text)
        return narrow(text)

    return cut


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """ids of a word by ranked merges, with a heap over linked pieces: n log n."""
    n = len(word)
    ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ends[j] != end:
            continue
        alive[j] = False
        ends[i], after[i] = end, after[j]
        if after[j] < n:
            k = after[j]
            before[k] = i
            if (rank := ranks.get(word[i : ends[k]])) is not None:
                heapq.heappush(heap, (rank, i, ends[k]))
        if (h := before[i]) >= 0 and (rank := ranks.get(word[h:end])) is not None:
            heapq.heappush(heap, (rank, h, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : ends[i]]])
        i = after[i]
    return out


class Numbers(dict):
    """word -> its number in a block: from 0 for those to fold, from -1 down for those whose ids are known where they are cut
    (pieces as a whole, and long words)."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.words, self.known = ranks, [], []

    def __missing__(self, word: str) -> int:
        data = word.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        if rank is None and len(data) <= LONG_WORD:
            self.words.append(word)
            number = len(self.words) - 1
        else:
            self.known.append(np.array([rank] if rank is not None else merge_long(data, self.ranks), "<u4").tobytes())
            number = -len(self.known)
        self[word] = number
        return number


# --- the stream of blocks ----------------------------------------------------------------------------------------------

#: What a row of the stream holds: words to fold, the ids of one known word, or a document's word numbers.
_WORDS, _KNOWN, _DOCUMENT = 0, 1, 2
_STREAM = ["kind", "id", "data", "words"]


def _blocks(batches: Iterator[pd.DataFrame], cut, ranks: dict[bytes, int], block_words: int, block_codes: int) -> Iterator[pd.DataFrame]:
    numbers, ids, documents, total = Numbers(ranks), [], [], 0

    def flush() -> Iterator[pd.DataFrame]:
        words = [numbers.words[at : at + ROW_WORDS] for at in range(0, len(numbers.words), ROW_WORDS)]
        for at in range(0, len(words), 64):
            yield pd.DataFrame([(_WORDS, None, None, w) for w in words[at : at + 64]], columns=_STREAM)
        for at in range(0, len(numbers.known), 4096):
            yield pd.DataFrame([(_KNOWN, None, x, None) for x in numbers.known[at : at + 4096]], columns=_STREAM)
        for at in range(0, len(ids), 1024):
            yield pd.DataFrame([(_DOCUMENT, i, d, None) for i, d in zip(ids[at : at + 1024], documents[at : at + 1024], strict=True)], columns=_STREAM)

    for batch in batches:
        for name, text in zip(batch["id"].tolist(), batch["text"], strict=True):
            codes = np.array(list(map(numbers.__getitem__, cut(text))) if text else [], "<i4")
            ids.append(name), documents.append(codes.tobytes())
            total += len(codes)
            if len(numbers) >= block_words or total >= block_codes:
                yield from flush()
                numbers, ids, documents, total = Numbers(ranks), [], [], 0
                spare()
    yield from flush()


def _encoded(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[bytes]]]:
    """ids of documents and their token ids as bytes, from a stream whose words are folded."""
    folded: list[bytes] = []
    known: list[bytes] = []
    table: list[bytes] = []
    for batch in batches:
        kinds = batch["kind"].to_numpy()
        cuts = [0, *(np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist(), len(kinds)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if s == e:
                continue
            some, kind = batch[s:e], kinds[s]
            if kind != _DOCUMENT and table:
                folded, known, table = [], [], []
            if kind == _WORDS:
                for found in some["found"]:
                    data, ends = np.asarray(found["ids"], "<u4").tobytes(), (4 * np.cumsum(found["sizes"])).tolist()
                    folded += [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            elif kind == _KNOWN:
                known += some["data"].tolist()
            else:
                table = table or folded + known[::-1] or [b""]
                get = table.__getitem__
                for at in range(0, len(some), 512):
                    part = some[at : at + 512]
                    yield part["id"].tolist(), [b"".join(map(get, np.frombuffer(d, "<i4").tolist())) for d in part["data"]]


def _dealt(docs: DataFrame) -> DataFrame:
    """docs in tasks of SPLITS splits, since a larger block folds a word that repeats in it once, but in two tasks a core at least;
    a table of fewer splits than cores is dealt out."""
    splits, cores = docs.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores) if splits < cores else docs.coalesce(max(2 * cores, splits // SPLITS))


def _stream(docs: DataFrame, vocabulary: str, pattern: str, id_col: str, text_col: str, block_words: int, block_codes: int) -> DataFrame:
    """kind, id, data and found: the stream with its words folded; ids has those of a row's words one after another."""
    ranks = read_ranks(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = kept("word cutter", pattern, lambda: word_cutter(pattern))
        yield from _blocks(batches, cut, sent.value, block_words, block_codes)

    rows = _dealt(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    rows = rows.mapInPandas(run, f"kind tinyint, id {kind}, data binary, words array<string>")
    pairs = PairRanks(ranks)
    ids = _let(pairs.literal, lambda table: F.transform("words", lambda w: fold_ids(w, pairs, table)))
    flat = lambda x: F.struct(F.flatten(x).alias("ids"), F.transform(x, lambda y: F.size(y)).alias("sizes"))
    found = F.when(F.col("kind") == _WORDS, _let(ids, flat)).alias("found")
    return rows.select("kind", "id", "data", found)


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (1 + max(ranks.values(), default=-1))
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS, block_codes: int = BLOCK_CODES
) -> DataFrame:
    """id and ids (array) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for names, data in _encoded(batches):
            yield pd.DataFrame({"id": names, "ids": [np.frombuffer(d, "<u4").astype(np.int32) for d in data]})

    stream, kind = _stream(docs, vocabulary, pattern, id_col, text_col, block_words, block_codes), docs.schema[id_col].dataType.simpleString()
    return stream.mapInPandas(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and data (binary) of every row of ids; null ids count as none, an unknown id raises."""
    sent, kind = encoded.sparkSession.sparkContext.broadcast(_pieces(read_ranks(vocabulary))), encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = sent.value.__getitem__
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "data": [b"" if ids is None else b"".join(map(get, ids)) for ids in batch["ids"]]})

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInPandas(run, f"id {kind}, data binary")
    return rows.select(F.col("id").alias(id_col), "data")


def round_trip(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS, block_codes: int = BLOCK_CODES
) -> DataFrame:
    """id, n_tokens, ids_sha256 (of little-endian ids) and decoded_sha256 (of the bytes decoded from them) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(_pieces(read_ranks(vocabulary)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = kept("pieces", vocabulary, lambda: sent.value).__getitem__
        for names, data in _encoded(batches):
            decoded = [b"".join(map(get, np.frombuffer(d, "<u4").tolist())) for d in data]
            digest = lambda rows: [hashlib.sha256(x).hexdigest() for x in rows]
            yield pd.DataFrame({"id": names, "n_tokens": [len(d) // 4 for d in data], "ids_sha256": digest(data), "decoded_sha256": digest(decoded)})

    stream, kind = _stream(docs, vocabulary, pattern, id_col, text_col, block_words, block_codes), docs.schema[id_col].dataType.simpleString()
    rows = stream.mapInPandas(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return rows.select(F.col("id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256")
