import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from corpusloom.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n):
    r = random.Random(3)
    letters = "aAbZéÉßΣ  \n\t'sStTreve 19²½ắ\x85\xa0　😀-_<|endoftext|>\x1c\x00"
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(n)]


TEXTS = [None, "", "Hello  world's   end \n", "<|endoftext|>", "a" * 5000, "abcdefgh" * 60, "中文字符" * 80, " " * 300, *random_texts(300)]


def words_of(texts):
    return sorted({w for t in filter(None, texts) for w in B.regex.findall(public_tokenizers.PATTERN, t)})


def test_long_merges_match_the_library(ranks, library):
    for word in words_of(TEXTS):
        assert B.merge_long(word.encode(), ranks) == library._core_bpe.encode_single_piece(word.encode())


def test_fold_matches_the_library(spark, ranks, library):
    words = [w for w in words_of(TEXTS) if len(w.encode()) <= B.LONG_WORD]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = frame.select("word", B.fold_ids(F.col("word"), B.PairRanks(ranks)).alias("ids")).collect()
    assert len(got) > 300 and max(len(w) for w in words) > 200
    for r in got:
        assert list(r.ids) == library._core_bpe.encode_single_piece(r.word.encode())


def test_pair_ranks_of_a_small_vocabulary(spark):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257, b"ba": 258}
    frame = spark.createDataFrame([("ababab",), ("bab",), ("",), ("c",)], "word string")
    got = {r.word: list(r.ids) for r in frame.select("word", B.fold_ids(F.col("word"), B.PairRanks(ranks)).alias("ids")).collect()}
    assert got == {"ababab": [257, 256], "bab": [98, 256], "": [], "c": [99]}
    with pytest.raises(ValueError):
        B.PairRanks({b"a": 1 << B.ID_BITS})


def test_rows(spark, ranks, library):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], 0)], "doc_id long, text string, n_tokens int")
    rows = B.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    encoded = B.encode_documents(docs, PATH, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.data).decode() for r in B.decode_documents(encoded, PATH).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert B.round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_small_blocks_give_the_same(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    whole, small = (B.round_trip(docs, PATH, public_tokenizers.PATTERN, **k).orderBy("doc_id").collect() for k in ({}, {"block_words": 7}))
    assert whole == small == B.round_trip(docs, PATH, public_tokenizers.PATTERN, block_codes=1).orderBy("doc_id").collect()


def test_cutter_cuts_as_the_pattern():
    cut, words = B.word_cutter(public_tokenizers.PATTERN), B.regex.compile(public_tokenizers.PATTERN).findall
    every = "".join(f"{chr(c)}a{chr(c)}{chr(c)}1 " for c in range(256))
    for text in [*filter(None, TEXTS), every, *(every[i:] for i in range(1, 9))]:
        assert cut(text) == words(text)
