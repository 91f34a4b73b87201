import random

import public_tokenizers
from tokenizers import Tokenizer

from corpusloom.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_same_as_the_library():
    with open(PATH, encoding="utf-8") as f:
        counter = T.Counter(T.Merges(f.read()), cache_words=500)
    r = random.Random(1)
    letters = "aAbZéÉßΣσς  \n\t'sStTreve 19²½İıK̈ắ\x85\xa0　😀-_<|endoftext|>\x1c\x00"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["x<|endoftext|>y <|startoftext|>", "<|endoftext|><|endoftext|>", "a" * 5000, "ab " * 4000, "ÅꟋꟜ"]
    texts += [f"a{chr(c)}b {chr(c)}9" for c in [*range(1, 0x3000, 7), *range(0x20000, 0x20400)]]
    assert [counter.count(t) for t in texts] == library(texts)


def test_rows(spark):
    texts = [None, "", "Hello, hello world", "Hello, hello world", "x " * 3000]
    docs = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    rows = sorted(T.token_counts(docs, PATH).collect())
    want = library([t or "" for t in texts])
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [
        (len((t or "").encode()), n, n > 2048) for t, n in zip(texts, want, strict=True)
    ]
    assert T.token_counts(docs.limit(0), PATH).count() == 0
