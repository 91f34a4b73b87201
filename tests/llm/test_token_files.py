import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 9000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 300, 50257, 1 << 32):
        ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        ids[:: max(1, n // 7)] = high - 1
        index, data = T.encode_blocks(ids)
        assert np.array_equal(T.decode_blocks(index, np.frombuffer(data, dtype=np.uint8))[:n], ids)


def test_outliers_are_patched():
    ids = np.full(1024, 5, dtype=np.uint32)
    ids[[3, 900]] = 50_000
    index, data = T.encode_blocks(ids)
    assert index["patched"][0] == 2 and index["width"][0] == 0 and len(data) == 12


TEXTS = [None, "", "Hello world", "  two  spaces\n\n", "x<|endoftext|>y", "é😀" * 50, "Hello world", "word " * 5000, "\x00\x1c \x85it's 123"]


def test_files_hold_the_library_ids(spark, tmp_path):
    docs = spark.createDataFrame([(9 - i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, start int")
    docs = docs.union(spark.createDataFrame([(None, "null id", 1), (3, "again", 1)], docs.schema))
    manifest = T.write_token_files(docs, PATH, f"file://{tmp_path}/a", file_tokens=700)
    assert len(manifest["files"]) > 1
    tok = Tokenizer.from_file(PATH)
    rows = [(None, "null id")] + sorted([(9 - i, t or "") for i, t in enumerate(TEXTS)] + [(3, "again")])
    want, start = [], 0
    for name, text in rows:
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in T.read_token_files(spark, manifest).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    file = T.TokenFile(f"{manifest['folder']}/{manifest['files'][-1]['name']}")
    whole = file.tokens(0, file.tokens_count)
    assert np.array_equal(file.tokens(5, file.tokens_count - 1), whole[5:-1])


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.read_token_files(spark, T.write_token_files(docs, PATH, f"file://{tmp_path}/b")).count() == 0


def test_encoder_falls_back():
    encoder = T.Encoder(open(PATH, encoding="utf-8").read())
    want = encoder.encode("some text, and more").tolist()
    encoder.encoding = None
    assert encoder.encode("some text, and more").tolist() == want
