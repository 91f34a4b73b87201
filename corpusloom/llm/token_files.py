"""Token files: ids in patched frame-of-reference blocks, written in id order and read back by block.

A file holds whole documents in ascending id order:

  magic "PFORTOK1", then eight little-endian unsigned 64-bit numbers: documents, tokens, block size, and the places of the
  sections below and of the end; document section: ids (int64), a null flag each (uint8), token counts (uint32);
  index section: for each block its place (uint64), minimum (uint32), exceptions (uint16) and width (uint8);
  data section: for each block the low `width` bits of (value - minimum), packed from the highest bit on, then the
  exceptions' positions (uint16) and their whole differences (uint32).

The width is that of the block's 90th percentile; larger differences are exceptions. A folder's manifest.json lists the
files in order with the number of ids before each. A task starts another file after FILE_TOKENS tokens, so its memory is
bounded by that and its longest document. Files are written under a temporary name and renamed; a task that runs again
writes the same names and bytes.

Ids come from the rank merges of the same vocabulary in the tiktoken library, four to five times as fast as the tokenizers
library and with the same ids (tests compare them); texts that it refuses go to the tokenizers library.

Defined results: a null text counts as empty (the end id alone); a null id comes first; repeated rows are written one by
one in a defined order (id, then text); other columns take no part; an empty table writes no file.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, kept
from .token_counts import byte_letters

MAGIC = b"PFORTOK1"
HEAD = struct.Struct("<8s8Q")
BLOCK = 1024
PERCENTILE = 90
END_ID = 2
FILE_TOKENS = 1 << 22
#: Blocks packed or unpacked at once.
SLICE = 64
INDEX = np.dtype([("place", "<u8"), ("least", "<u4"), ("patched", "<u2"), ("width", "u1")])


# --- blocks ------------------------------------------------------------------------------------------------------------


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(np.ascontiguousarray(values).astype(">u4").view(np.uint8).reshape(*values.shape, 4), axis=2)
    return np.packbits(bits[:, :, 32 - width :].reshape(len(values), -1), axis=1)


def _unpacked(data: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros((len(data), BLOCK, 32), dtype=np.uint8)
    bits[:, :, 32 - width :] = np.unpackbits(data, axis=1).reshape(len(data), BLOCK, width)
    return np.packbits(bits, axis=2).view(">u4").reshape(len(data), BLOCK).astype(np.uint32)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(index with places from 0, data) of an array of unsigned 32-bit ids; the last block is filled up with its last id."""
    count = -(-len(ids) // BLOCK)
    index = np.zeros(count, dtype=INDEX)
    if not count:
        return index, b""
    values = np.full(count * BLOCK, ids[-1], dtype=np.uint32)
    values[: len(ids)] = ids
    values = values.reshape(count, BLOCK)
    least = values.min(axis=1)
    values = values - least[:, None]
    kth = BLOCK * PERCENTILE // 100
    common = np.partition(values, kth, axis=1)[:, kth]
    width = np.where(common > 0, np.floor(np.log2(np.maximum(common, 1))).astype(np.uint8) + 1, 0).astype(np.uint8)
    over = (values >> width[:, None].astype(np.uint32)) > 0
    over &= width[:, None] < 32
    index["least"], index["width"], index["patched"] = least, width, over.sum(axis=1)
    low: list = [b""] * count
    for w in np.unique(width):
        if w:
            which = np.flatnonzero(width == w)
            for at in range(0, len(which), SLICE):
                some = which[at : at + SLICE]
                for i, row in zip(some.tolist(), _packed(values[some], int(w)), strict=True):
                    low[i] = row.tobytes()
    rows, places = np.nonzero(over)
    patches = values[rows, places].astype("<u4")
    places = places.astype("<u2")
    ends = np.concatenate([[0], np.cumsum(index["patched"], dtype=np.int64)])
    parts, place = [], 0
    for i in range(count):
        s, e = ends[i], ends[i + 1]
        part = low[i] + places[s:e].tobytes() + patches[s:e].tobytes()
        index["place"][i] = place
        place += len(part)
        parts.append(part)
    return index, b"".join(parts)


def decode_blocks(index: np.ndarray, data: np.ndarray) -> np.ndarray:
    """All ids of some blocks; data: bytes that the places in index refer to."""
    out = np.empty((len(index), BLOCK), dtype=np.uint32)
    for w in np.unique(index["width"]):
        which = np.flatnonzero(index["width"] == w)
        size = BLOCK * int(w) // 8
        for at in range(0, len(which), SLICE):
            some = which[at : at + SLICE]
            if w:
                places = index["place"][some].astype(np.int64)[:, None] + np.arange(size)
                out[some] = _unpacked(data[places], int(w))
            else:
                out[some] = 0
    for i in np.flatnonzero(index["patched"]).tolist():
        n = int(index["patched"][i])
        at = int(index["place"][i]) + BLOCK * int(index["width"][i]) // 8
        where = data[at : at + 2 * n].view("<u2")
        out[i, where] = data[at + 2 * n : at + 6 * n].view("<u4")
    return (out + index["least"][:, None]).ravel()


# --- files -------------------------------------------------------------------------------------------------------------


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def encode_file(ids: list, counts: list[int], tokens: np.ndarray) -> bytes:
    index, data = encode_blocks(tokens)
    nulls = np.array([x is None for x in ids], dtype=np.uint8)
    names = np.array([0 if x is None else x for x in ids], dtype="<i8")
    documents = names.tobytes() + nulls.tobytes() + np.array(counts, dtype="<u4").tobytes()
    at_index = HEAD.size + len(documents)
    at_data = at_index + index.nbytes
    head = HEAD.pack(MAGIC, len(ids), len(tokens), BLOCK, HEAD.size, at_index, at_data, at_data + len(data), 0)
    return b"".join([head, documents, index.tobytes(), data])


class TokenFile:
    """A reader of one file; tokens(start, stop) touches only the blocks that hold them."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        self.file = system.open_input_file(path)
        magic, n, self.tokens_count, block, at_docs, at_index, self.at_data, self.end, _ = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        if magic != MAGIC or block != BLOCK:
            raise ValueError(f"{uri} is no token file")
        data = np.frombuffer(self.file.read_at(at_index - at_docs, at_docs), dtype=np.uint8)
        nulls = data[8 * n : 9 * n]
        self.ids = [None if null else name for name, null in zip(data[: 8 * n].view("<i8").tolist(), nulls.tolist(), strict=True)]
        self.counts = np.frombuffer(data[9 * n :].tobytes(), dtype="<u4").astype(np.int64)
        self.index = np.frombuffer(self.file.read_at(self.at_data - at_index, at_index), dtype=INDEX)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        first, last = start // BLOCK, -(-stop // BLOCK)
        some = self.index[first:last].copy()
        if not len(some):
            return np.empty(0, dtype=np.uint32)
        base = int(some["place"][0])
        end = int(self.index["place"][last]) if last < len(self.index) else self.end - self.at_data
        some["place"] -= np.uint64(base)
        data = np.frombuffer(self.file.read_at(end - base, self.at_data + base), dtype=np.uint8)
        return decode_blocks(some, data)[start - first * BLOCK : stop - first * BLOCK]

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[object, int, np.ndarray]]:
        """(id, tokens before it in the file, ids) of every document."""
        starts = np.concatenate([[0], np.cumsum(self.counts)])
        held, held_at = np.empty(0, dtype=np.uint32), 0
        for i, name in enumerate(self.ids):
            s, e = int(starts[i]), int(starts[i + 1])
            if e > held_at + len(held):
                held, held_at = self.tokens(s, min(max(e, s + at_once), self.tokens_count)), s
            yield name, s, held[s - held_at : e - held_at]

    def close(self) -> None:
        self.file.close()


class Encoder:
    """text -> array of ids, with the end id."""

    def __init__(self, source: str, end_id: int = END_ID):
        import tiktoken

        spec = json.loads(source)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in specials}
        import public_tokenizers

        self.source, self.end, self.library = source, np.array([end_id], dtype=np.uint32), None
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=specials)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return self.end
        try:
            ids = self.encoding.encode_to_numpy(text, allowed_special="all")
        except BaseException as error:  # its engine's panics are no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit)):
                raise
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.source)
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate([ids, self.end])


def write_token_files(
    docs: DataFrame, vocabulary: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
) -> dict:
    """Write the files and the manifest, and return the manifest; folder: a URI that all executors reach."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    if "://" not in folder:
        folder = f"file://{folder}" if folder.startswith("/") else folder.replace("file:", "file://", 1)
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    source, key = spark.sparkContext.broadcast(text), (hashlib.sha256(text.encode()).hexdigest(), end_id)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode = kept("token encoder", key, lambda: Encoder(source.value, end_id)).encode
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        context = TaskContext.get()
        part, number = context.partitionId(), 0
        names: list = []
        arrays: list[np.ndarray] = []
        held = 0

        def write() -> pd.DataFrame:
            nonlocal number, held
            tokens = np.concatenate(arrays)
            data = encode_file(names, [len(a) for a in arrays], tokens)
            name = f"part-{part:06d}-{number:04d}.pfor"
            temporary = f"{base}/.{name}.{context.taskAttemptId()}"
            with system.open_output_stream(temporary) as out:
                out.write(data)
            system.move(temporary, f"{base}/{name}")
            row = pd.DataFrame([[part, number, name, len(names), len(tokens), len(data)]], columns=COLUMNS)
            names.clear(), arrays.clear()
            number, held = number + 1, 0
            return row

        for batch in batches:
            for name, text in zip(batch["id"].astype(object).tolist(), batch["text"].tolist(), strict=True):
                names.append(None if name is None or name != name else int(name))
                arrays.append(encode(text))
                held += len(arrays[-1])
                if held >= file_tokens:
                    yield write()
        if names:
            yield write()

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    files = rows.mapInPandas(run, "part int, number int, name string, documents bigint, tokens bigint, bytes bigint").collect()
    before, listed = 0, []
    for r in sorted(files):
        listed.append({"name": r["name"], "start": before, "documents": r["documents"], "tokens": r["tokens"], "bytes": r["bytes"]})
        before += r["tokens"]
    manifest = {"folder": folder, "end_id": end_id, "tokens": before, "files": listed}
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


COLUMNS = ["part", "number", "name", "documents", "tokens", "bytes"]


def read_token_files(spark, manifest: dict) -> DataFrame:
    """id, start (ids of all documents before), n_tokens and ids_crc32 (of little-endian ids), from the files alone."""
    files = [(f"{manifest['folder']}/{f['name']}", f["start"]) for f in manifest["files"]]
    rows = spark.createDataFrame(files, "uri string, start bigint").repartition(max(1, len(files)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, start in zip(batch["uri"], batch["start"].tolist(), strict=True):
                yield from _document_rows(uri, start)

    return rows.mapInPandas(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _document_rows(uri: str, start: int) -> Iterable[pd.DataFrame]:
    file, rows = TokenFile(uri), []
    try:
        for name, before, ids in file.documents():
            rows.append((name, start + before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            if len(rows) >= 10_000:
                yield _frame(rows)
                rows = []
        if rows:
            yield _frame(rows)
    finally:
        file.close()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return out.astype({"doc_id": "Int64"})
