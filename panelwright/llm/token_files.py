"""Token ids in files of fixed-width bits.

A file holds the documents of one range of ``doc_id``, in ascending order:

    magic | block 0 | block 1 | ... | footer | length of the footer (8 bytes) | magic

A block packs ``BLOCK_IDS`` ids (the last one fewer), each in the smallest number of bits that any id of the vocabulary
needs, lowest bit first. The footer is an ``npz`` of the document ids (with a flag for NULL), the number of ids of each
document, the byte offset of each block, and the number of bits. Any document can be read by itself: its ids are
consecutive, its blocks follow from the numbers of ids, and a block is unpacked by numpy at once.

Files go to the folder all executors share, under a name of their own first and then, whole, under their final name, so
that a task that is repeated replaces its file. NULL texts count as empty and hold only the end id; repeated rows are
documents of their own; NULL document ids come first. Extra columns are ignored. An empty table makes no files.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import text_or_empty
from panelwright.llm.encoding import default_path, encoder
from panelwright.session import cut_lineage, scratch_path

MAGIC = b"TOKBITS1"
BLOCK_IDS = 1 << 16
END_ID = 1


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    wide = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(wide.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), dtype=np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system that every executor reaches, and the path in it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Writer:
    """Writes documents one by one; holds one block of ids and the index."""

    def __init__(self, stream, bits: int):
        self.stream, self.bits = stream, bits
        self.rest, self.held = [], 0
        self.doc_ids: list[int] = []
        self.known: list[bool] = []
        self.lengths: list[int] = []
        self.offsets = [len(MAGIC)]
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.lengths.append(len(ids))
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, everything: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, dtype="<u4")
        whole = len(ids) if everything else len(ids) // BLOCK_IDS * BLOCK_IDS
        for at in range(0, whole, BLOCK_IDS):
            data = pack_bits(ids[at : min(at + BLOCK_IDS, whole)], self.bits)
            self.stream.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.rest, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        footer = io.BytesIO()
        np.savez(
            footer, doc_ids=np.array(self.doc_ids, dtype="<i8"), known=np.array(self.known, dtype=bool),
            lengths=np.array(self.lengths, dtype="<i8"), offsets=np.array(self.offsets, dtype="<i8"), bits=np.array([self.bits]),
        )
        self.stream.write(footer.getvalue())
        self.stream.write(struct.pack("<Q", len(footer.getvalue())) + MAGIC)


class Reader:
    """Random access to the documents of a file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = 8 + len(MAGIC)
        file.seek(size - tail)
        end = file.read(tail)
        if end[8:] != MAGIC:
            raise ValueError("not a token file")
        length = struct.unpack("<Q", end[:8])[0]
        file.seek(size - tail - length)
        index = np.load(io.BytesIO(file.read(length)))
        self.doc_ids, self.known, self.lengths = index["doc_ids"], index["known"], index["lengths"]
        self.offsets, self.bits = index["offsets"], int(index["bits"][0])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self._at, self._ids = -1, np.zeros(0, dtype="<u4")

    def block(self, i: int) -> np.ndarray:
        if i != self._at:
            n = min(BLOCK_IDS, int(self.starts[-1]) - i * BLOCK_IDS)
            self.file.seek(int(self.offsets[i]))
            self._at, self._ids = i, unpack_bits(self.file.read(int(self.offsets[i + 1] - self.offsets[i])), n, self.bits)
        return self._ids

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the file."""
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        parts = [self.block(k)[max(0, a - k * BLOCK_IDS) : b - k * BLOCK_IDS] for k in range(a // BLOCK_IDS, (b - 1) // BLOCK_IDS + 1)] if b > a else []
        return np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(len(self.lengths)):
            yield (int(self.doc_ids[i]) if self.known[i] else None), self.document(i)


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes the files; returns one row per file (part, path, n_docs, n_tokens, start), a written table."""
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    bits = max(1, (size - 1).bit_length())
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches):
        encode = encoder(tokenizer_path, True).encode
        part = TaskContext.get().partitionId()
        writer = None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    store, root = open_store(folder)
                    store.create_dir(root, recursive=True)
                    own, final = f"{root}/{part:06d}.{uuid.uuid4().hex}", f"{root}/{part:06d}.tok"
                    stream = store.open_output_stream(own)
                    writer = Writer(stream, bits)
                writer.add(doc_id, np.frombuffer(encode(text.as_py()) + end, dtype="<u4"))
        if writer is not None:
            writer.close()
            stream.close()
            store.move(own, final)
            row = {"part": [part], "path": [f"{folder}/{part:06d}.tok"], "n_docs": [len(writer.lengths)], "n_tokens": [sum(writer.lengths)]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    ordered = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = cut_lineage(ordered.mapInArrow(write, "part int, path string, n_docs long, n_tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-index")


def read_tokens(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files."""

    def read(batches):
        for rows in batches:
            for path, first in zip(rows["path"], rows["start"], strict=True):
                store, where = open_store(path)
                with store.open_input_file(where) as file:
                    at, out, held = first, [], 0
                    for doc_id, ids in Reader(file).documents():
                        out.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), *[ids.tolist()] * with_ids))
                        at, held = at + len(ids), held + len(ids) * with_ids
                        if len(out) >= 10_000 or held > 1_000_000:
                            yield frame(out)
                            out, held = [], 0
                    if out:
                        yield frame(out)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def frame(rows):
        return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    # A number, since Spark would put a small table of paths into one task; there is a row per file.
    each = files.select("path", "start").repartition(max(1, files.count()), "path")
    return each.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_tokens(write_tokens(docs, default_path("word_bpe_49k.json"), scratch_path(spark, "tokens")))
