"""Token ids in binary files of shuffled planes.

A file holds blocks of ids, each transposed into byte planes (or bit planes) that are
compressed one by one, then an index of its chunks and documents, then the place of that
index. A reader fetches single planes of single blocks by the index.
"""

from __future__ import annotations

import io
import uuid
import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pulseloom.llm import common, words

MAGIC = b"PLANES1\n"
BLOCK = 1 << 16
FILE_BYTES = 64 << 20


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte planes of 32-bit ids, lowest first, or bit planes of each byte plane."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return [p.tobytes() for p in planes]
    return [np.packbits((p >> b) & 1).tobytes() for p in planes for b in range(8)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        rows = [np.frombuffer(p, np.uint8) for p in planes]
    else:
        unpacked = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes]
        rows = [sum(unpacked[8 * k + b] << b for b in range(8)).astype(np.uint8) for k in range(4)]
    return np.ascontiguousarray(np.array(rows, np.uint8).reshape(4, n).T).view("<u4").ravel()


class Writer:
    """One file in memory, bounded by ``FILE_BYTES`` and the longest document."""

    def __init__(self, bits: bool = False, block: int = BLOCK):
        self.out, self.bits, self.block = io.BytesIO(), bits, block
        self.out.write(MAGIC)
        self.waiting, self.n_waiting, self.index, self.docs, self.n_ids = [], 0, [], [], 0
        self.zip = zstandard.ZstdCompressor(3)

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // self.block * self.block
        for at in range(0, whole, self.block):
            part = ids[at:min(at + self.block, whole)]
            lengths = [self.out.write(self.zip.compress(p)) for p in to_planes(part, self.bits)]
            self.index.append([len(part), *lengths])
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def finish(self) -> bytes:
        self._flush(True)
        lengths = np.array([n for _, n in self.docs], np.int64)
        index = words.pack(chunks=np.array(self.index, np.int64).reshape(len(self.index), -1), lengths=lengths,
                           **words.doc_ids([d for d, _ in self.docs]))
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        return self.out.getvalue()


def read_index(source) -> dict:
    """Chunk and document index of an open file."""
    size = source.size()
    tail = source.read_at(16, size - 16)
    if tail[8:] != MAGIC:
        raise ValueError("not a file of token planes")
    length = int.from_bytes(tail[:8], "little")
    return words.unpack(source.read_at(length, size - 16 - length))


def read_chunks(source, index: dict):
    """Ids of one block after the other."""
    at, unzip = len(MAGIC), zstandard.ZstdDecompressor()
    for n, *lengths in index["chunks"].tolist():
        planes = []
        for length in lengths:
            planes.append(unzip.decompress(source.read_at(length, at)))
            at += length
        yield from_planes(planes, n)


def documents(source):
    """(number of the document, ids) in order, holding one block and one document."""
    index = read_index(source)
    blocks, have = read_chunks(source, index), np.zeros(0, np.uint32)
    for i, n in enumerate(index["lengths"].tolist()):
        parts, got = [have], len(have)
        while got < n:
            parts.append(next(blocks))
            got += len(parts[-1])
        ids = np.concatenate(parts) if len(parts) > 1 else have
        have = ids[n:]
        yield i, index, ids[:n]


def write(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end: int | None = 2,
          bits: bool = False) -> DataFrame:
    """Encode the texts and write files in ascending id order; returns the staged manifest.

    Rows are dealt out by ranges of the id (null first), ties by text, so ranges follow one
    another and a repeated id is split too. The manifest has (part, file, path, n_ids,
    start), where start counts the ids of all files before.
    """
    n = common.partitions(docs.sparkSession)
    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).withColumns(
        {"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("_tie"), F.asc("_row")]

    def put(frames):
        common.alone("tokens")
        part, number = TaskContext.get().partitionId(), 0
        writer, encoder = Writer(bits), words.Encoder(tokenizer)
        tail = b"" if end is None else np.array([end], "<u4").tobytes()

        def file():
            path = f"{folder}/files/{part:06d}-{number:06d}-{uuid.uuid4().hex}.planes"
            common.write_file(path, writer.finish())
            return pd.DataFrame({"part": [part], "file": [number], "path": [path], "n_ids": [writer.n_ids]})

        for ids, texts in common.batches(frames, 4 << 20):
            for doc_id, packed in zip(ids, encoder.encode(texts)):
                writer.add(doc_id, np.frombuffer(packed + tail, "<u4"))
                if writer.out.tell() >= FILE_BYTES:
                    yield file()
                    writer, number = Writer(bits), number + 1
        if writer.docs:
            yield file()

    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    files = common.staged(dealt.mapInPandas(put, "part int, file int, path string, n_ids long"), f"{folder}/manifest")
    # one row per file: what comes before each
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document of the files."""
    return _read(manifest, "doc_id long, start long, ids array<int>", lambda ids: {"ids": ids.astype(np.int32)})


def _read(manifest: DataFrame, schema: str, finish) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def load(frames):
        for frame in frames:
            for path, start in zip(frame["path"], frame["start"]):
                rows, size = [], 0
                with common.open_file(path) as source:
                    for i, index, ids in documents(source):
                        doc_id = None if index["null"][i] else int(index["doc"][i])
                        rows.append({"doc_id": doc_id, "start": start, **finish(ids)})
                        start += len(ids)
                        size += len(ids)
                        if size > 1 << 20 or len(rows) >= 10_000:
                            yield _frame(rows, names)
                            rows, size = [], 0
                if rows:
                    yield _frame(rows, names)

    spread = common.partitions(manifest.sparkSession)
    return manifest.select("path", "start").repartition(spread).mapInPandas(load, schema)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def report(docs: DataFrame) -> DataFrame:
    """Write the files, read them back and tell what they hold of every document.

    A null or empty text holds the end id alone; repeated rows come one after the other; an
    empty table gives no files and no rows; other columns are ignored.
    """
    manifest = write(docs, common.run_dir(docs.sparkSession, "tokens"))
    return _read(manifest, "doc_id long, start long, n_tokens long, ids_crc32 long",
                 lambda ids: {"n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
