"""Packing by powers of two: pieces of binary length, equal lengths in one bucket.

A document of n tokens becomes whole sequences and the binary digits of the rest, longest
first. Every piece is a sequence of its own, whose length is a power of two, so no
sequence crosses documents and none needs padding; a batch takes sequences of one bucket.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pulseloom.llm import common, words

SEQUENCE = 1024
END = 0


def lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Binary decomposition, longest first: 2500 gives 1024, 1024, 256, 128, 64, 4."""
    return decompose(np.array([n]), longest)[1].tolist()


def decompose(totals: np.ndarray, longest: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Of documents of so many tokens: each piece's document and length, in order of the text."""
    whole, rest = np.divmod(totals, longest)
    docs, sizes = [np.repeat(np.arange(len(totals)), whole)], [np.full(int(whole.sum()), longest, np.int64)]
    for b in range(longest.bit_length() - 2, -1, -1):
        has = np.flatnonzero(rest >> b & 1)
        docs.append(has)
        sizes.append(np.full(len(has), 1 << b, np.int64))
    doc, size = np.concatenate(docs), np.concatenate(sizes)
    order = np.argsort(doc, kind="stable")
    return doc[order], size[order]


def _pieces(part: int, count: dict, ids: list, found: list[bytes], longest: int) -> pa.RecordBatch:
    """The pieces of some documents as one Arrow batch over one buffer of their ids."""
    totals = np.array([len(x) // 4 for x in found], np.int64)
    doc, size = decompose(totals, longest)
    data = b"".join(found)
    ends = np.cumsum(size)
    nth = np.empty(len(size), np.int64)
    for length in np.unique(size).tolist():
        same = np.flatnonzero(size == length)
        nth[same] = count.get(length, 0) + np.arange(len(same))
        count[length] = count.get(length, 0) + len(same)
    edges = np.concatenate([[0], 4 * ends])
    view, cuts = memoryview(data), edges.tolist()
    crc = [zlib.crc32(view[a:b]) for a, b in zip(cuts, cuts[1:])]
    packed = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(edges.astype(np.int32)),
                                                            pa.py_buffer(data)])
    start = ends - size - (np.cumsum(totals) - totals)[doc]
    names = pa.array([None if pd.isna(i) else int(i) for i in ids], pa.int64()).take(pa.array(doc))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(size), part, np.int32)), pa.array(nth), names, pa.array(start), pa.array(totals[doc]),
         packed, pa.array(crc, pa.int64()), pa.array(size.astype(np.int32))],
        names=["part", "nth", "doc_id", "start", "doc_tokens", "ids", "ids_crc32", "length"])


def write(docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", longest: int = SEQUENCE,
          end: int = END) -> DataFrame:
    """Encode and cut all documents; pieces are stored in one folder per length.

    Columns: part, nth (number of the piece within part and length), doc_id, start,
    doc_tokens, ids (packed 32-bit), ids_crc32 and length.
    """

    def cut(arrived):
        common.alone("tokens")
        part, count, encoder = TaskContext.get().partitionId(), {}, words.Encoder(tokenizer)
        tail = np.array([end], "<u4").tobytes()
        frames = (batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get) for batch in arrived)
        for ids, texts in common.batches(frames, 4 << 20):
            yield _pieces(part, count, ids, [packed + tail for packed in encoder.encode(texts)], longest)

    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    pieces = rows.mapInArrow(cut, "part int, nth long, doc_id long, start long, doc_tokens long, ids binary, "
                                  "ids_crc32 long, length int")
    pieces.write.partitionBy("length").parquet(f"{folder}/pieces")
    return docs.sparkSession.read.schema(pieces.schema).parquet(f"{folder}/pieces")


def numbered(pieces: DataFrame) -> DataFrame:
    """Add ``sequence_id``: gapless over all, the longest bucket first.

    Pieces carry their number within part and length; a table with one row for each such
    pair says where its numbers begin.
    """
    before = Window.orderBy(F.desc("length"), "part").rowsBetween(Window.unboundedPreceding, -1)
    begin = pieces.groupBy("part", "length").agg(F.count("*").alias("n")).select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return pieces.join(begin, ["part", "length"]).withColumn(
        "sequence_id", F.col("begin") + F.col("nth")).drop("begin", "nth", "part")


def pack(docs: DataFrame) -> DataFrame:
    """Pieces with their ids and sequence numbers."""
    return numbered(write(docs, common.run_dir(docs.sparkSession, "packing")))


def report(docs: DataFrame) -> DataFrame:
    """Where every piece of every document lies.

    A null or empty text is the end id alone, one piece of length 1. Rows that repeat an id
    stand for themselves. Other columns are ignored; an empty table gives no rows.
    """
    return pack(docs).select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                             "sequence_id", F.lit(0).cast("long").alias("offset"))
