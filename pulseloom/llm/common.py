"""Shared folder, staging and small file helpers of the operators."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may lack one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(folder)
    return folder


def cleanup() -> None:
    """Delete what this process staged; results that still read it become unreadable."""
    while _MADE:
        discard(_MADE.pop())


def staged(df: DataFrame, folder: str) -> DataFrame:
    """Write and read again: cuts lineage, and later scans can prune columns.

    Rows that a task makes up (random names, positions) are fixed from here on, so a lost
    executor cannot change them half-way through a later shuffle.
    """
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(folder: str) -> None:
    """Delete a staged folder that nothing reads any more."""
    fs, path = _open(folder)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def _open(uri: str):
    """File system and path of a plain path or a file, hdfs, gs, abfs(s), s3 or s3a address.

    Spark's names of the object store are mapped to the one pyarrow knows.
    """
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", uri)))


def write_file(uri: str, data: bytes) -> None:
    """Write a whole file at once, from a task; names are unique per attempt."""
    fs, path = _open(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)


def read_file(uri: str) -> bytes:
    fs, path = _open(uri)
    with fs.open_input_stream(path, compression=None) as src:
        return src.read()


def open_file(uri: str):
    """A seekable file for reading single parts."""
    fs, path = _open(uri)
    return fs.open_input_file(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, a null text as the empty one, whatever else the frame carries."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept() -> dict:
    """What a worker keeps from task to task."""
    return sys.__dict__.setdefault("_pulseloom_kept", {})


def alone(user: str) -> None:
    """Before a task of ``user``: forget what operators of other kinds have kept in this worker.

    Workers outlive jobs, so their tables would take the memory of the operators that follow.
    """
    held = kept()
    if held.get("user") == user:
        return
    full = len(held) > 1
    held.clear()
    held["user"] = user
    if full:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32(text: Column) -> Column:
    return F.crc32(F.encode(text, "UTF-8"))


def batches(frames, limit: int):
    """Regroup pandas frames of documents so that each holds about ``limit`` characters."""
    ids, words, size = [], [], 0
    for frame in frames:
        for doc_id, text in zip(frame["doc_id"].to_numpy(dtype=object), frame["text"]):
            ids.append(doc_id)
            words.append(text)
            size += len(text) + 64
            if size >= limit:
                yield ids, words
                ids, words, size = [], [], 0
    if ids:
        yield ids, words
