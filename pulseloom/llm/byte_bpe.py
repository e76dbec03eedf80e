"""Byte-level BPE by a global shuffle of distinct words, and decoding.

Documents become sequences of word numbers (the positions) beside the distinct words of
their batch; each distinct word of the corpus is encoded once; its ids come back to every
batch and the sequence puts them in place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from pulseloom.llm import common, words


def encode(docs: DataFrame, ranks: str, schema: str, finish) -> DataFrame:
    """Encode every text; ``finish(doc_id, ids of each document)`` makes rows of a batch.

    A null or empty text has no ids. Ids of rows may be null or repeat; each row stands for
    itself; other columns are ignored; an empty table gives no rows.
    """
    folder = common.run_dir(docs.sparkSession, "bpe")

    def ask(new: list[str]) -> list[bytes]:
        encoding = words.load_ranks(ranks)
        return [np.array(encoding.encode_ordinary(w), "<u4").tobytes() for w in new]

    def place(side: dict, answers: list[bytes]) -> pd.DataFrame:
        sequence, ends = side["sequence"].tolist(), np.cumsum(side["lengths"]).tolist()
        found, begin = [], 0
        for end in ends:
            found.append(b"".join(map(answers.__getitem__, sequence[begin:end])))
            begin = end
        return finish(words.nullable(side), found)

    def keep(batch: words.Batch) -> dict:
        small = len(batch.words) < 1 << 16
        return {"lengths": batch.lengths, "sequence": batch.sequence.astype(np.uint16 if small else np.uint32)}

    blocks = words.distinct_words(docs, folder, keep)
    return words.reassembled(words.answered(blocks, ask), place, schema)


def token_bytes(ranks: str) -> list[bytes]:
    """The token-byte table; bounded by the vocabulary."""
    name = ("bytes", ranks)
    if name not in words.kept():
        encoding = words.load_ranks(ranks)
        words.kept()[name] = [encoding.decode_single_token_bytes(i) for i in range(encoding.n_vocab)]
    return words.kept()[name]


def encoded(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, ids) with ids as an array."""

    def finish(doc_id, found):
        return pd.DataFrame({"doc_id": doc_id, "ids": [np.frombuffer(x, "<u4").astype(np.int32) for x in found]})

    return encode(docs, ranks, "doc_id long, ids array<int>", finish)


def decoded(rows: DataFrame, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, data): the bytes of every row of ``encoded``; null ids give null."""

    def run(frames):
        for frame in frames:
            table = token_bytes(ranks)
            data = [None if x is None else b"".join(map(table.__getitem__, x.tolist())) for x in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "data": pd.Series(data, dtype=object)})

    return rows.select("doc_id", "ids").mapInPandas(run, "doc_id long, data binary")


def report(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Digests of the ids and of the bytes they decode to."""

    def finish(doc_id, found):
        table = token_bytes(ranks)
        shown = words.kept().setdefault(("shown", ranks), [str(i) for i in range(len(table))])
        rows = []
        for packed in found:
            ids = np.frombuffer(packed, "<u4").tolist()
            told = hashlib.sha256(" ".join(map(shown.__getitem__, ids)).encode()).hexdigest()
            back = hashlib.sha256(b"".join(map(table.__getitem__, ids))).hexdigest()
            rows.append((len(ids), told, back))
        out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        out.insert(0, "doc_id", doc_id)
        return out

    return encode(docs, ranks, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", finish)
