"""Token counts without ids: pieces of each distinct pre-token, times its frequency."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pulseloom.llm import common, words


def _frequencies(batch: words.Batch) -> dict:
    """Per-document pre-token frequencies: for each document its words and how often each."""
    docs = np.repeat(np.arange(len(batch.lengths), dtype=np.int64), batch.lengths)
    width = max(len(batch.words), 1)
    pairs, times = np.unique(docs * width + batch.sequence, return_counts=True)
    return {"per_doc": np.bincount(pairs // width, minlength=len(batch.lengths)).astype(np.uint32),
            "word": (pairs % width).astype(np.uint32), "times": times.astype(np.uint32)}


def count(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json",
          specials: tuple[str, ...] = ("<|endoftext|>",)) -> DataFrame:
    """(doc_id, n_tokens) of every row, as the library's tokenizer counts whole texts.

    ``specials`` are the strings the tokenizer takes out of a text first. A null or empty
    text has 0 tokens; ids may be null or repeat, each row stands for itself; other columns
    are ignored; an empty table gives no rows.
    """
    folder = common.run_dir(docs.sparkSession, "counts")

    def pieces(new: list[str]) -> list[bytes]:
        found = words.load_json(tokenizer).encode_batch_fast(new, add_special_tokens=False)
        return [len(x.ids).to_bytes(4, "little") for x in found]

    def total(side: dict, answers: list[bytes]) -> pd.DataFrame:
        counts = np.frombuffer(b"".join(answers), "<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(side["doc"])), side["per_doc"])
        sums = np.bincount(doc, counts[side["word"]] * side["times"], minlength=len(side["doc"]))
        return pd.DataFrame({"doc_id": words.nullable(side), "n_bytes": side["bytes"],
                             "n_tokens": sums.astype(np.int64)})

    def keep(batch: words.Batch) -> dict:
        sizes = np.array([len(w.encode("utf-8", "surrogatepass")) for w in batch.words] or [0], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[batch.sequence])])
        edge = np.concatenate([[0], np.cumsum(batch.lengths)])
        return _frequencies(batch) | {"bytes": ends[edge[1:]] - ends[edge[:-1]]}

    blocks = words.distinct_words(docs, folder, keep, specials)
    return words.reassembled(words.answered(blocks, pieces), total, "doc_id long, n_bytes long, n_tokens long")


def report(docs: DataFrame, limit: int = 512) -> DataFrame:
    """``count`` and whether a document has more than ``limit`` tokens; a null or empty text has not."""
    return count(docs).withColumn("over_limit", F.col("n_tokens") > limit)
