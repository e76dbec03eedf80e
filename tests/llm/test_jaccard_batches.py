"""Batches of few words in all."""

import numpy as np
import pytest
import xxhash

from pulseloom.llm import jaccard


@pytest.mark.parametrize("lengths", [[], [0], [1], [2], [3], [4], [5], [6], [1, 2], [2, 1], [1, 1, 1], [0, 3, 0], [1, 3],
                                     [3, 3], [5, 1]])
def test_shingles_of_small_batches(lengths):
    """A document has its shingles whatever else its batch holds."""
    hashes = np.array([xxhash.xxh64_intdigest(str(i)) for i in range(sum(lengths))], np.uint64)
    doc, value = jaccard.shingles(np.arange(sum(lengths)), np.array(lengths, np.int64), hashes)
    assert np.bincount(doc, minlength=len(lengths)).tolist() == [
        min(n, 1) if n < jaccard.SIZE else n - jaccard.SIZE + 1 for n in lengths]
    # the same beside a long document
    beside = np.r_[hashes, np.arange(1, 31, dtype=np.uint64)]
    doc_2, value_2 = jaccard.shingles(np.arange(len(beside)), np.array([*lengths, 30], np.int64), beside)
    assert value.tolist() == value_2[doc_2 < len(lengths)].tolist()


def test_three_words_alone(spark):
    docs = spark.createDataFrame([(1, "just three words")], "doc_id long, text string")
    assert [tuple(r) for r in jaccard.report(docs).collect()] == [(1, 1, 1)]
    copies = spark.createDataFrame([(i, "just three words") for i in range(6)] + [(9, "a b"), (8, "c")],
                                   "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in jaccard.report(copies).collect()) == [
        *((i, 1, 0) for i in range(6)), (8, 1, 8), (9, 1, 9)]
