"""Removal of long repeated strings against a table of all windows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pulseloom.llm import common, suffixes

SCHEMA = "doc_id long, text string, batch long, kept string, m int, starts binary, n_bytes string"


def plain(rows, length):
    """Every window of every text in one table."""
    data = [(i, (t or "").encode()) for i, t in rows]
    held = {}
    for _, x in data:
        for p in range(len(x) - length + 1):
            held[x[p:p + length]] = held.get(x[p:p + length], 0) + 1
    out = []
    for i, x in data:
        gone = [False] * len(x)
        for p in range(len(x) - length + 1):
            if held[x[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def order(row):
    return [(x is None, x) for x in row]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", 2, None, "b") for i, t in rows], SCHEMA).repartition(3)


def results(df):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                   for r in df.collect()], key=order)


def rows_of():
    chosen = random.Random(5)
    line = lambda n: " ".join(chosen.choice(["alpha", "beta", "gamma", "dé", "東", "z"]) + str(chosen.randrange(99))
                              for _ in range(n))
    passage, other, long = line(90), line(70), line(3000)
    texts = [None, "", "short", passage, passage, "a" * 1500, "ab" * 700, "x" + passage + "y", other + passage[3:],
             passage[:399], passage[:400] + "\0" + passage[100:520], long, long[:5000] + "!" + long[5000:], line(200),
             *[line(20) + passage[40:470] + line(30) for _ in range(12)], other, "a" * 401]
    return list(enumerate(texts)) + [(3, other), (None, line(100)), (None, passage)]


def test_against_all_windows(spark):
    rows = rows_of()
    expected = sorted(plain(rows, 400), key=order)
    docs = frame(spark, rows)
    assert results(suffixes.deduplicated(docs)) == expected
    # every minimizer with several kinds of text by fingerprints
    assert results(suffixes.deduplicated(docs, hot_bytes=0)) == expected
    got = suffixes.report(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=order) == expected


def test_short_windows(spark):
    chosen = random.Random(9)
    rows = [(i, "".join(chosen.choice("ab") for _ in range(chosen.randrange(60)))) for i in range(60)]
    assert results(suffixes.deduplicated(frame(spark, rows), length=12, gram=4)) == sorted(plain(rows, 12), key=order)


def test_documents_of_the_table(spark):
    docs = common.documents(spark, "/root/testdata/sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, suffixes.report(docs).collect()), key=order) == sorted(plain(rows, 400), key=order)


def test_empty_table(spark):
    assert suffixes.report(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aab", max_size=40), min_size=1, max_size=5), st.integers(2, 8))
def test_suffix_arrays(texts, length):
    raw = [t.encode() for t in texts]
    held = [x[p:p + length] for x in raw for p in range(len(x) - length + 1)]
    expected = [[p for p in range(len(x) - length + 1) if held.count(x[p:p + length]) > 1] for x in raw]
    assert [x.tolist() for x in suffixes.repeated_windows(raw, length)] == expected


@pytest.mark.parametrize("text", ["mississippi", "aaaa", "abracadabra", "zyx", "banana"])
def test_order_of_one_text(text):
    data = np.frombuffer(text.encode() + b"\xff", np.uint8) + np.uint8(1)
    found = suffixes.suffix_order(data, np.ones(len(data), bool), 32).tolist()
    assert found[1:] == sorted(range(len(text)), key=lambda i: text[i:])


def test_tiles_change_nothing():
    chosen = np.random.RandomState(2)
    data = chosen.randint(97, 100, 5000).astype(np.uint8)
    edges = np.array([0, 1000, 1010, 5000])
    whole, tiled = (suffixes.pieces(data, edges, 50, 10, tile) for tile in (1 << 12, 97))
    at = lambda f: {(s + i, m) for s, n, m in zip(f.start, f.windows, f.m) for i in range(n)}
    assert {x for x, _ in at(whole)} == {x for x, _ in at(tiled)} == set(range(951)) | set(range(1010, 4951))
