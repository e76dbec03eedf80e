"""Base spans, pieces and shards of whole fixtures against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from pulseloom.llm import packing, secrets, sharding, words

KEY, HEX = "AKIA" + "Z9" * 8, "0a1b2c3d" * 4
TEXTS = [
    None, "", " ", "plain words only", "x" * 30_000, 'password="hunter2hunter" Api_Key: abcdefgh12 token=short7',
    f"é {KEY} {HEX} {HEX}ff SECRET = {HEX}", "AKIA1234", "passwd='12345678' apikey = 0123456789abcdef0123456789abcdef",
    f"naïve 東京 token\": \"{KEY}\" end", "a b c " * 700, "a b c " * 700, "secret=secret=abcdefgh token:token:12345678",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(5, "again"), (None, f"key {HEX}")]
KINDS = [("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)".replace(
    "(password|passwd|secret|token|api_?key)", "((?i:password|passwd|secret|token|api_?key))"), re.A), lambda m: len(m[2]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "b") for i, t in ROWS], "doc_id long, text string, start long, base string").repartition(3)


def _ordered(rows):
    return sorted(rows, key=repr)


def test_base_spans(docs):
    expected = []
    for i, t in ROWS:
        found = [(m.start(), n, name, m.end()) for n, (name, pattern, fits) in enumerate(KINDS)
                 for m in pattern.finditer(t or "") if fits(m)]
        told = ",".join(f"{name}:{start}:{end}" for start, _, name, end in sorted(found))
        count = [sum(f[2] == name for f in found) for name, _, _ in KINDS]
        expected.append((i, *count, hashlib.sha256(told.encode()).hexdigest()))
    got = secrets.report(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()
    assert _ordered(map(tuple, got)) == _ordered(expected)


def test_pieces(docs):
    tokenizer = words.load_json("byte_bpe_50k.json")
    expected = []
    for i, t in ROWS:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        while at < len(ids):
            length = min(1024, 1 << (len(ids) - at).bit_length() - 1)
            expected.append((i, at, length, zlib.crc32(ids[at:at + length].tobytes()), len(ids)))
            at += length
    got = packing.report(docs).collect()
    assert _ordered((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == _ordered(expected)
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}


def test_shards(docs):
    def jump(key, n):
        key, b, j = key % 2**64, -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
        return b

    got = sharding.place(docs, 24).collect()
    assert _ordered((r.doc_id, r.size, r.text_crc32, r.law) for r in got) == _ordered(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key") for i, t in ROWS)
    by_id: dict = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 24)
    assert all(len(places) == 1 for places in by_id.values())  # the id and the number of shards decide
    keys = [3, -7, 0, 2**62]
    assert sharding.jump(np.array(keys, np.int64), 25).tolist() == [jump(k, 25) for k in keys]
