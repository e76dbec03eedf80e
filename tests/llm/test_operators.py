"""Each operator against brute force, and on nulls, empty texts, repeats, empty tables and extra columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseloom.llm import (byte_bpe, counting, jaccard, neighbours, packing, quality, secrets, sharding, token_files,
                           warc, words)

SCHEMA = "doc_id long, text string, lang string, n_chars long, n_tokens string, shard string, spans string"
KEY = "AKIA" + "Q7" * 8
BARE = "aB3" * 13 + "Z"
TEXTS = [
    "the cat sat on the mat and looked at the dog for a while, then slept.", None, "", " ", "one two",
    "the cat sat on the mat and looked at the dog for a while, then slept.", "x" * 50_000,
    'password = "hunter2hunter2" and token: short and ' + KEY + " at https://vault.example/x with " + BARE,
    BARE + " alone means nothing, so it is left where it is in this text.",
    "naïve  café\n\nit's 12 tabs\there 東京 <|endoftext|> end ", "a" + "\n" * 3 + "b " * 300,
    "0123456789abcdef" * 3 + " é " + "0123456789abcdef" * 2, "\x1c odd \x85 space here and\xa0there",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again with id three"), (None, "no id"), (0, TEXTS[0])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, 7, "9", "s", "x") for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is None, str(type(x)), x) for x in r])


def same(got, expected):
    order = lambda r: [(x is None, str(type(x)), x) for x in r]
    assert rows(got) == sorted(expected, key=order)


@pytest.mark.parametrize("report", [
    secrets.report, quality.judge, token_files.report, counting.report, jaccard.report, packing.report,
    lambda d: sharding.place(d, 24), byte_bpe.report, secrets.mask, quality.keep, jaccard.keep_one])
def test_empty_tables(report, empty):
    assert report(empty).count() == 0


def test_tokenizers(docs):
    texts = [(i, t or "") for i, t in ROWS]
    ids = [words.load_json("byte_bpe_50k.json").encode(t, add_special_tokens=False).ids for _, t in texts]
    same(counting.report(docs), [(i, len(t.encode()), len(x), len(x) > 512) for (i, t), x in zip(texts, ids)])
    ranks = [words.load_ranks("byte_bpe_50k.tiktoken").encode_ordinary(t) for _, t in texts]
    digest = lambda x: hashlib.sha256(x).hexdigest()
    same(byte_bpe.report(docs), [(i, len(x), digest(" ".join(map(str, x)).encode()), digest(t.encode()))
                                 for (i, t), x in zip(texts, ranks)])
    back = byte_bpe.decoded(byte_bpe.encoded(docs))
    same(back.select("doc_id", F.col("data").cast("string")), texts)

    found = token_files.report(docs).collect()
    clip = [words.load_json("word_bpe_49k.json").encode(t, add_special_tokens=False).ids + [2] for _, t in texts]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (i or 0, len(x), crc(x)) for (i, _), x in zip(texts, clip))
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    assert [r.doc_id for r in ordered][1:] == sorted(i for i, _ in ROWS if i is not None)

    pieces = packing.pack(docs).collect()
    assert sorted(r.sequence_id for r in pieces) == list(range(len(pieces)))
    assert all(r.length & (r.length - 1) == 0 and len(r.ids) == 4 * r.length and r.length <= 1024 for r in pieces)
    by_length = sorted(pieces, key=lambda r: r.sequence_id)
    assert [r.length for r in by_length] == sorted((r.length for r in pieces), reverse=True)
    whole = {7: ids[7] + [0], 6: ids[6] + [0]}
    for i, expected in whole.items():
        parts = sorted((r.start, r.ids) for r in pieces if r.doc_id == i)
        assert b"".join(x for _, x in parts) == np.array(expected, "<u4").tobytes()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_on_every_kind_of_character(name):
    """Chunks are cut only where the library cuts, whatever stands beside them."""
    points = [*range(1, 0x3000), *range(0xFE00, 0x10000, 7), 0x1F600, 0x1D7D8]
    texts = [f"ab{chr(c)} {chr(c)}c\n{chr(c)}1 it's x{chr(c)}. " + chr(c) for c in points]
    expected = words.load_json(name).encode_batch(texts, add_special_tokens=False)
    got = words.Encoder(name).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [x.ids for x in expected]


def test_planes():
    ids = np.random.default_rng(1).integers(0, 2**31, 999).astype("<u4")
    for bits in (False, True):
        assert (token_files.from_planes(token_files.to_planes(ids, bits), 999) == ids).all()


def test_quality(docs):
    got = {(r.doc_id, r.n_words): r for r in quality.judge(docs).collect()}
    assert got[1, 0].base_failed and not got[1, 0].kept
    assert got[0, 16].kept and not got[0, 16].base_failed
    repeated = got[10, 301]
    assert repeated.n_repeat_words == 300 and repeated.base_failed
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in quality.judge(docs).collect())


def test_secrets(docs):
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex): r.spans for r in secrets.report(docs).collect()}
    t = TEXTS[7]
    spans = [("assign", 0, t.index('" and token')), ("access", t.index(KEY), t.index(KEY) + len(KEY)),
             ("endpoint", t.index("https"), t.index(" with ")), ("secret", t.index(BARE), len(t))]
    assert got[7, 1, 1, 0] == ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    assert got[8, 0, 0, 0] == ""  # a bare secret alone is no finding
    assert got[11, 0, 0, 2] == "hex:0:48,hex:51:83"
    masked = {r.doc_id: r for r in secrets.mask(docs).filter("doc_id in (1, 7, 8)").collect()}
    assert KEY not in masked[7].text and BARE not in masked[7].text and masked[7].n_chars == len(masked[7].text)
    assert masked[8].text == TEXTS[8] and masked[1].text is None


def test_sharding(docs):
    def jump(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
        return b

    keys = np.array([0, 1, -1, 2**62, -2**63, 12345], np.int64)
    assert sharding.jump(keys, 24).tolist() == [jump(int(k) % 2**64, 24) for k in keys]
    placed = sharding.place(docs, 24).collect()
    assert len(placed) == len(ROWS)
    assert all(r.grown_shard in (r.shard, 24) for r in placed)
    for shard in {r.shard for r in placed}:
        own = sorted(r.slot for r in placed if r.shard == shard)
        assert own == list(range(len(own)))


def _components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    comp = list(range(len(sets)))
    links = [(i, j) for i, a in enumerate(sets) for j in range(i)
             if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j])]
    for _ in sets:
        for i, j in links:
            comp[i] = comp[j] = min(comp[i], comp[j])
    return [(i, len(s), comp[i]) for i, s in enumerate(sets)]


@pytest.mark.parametrize("light, rounds, frequent", [(12, 2, 32), (1, 0, 3)])
def test_jaccard(spark, monkeypatch, light, rounds, frequent):
    for name, value in (("LIGHT", light), ("ROUNDS", rounds), ("FREQUENT", frequent), ("BLOCK", 8)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", "one", "ONE", "a b c d", "a b c d e"]
    base = [rng.choices(vocabulary, k=60) for _ in range(3)] + [rng.choices(vocabulary, k=300)]
    for _ in range(70):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append(" ".join(own[:rng.choice([len(own), len(own) - 5])]))
    texts += [" ".join(rng.choices(vocabulary, k=30)) for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = _components(texts)
    found = jaccard.grouped(docs)
    same(found.select("doc_id", "n_shingles", "component_id"), expected)
    same(found.filter("first").select("doc_id"), [(i,) for i, _, c in expected if i == c])


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(700, 8)).astype(np.float32).astype(float)
    points[100:400] = points[0]  # copies tie
    data = [(i, p.tolist(), 0.0) for i, p in enumerate(points)]
    odd = [(900, None, 0.0), (901, [0.0] * 8, 0.0), (902, [float("nan")] + [1.0] * 7, 0.0), (903, [None] + [1.0] * 7, 0.0),
           (904, [float("inf")] * 8, 0.0), (None, [1.0] * 8, 0.0), (905, [], 0.0), (20, points[20].tolist(), 1.0)]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>, score double")
    got = neighbours.report(df, factor=1.0).collect()
    expected = []
    for q in range(0, 700, 20):
        scores = [(-sum(a * b for a, b in zip(points[q].tolist(), p.tolist())), i) for i, p in enumerate(points) if i != q]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:20])]
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(x[:3] for x in expected)
    assert {(r.query_id, r.rank): r.score for r in got} == pytest.approx({x[:2]: x[3] for x in expected}, rel=1e-12)
    assert neighbours.report(df.limit(0)).count() == 0


def test_warc(spark):
    big = "<p>" + "é" * 600
    data = [(1, "http://a/1", big), (5, None, big), (2, "http://a/\n2", big), (3, "u", None), (4, "u", ""), (6, "u", "small"),
            (7, "u", "small"), (None, "u", big), (5, "again", big)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in data], "page_id long, url string, html string, digest string, path string")
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    expected = [(i, len((t or "").encode()), sha(t), "revisit" if t == big and i != 5 else "response",
                 5 if t == big and i != 5 else None) for i, _, t in data]
    same(warc.report(pages), expected)
    assert warc.report(pages.limit(0)).count() == 0
    folder = warc.common.run_dir(spark, "warc")
    captures = warc.assemble(warc.read(warc.write(pages, folder))).collect()
    assert all(c.request_records == 1 and c.metadata_records == 1 for c in captures)
    assert bytes(next(c.response.payload for c in captures if c.metadata.page_id == 6)) == b"small"
