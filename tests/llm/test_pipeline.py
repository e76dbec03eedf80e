"""The pipeline against a plain version of every stage, and with columns that clash."""

import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulseloom.llm import common, jaccard, quality, secrets, words

SMALL = "/root/testdata/sf0.001"
KEYS = ("AKIA" + "Q7" * 8, "0123456789abcdef" * 2)
MARKS = re.compile(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small documents, some with planted keys, some near copies, without assignments or weak parts."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter(
        ~F.col("text").rlike("(?i)password|passwd|secret|token|api_?key|ASIA|AROA|AIDA|https?://|[A-Za-z0-9/+_-]{32}"))
    text = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(f" the key {KEYS[0]} is here"))).when(
        F.col("doc_id") % 11 == 0, F.concat(F.lit(f"it has {KEYS[1]} and "), "text")).otherwise(F.col("text"))
    near = docs.filter("doc_id % 9 = 0").select((F.col("doc_id") + 100_000).alias("doc_id"), F.concat(
        "text", F.lit(" the end")).alias("text"), "lang", "source", "n_chars")
    odd = spark.createDataFrame([(900_001, None, "en", "s", None), (900_002, "", None, "s", 0)], docs.schema)
    docs.withColumn("text", text).unionByName(near).unionByName(odd).write.parquet(f"{path}/documents.parquet")
    return path


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(found[i:i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()


def plain(folder):
    """Rows of every stage by SQL, sets of shingles and regular expressions."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.as_sql()}) WHERE kept").fetchall()}
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    good = {i: texts[i] for i in kept}
    sets, first = {i: shingles(t) for i, t in good.items()}, {i: i for i in good}

    def root(i):
        while first[i] != i:
            i = first[i]
        return i

    ids = sorted(good)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                first[y] = x
    unique = {i: good[i] for i in ids if root(i) == i}
    return good, unique, {i: MARKS.sub("[secret]", t) for i, t in unique.items()}


def pieces(masked):
    tokenizer, out = words.load_json("byte_bpe_50k.json"), []
    for i, text in masked.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        start = 0
        while start < len(ids):
            length = min(1024, 1 << (len(ids) - start).bit_length() - 1)
            part = np.array(ids[start:start + length], "<u4").tobytes()
            out.append((i, start, length, zlib.crc32(part), len(ids)))
            start += length
    return sorted(out)


@pytest.fixture(scope="module")
def expected(folder):
    return plain(folder)


def test_run(spark, folder, expected):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == pieces(expected[2])
    in_order = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in in_order] == list(range(len(rows))) and {r.offset for r in rows} == {0}
    assert [r.length for r in in_order] == sorted((r.length for r in rows), reverse=True)


def test_stages(spark, folder, expected):
    docs = common.documents(spark, folder)
    assert 0 < len(expected[1]) < len(expected[0]) < docs.count()
    columns = docs.columns
    for (name, stage), texts in zip(corpus_pipeline.STAGES, expected):
        docs = common.staged(stage(spark, docs, folder), common.run_dir(spark, name))
        assert docs.columns == columns
        got = {r.doc_id: r for r in docs.collect()}
        assert {i: r.text for i, r in got.items()} == texts
        if name == "secret_scan":
            assert all(r.n_chars == len(r.text) for r in got.values()) and any("[secret]" in t for t in texts.values())
    common.cleanup()


def test_filter_on_the_verdict_plans(spark, folder, expected):
    judged = quality.judge(common.documents(spark, folder)).filter("kept")
    assert {r.doc_id for r in judged.collect()} == set(expected[0])


GOOD = " ".join(f"the word{i} of a line that is{i} plain" for i in range(20))
CLASHES = ("_quality int, _row string, _counts int, _words string, _key long, _more string, _text int, _id long, "
           "_doc string, _text_key long, first boolean, key string, uid long, comp int, n_shingles string")


def clashing(spark):
    names = [c.split()[0] for c in CLASHES.split(", ")]
    rows = [(1, GOOD, 1), (None, GOOD + " more words", 2), (2, None, 3), (3, "", 4), (4, GOOD, 5), (5, "a " + KEYS[0], 6),
            (None, None, 7), (5, "a " + KEYS[0], 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    return docs.withColumns({n: (F.col("n_chars") + 10).cast(c.split()[1]) for n, c in zip(names, CLASHES.split(", "))})


@pytest.mark.parametrize("stage, ids", [
    (quality.keep, [1, 2, 5]), (jaccard.keep_one, [1, 3, 4, 6, 7]), (secrets.mask, [1, 2, 3, 4, 5, 6, 7, 8])])
def test_clashing_names(spark, stage, ids):
    """All columns come back, also those named like helpers; nulls, repeats and empty tables are no trouble."""
    docs = clashing(spark)
    kept = stage(docs)
    assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
    rows = kept.collect()
    found = sorted(r._key - 10 for r in rows)
    assert len(found) == len(ids) and set(found) <= set(range(1, 9))
    if stage is not jaccard.keep_one:  # of rows alike any may stay
        assert found == ids
    assert all(r._row == str(r._key) and r.comp == r._key for r in rows)
    assert stage(docs.filter("false")).count() == 0


def test_long_chains_take_few_steps(spark, tmp_path, monkeypatch):
    """A chain numbered in order is contracted in about the logarithm of its length."""
    n, made = 1000, []
    whole = common.staged
    monkeypatch.setattr(jaccard.common, "staged", lambda df, folder: made.append(folder) or whole(df, folder))
    labels = spark.range(n + 5).select(F.col("id").alias("uid"), F.col("id").alias("comp"))
    links = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    found = jaccard.merged(labels, links, str(tmp_path / "chain"))
    comps = {}
    for r in found.collect():
        comps.setdefault(r.comp, set()).add(r.uid)
    assert sorted(map(len, comps.values())) == [1] * 5 + [n]
    assert len([f for f in made if "/to-" in f]) < 20
