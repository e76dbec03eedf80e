"""Pre-tokens of every script, and buckets that follow the number of distinct words."""

import hashlib

import pytest

from pulseloom.llm import byte_bpe, counting, words

TEXTS = ["Привет, мир  и\tдом's 12\n\nΑθήνα", "東京 は大きい。 東京", "שלום עולם 😀 😀😀 x", "नमस्ते दुनिया",
         "café İstanbul ﻿ a", "new letter ꟎ here ꟎", "private\U0010fffd use", None, ""]


def test_every_script_is_cut():
    assert words.Batch([TEXTS[0]]).words == [  # each once, as they come first
        "Привет", ",", " мир", " ", " и", "\t", "дом", "'s", " 12", "\n", "Αθήνα"]
    assert "東京" in words.Batch([TEXTS[1]]).words and " 東京" in words.Batch([TEXTS[1]]).words
    # unassigned in the tables at hand: libraries may know it as a letter
    assert words.Batch(["a꟎b  c꟎"]).words == ["a꟎b  c꟎"]


@pytest.mark.parametrize("library", ["tokenizers", "tiktoken"])
def test_cuts_are_those_of_the_library(library):
    """One text per code point of the first planes, in steps; whole texts against their words."""
    json, ranks = words.load_json("byte_bpe_50k.json"), words.load_ranks("byte_bpe_50k.tiktoken")
    encode = (lambda t: json.encode(t, add_special_tokens=False).ids) if library == "tokenizers" else ranks.encode_ordinary
    points = [*range(1, 0x3400), *range(0x3400, 0xD800, 41), *range(0xE000, 0x10000, 3), *range(0x10000, 0x20000, 7)]
    for c in points:
        x = chr(c)
        text = f"ab{x} {x}c\n{x}1 it's {x}'s x{x}. {x}  {x}{x} 1{x}2,{x}, {x}"
        batch = words.Batch([text])
        assert [i for n in batch.sequence for i in encode(batch.words[n])] == encode(text), hex(c)


@pytest.mark.parametrize("bucket_words", [200_000, 2])
def test_whole_texts_in_any_number_of_buckets(spark, monkeypatch, bucket_words):
    monkeypatch.setattr(words, "BUCKET_WORDS", bucket_words)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, part string")
    if bucket_words == 2:
        assert words._buckets(docs) > 8
    json, ranks = words.load_json("byte_bpe_50k.json"), words.load_ranks("byte_bpe_50k.tiktoken")
    counted = {r.doc_id: (r.n_bytes, r.n_tokens) for r in counting.report(docs).collect()}
    encoded = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in byte_bpe.report(docs).collect()}
    for i, t in enumerate(TEXTS):
        ids = ranks.encode_ordinary(t or "")
        assert counted[i] == (len((t or "").encode()), len(json.encode(t or "", add_special_tokens=False).ids))
        assert encoded[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
