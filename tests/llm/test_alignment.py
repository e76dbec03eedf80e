"""Alignment of two tokenizers against a plain version over whole texts."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from pulseloom.llm import alignment, common, words

SCHEMA = "doc_id long, text string, batch long, pair string, n_a string, count string, docs int"


def plain(rows):
    """Everything the contract asks for, from the two libraries and loops over tokens."""
    a_lib = Tokenizer.from_file(words.vocabulary("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=words.vocabulary("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    docs = []
    for doc_id, text in rows:
        groups, links = [], []
        if text:
            raw = (" " + text).encode()
            a = [(i, bytes(letters[c] for c in a_lib.id_to_token(i)))
                 for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
                  else b_lib.id_to_piece(i).replace("▁", " ").encode()) for i in b_lib.encode(text)]
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                at = [0, 0]
                spans = []
                for side in (a, b):
                    begin, out = 0, []
                    for i, piece in side:
                        out.append((i, begin, begin + len(piece)))
                        begin += len(piece)
                    spans.append(out)
                common_ends = sorted({s[2] for s in spans[0]} & {s[2] for s in spans[1]})
                begin = 0
                for end in common_ends:
                    part = [[s for s in side if begin <= s[1] and s[2] <= end] for side in spans]
                    groups.append(tuple([s[0] for s in p] for p in part))
                    links += [(x[0], y[0]) for x in part[0] for y in part[1] if x[1] < y[2] and y[1] < x[2]]
                    begin = end
        docs.append((doc_id, groups, links))
    held = Counter(pair for _, _, links in docs for pair in set(links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc_id, groups, links in docs:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def order(row):
    return [(x is None, x) for x in row]


def rows_of(spark):
    chosen = random.Random(3)
    some = [r.text for r in common.documents(spark, "/root/testdata/sf0.001").select("text").limit(25).collect()]
    odd = ["", None, " ", "\n", "a", "\nfoo", "foo\n", "a  b", " lead", "a\n\nb", "tab\there", "nbsp x", "▁ x",
           "a▁b", "<|endoftext|> plain <unk> <s> <0x41>", "東京 café naïve \U0001f600",
           "line one\nline two\nline", "\0 zero", "x\ry", "word, word. «quoted» don't", "​ zero width"]
    long = " ".join(chosen.choice(["alpha", "beta,", "\ngamma", "δelta", "12345", "x" * 50]) for _ in range(6000))
    return list(enumerate([t[:2500] for t in some] + odd + [long, some[0][:2500], "a"])) + [(3, "again three"), (None, "no id")]


def test_against_plain_version(spark):
    rows = rows_of(spark)
    docs = spark.createDataFrame([(i, t, 7, "p", None, "c", None) for i, t in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in alignment.report(docs).collect()]
    assert sorted(got, key=order) == sorted(plain(rows), key=order)


def test_alignments_spell_the_texts(spark):
    rows = [(i, t) for i, t in rows_of(spark) if i is not None][-12:]
    docs = spark.createDataFrame([(i, t, 7, "p", None, "c", None) for i, t in rows], SCHEMA).coalesce(1)
    folder = common.run_dir(spark, "alignment")
    found = alignment.alignments(alignment.write(docs, folder), folder).collect()
    pair = alignment.Pair(alignment.PIECES_A, alignment.PIECES_B)
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    for r in found:
        a, b = (b"".join(table[i] for i in ids) for table, ids in ((pair.bytes_a, r.a), (pair.bytes_b, r.b)))
        assert a == b and (a == b"" or a.decode()[1:] in texts[r.doc_id])
        assert sum(r.size_a) == len(r.a) and sum(r.size_b) == len(r.b)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a b\nc d", "naïve"])
def test_chunks_join_to_the_whole(text):
    pair = alignment.Pair(alignment.PIECES_A, alignment.PIECES_B)
    batch = alignment.Aligned([text], pair)
    a, b = pair.ids(text)
    take = lambda values, n: [x for c in batch.sequence for x in values[(n.cumsum() - n)[c]:n.cumsum()[c]]]
    assert take(batch.a, batch.n_a) == a and take(batch.b, batch.n_b) == b


def test_empty_table(spark):
    assert alignment.report(spark.createDataFrame([], SCHEMA)).count() == 0
