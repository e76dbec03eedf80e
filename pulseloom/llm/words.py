"""Cutting texts where a tokenizer cuts anyway, and a shuffle of distinct words.

A single space or newline between two other characters always begins a pre-token, so a
text falls apart there and equal chunks need one look. Texts with other white space at
such places are cut by the pattern as a whole; chunks that hold a code point on whose class
libraries may differ are not cut at all.
"""

from __future__ import annotations

import gc
import io
import os
import re
import unicodedata
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F

from pulseloom.llm import common
from pulseloom.llm.common import kept

BATCH_CHARS = 8 << 20
BUCKET_WORDS = 200_000
START = "\0"  # marks a chunk that begins a text: no space belongs to it


def vocabulary(name: str) -> str:
    """Place of a vocabulary file: a path as it is, or a name of the public files."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_json(name: str):
    """The tokenizer of a .json file, read once per worker."""
    if name not in kept():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        kept()[name] = Tokenizer.from_file(vocabulary(name))
    return kept()[name]


def load_ranks(name: str):
    """The encoding of a .tiktoken file, without special tokens, read once per worker."""
    if name not in kept():
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        kept()[name] = tiktoken.Encoding(os.path.basename(name), pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=ranks, special_tokens={})
    return kept()[name]


def chunks(text: str) -> list[str] | None:
    """The text at its single spaces and newlines; None where white space is not that plain.

    A chunk that begins with a newline carries it, one that begins the text carries
    ``START``, any other one had a space before it. White space inside a chunk is not
    looked for here.
    """
    parts = text.replace("\n", " \n").split(" ")
    if "" in parts or "\n" in parts or START in text:
        return None
    parts[0] = START + parts[0]
    return parts


_CONTROL = re.compile("[\x1c-\x1f\x85\0]")


def plain(chunk: str) -> str | None:
    """What a chunk stands for in the text, or None if it holds other white space."""
    body = chunk[1:] if chunk[0] in "\n" + START else chunk
    if body.split() != [body]:
        return None
    return body if chunk[0] == START else chunk if chunk[0] == "\n" else " " + chunk


# Latin letters or digits, then marks that join neither them nor an apostrophe; not the
# dotted capital I, which falls apart when lower-cased
_TAIL = re.compile(r"([\n\0]?[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?*$%&#|]+)")


class Encoder:
    """Ids of whole texts by a tokenizer of the library, equal chunks encoded once.

    The memory of a worker is bounded: a full table of chunks is emptied.
    """

    MOST = 1_200_000
    JOINED = 250  # texts that one call of the library takes joined

    def __init__(self, name: str):
        self.name, self.tokenizer = name, load_json(name)
        self.known = kept().setdefault(("chunks", name), {})
        special = [t for t in self.tokenizer.get_added_tokens_decoder().items() if t[1].special]
        self.mark_id, self.mark = (special[0][0], special[0][1].content) if special else (None, None)
        # white space that the tokenizer drops leaves nothing to tell by where it was
        self.bare = self._ids([" a\n"]) == self._ids(["a"])
        # tokens that begin with a space: among words after single spaces each begins a word
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[i for piece, i in vocabulary.items() if piece.startswith("\u0120")]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _words(self, texts: list[str]) -> list[bytes]:
        """Words that each begin with their only white space, a space, in few calls."""
        out: list[bytes] = []
        for at in range(0, len(texts), self.JOINED):
            part = texts[at:at + self.JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(self.begins[ids])).tolist()
            if len(cuts) != len(part):
                out += self._ids(part)
                continue
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]
        return out

    def _many(self, texts: list[str]) -> list[bytes]:
        """Short texts in few calls."""
        if self.bare:
            return self._marked(texts)
        spaced = [i for i, t in enumerate(texts) if t[:1] == " " and "<" not in t]
        if len(spaced) == len(texts):
            return self._words(texts)
        out: list = [None] * len(texts)
        for i, x in zip(spaced, self._words([texts[i] for i in spaced])):
            out[i] = x
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._marked([texts[i] for i in rest])):
            out[i] = x
        return out

    def _marked(self, texts: list[str]) -> list[bytes]:
        """A special token between two texts cuts the ids again."""
        mark = self.mark
        if mark is None:
            return self._ids(texts)
        odd = {i for i, t in enumerate(texts) if "<" in t or not t}
        even = [t for i, t in enumerate(texts) if i not in odd] if odd else texts
        out: list[bytes] = []
        for at in range(0, len(even), self.JOINED):
            part = even[at:at + self.JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([mark.join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark_id)
            data = ids.tobytes()
            begins, ends = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(data)]
            out += [data[a:b] for a, b in zip(begins, ends)]
        if not odd:
            return out
        rest, whole = iter(out), iter(self._ids([texts[i] for i in sorted(odd)]))
        return [next(whole) if i in odd else next(rest) for i in range(len(texts))]

    def _learn(self, new: list[str]) -> None:
        known, tails, single = self.known, [], set()
        for c in new:
            m = _TAIL.fullmatch(c)
            if m is None:
                single.add(c)
                continue
            head, tail = m.groups()
            tail = tail if self.bare else START + tail
            tails.append((c, head, tail))
            if head not in known:
                single.add(head)
            if tail not in known:
                single.add(tail)
        fine, shown = [], []
        for c in single:
            text = c if self.bare else plain(c) if c.strip(START + "\n") else None
            if text is None:
                known[c] = None
            else:
                fine.append(c)
                shown.append(text)
        known.update(zip(fine, self._many(shown)))
        for c, head, tail in tails:
            a, b = known[head], known[tail]
            known[c] = None if a is None or b is None else a + b

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of every text."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here refers to itself, and the table is large
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        split, whole = self._split(texts)
        flat = split.flatten().dictionary_encode()
        distinct, number = flat.dictionary.to_pylist(), flat.indices.to_numpy()
        if len(self.known) + len(distinct) > self.MOST:
            self.known.clear()
        self._learn([c for c in distinct if c not in self.known])
        found = [self.known[c] for c in distinct]
        missing = np.array([x is None for x in found], bool)
        found = [x or b"" for x in found]
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        begins = np.cumsum(sizes) - sizes
        each = sizes[number]
        ends = np.cumsum(each)
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(begins[number] - ends + each, each) + np.arange(each.sum())]
        edges = split.offsets.to_numpy()
        bad = np.concatenate([[0], np.cumsum(missing[number])])
        whole |= bad[edges[1:]] > bad[edges[:-1]]
        cuts = (4 * np.concatenate([[0], ends])[edges]).tolist()
        data = ids.tobytes()
        out = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        rest = np.flatnonzero(whole).tolist()
        for i, x in zip(rest, self._ids([texts[i] for i in rest])):
            out[i] = x
        return out

    def _split(self, texts: list[str]) -> tuple[pa.ListArray, np.ndarray]:
        """The chunks of every text (see ``chunks``), and which texts must be encoded whole."""
        if self.bare:
            whole = np.array([_CONTROL.search(t) is not None for t in texts], bool)
            return pc.utf8_split_whitespace(pa.array(texts, pa.string())), whole
        whole = np.array([START in t for t in texts], bool)
        marked = pa.array([START + t.replace("\n", " \n") if t else None for t in texts], pa.string())
        return pc.split_pattern(marked, " "), whole


class Batch:
    """Documents as sequences of numbers of their distinct words."""

    _LATIN = re.compile("[\x00-ɏ‐-‧€]*")  # the quick answer of ``_agreed``

    def __init__(self, texts: list[str], specials: tuple[str, ...] = ()):
        import public_tokenizers

        self._find = kept().setdefault("pattern", regex.compile(public_tokenizers.PATTERN)).findall
        self._special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.numbers: dict[str, int] = {}
        known: dict[str, bytes] = {}
        done = []
        for text in texts:
            parts = chunks(text) if text else []
            ids = None
            if parts is not None:
                try:
                    ids = b"".join(map(known.__getitem__, parts))
                except (KeyError, TypeError):
                    for c in parts:
                        if c not in known:
                            stands = plain(c)
                            known[c] = None if stands is None else self._packed(stands)
                    found = list(map(known.__getitem__, parts))
                    ids = None if None in found else b"".join(found)
            done.append(self._packed(text) if ids is None else ids)
        self.lengths = np.array([len(x) // 4 for x in done], np.int64)
        self.sequence = np.frombuffer(b"".join(done), "<u4")
        self.words = list(self.numbers)

    def _packed(self, text: str) -> bytes:
        return np.array([self.numbers.setdefault(w, len(self.numbers)) for w in self._words(text)], "<u4").tobytes()

    def _words(self, text: str) -> list[str]:
        if self._special is not None and (parts := self._special.split(text))[1:]:
            return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._words(part))]
        return self._find(text) if self._agreed(text) else [text]

    def _agreed(self, text: str) -> bool:
        """Whether all libraries class every code point alike: all but those that Python's
        tables leave unassigned, which newer tables may have filled, do."""
        return bool(self._LATIN.fullmatch(text)) or not any(
            unicodedata.category(c) in ("Cn", "Cs") for c in set(text))


def pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.compress(out.getvalue(), 3)


def unpack(data: bytes) -> dict:
    with np.load(io.BytesIO(zstandard.decompress(data))) as found:
        return {name: found[name] for name in found.files}


def doc_ids(ids: list) -> dict:
    """Ids with nulls as two arrays."""
    null = np.array([pd.isna(x) for x in ids], bool)
    return {"doc": np.array([0 if n else int(x) for x, n in zip(ids, null)], np.int64), "null": null}


def nullable(side: dict) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(side["doc"].copy(), side["null"].copy())


def _buckets(docs: DataFrame) -> int:
    """As many word buckets as keep one near ``BUCKET_WORDS`` distinct words, from all texts.

    What stands between white space is counted, by a mergeable sketch that never leaves the
    scan; pre-tokens are at most a few times as many.
    """
    parts = common.texts(docs).select(F.explode(F.split("text", "[ \n]")).alias("part"))
    distinct = parts.agg(F.approx_count_distinct("part", 0.1)).first()[0]
    return max(common.partitions(docs.sparkSession), -(-distinct // BUCKET_WORDS))


BLOCKS = "bucket int, batch string, path string, words binary"


def distinct_words(docs: DataFrame, folder: str, keep, specials: tuple[str, ...] = ()) -> DataFrame:
    """Cut the documents in batches; stage what each batch asks of the word shuffle.

    ``keep(batch)`` gives the arrays a batch needs again; they go to a file of their own.
    The exploded (batch, word) rows are packed by word bucket: one row per batch and
    non-empty bucket, never more rows than distinct words of batches.
    """
    buckets = _buckets(docs)

    def cut(frames):
        common.alone("words")
        for ids, found in common.batches(frames, BATCH_CHARS):
            batch = Batch(found, specials)
            raw = [w.encode("utf-8", "surrogatepass") for w in batch.words]
            bucket = np.array([zlib.crc32(w) % buckets for w in raw], np.uint32)
            name = uuid.uuid4().hex
            path = f"{folder}/batches/{name}"
            common.write_file(path, pack(**doc_ids(ids), bucket=bucket, **keep(batch)))
            rows = []
            for b in np.unique(bucket).tolist() or [0]:  # a batch without words asks for nothing, once
                words = [raw[i] for i in np.flatnonzero(bucket == b)]
                sizes = np.array([len(w) for w in words], "<u4").tobytes()
                rows.append((b, name, path, zstandard.compress(
                    len(words).to_bytes(4, "little") + sizes + b"".join(words), 3)))
            yield pd.DataFrame(rows, columns=["bucket", "batch", "path", "words"])

    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return common.staged(rows.mapInPandas(cut, BLOCKS), f"{folder}/words")


def _unpack_words(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 4).astype(np.int64)) + 4 + 4 * n
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist())] if n else []


def answered(blocks: DataFrame, ask) -> DataFrame:
    """Shuffle the words by bucket, ``ask`` about each distinct word once, answer every batch.

    ``ask(words)`` maps a list of new words to a list of bytes. Rows come out as
    (batch, path, bucket, answers). Within a task only the words of one bucket are held.
    """
    n = common.partitions(blocks.sparkSession)

    def run(frames):
        common.alone("words")
        bucket, known = None, {}
        for frame in frames:
            rows = []
            for b, batch, path, data in zip(frame["bucket"], frame["batch"], frame["path"], frame["words"]):
                if b != bucket:
                    bucket, known = b, {}
                words = _unpack_words(data)
                new = [w for w in dict.fromkeys(words) if w not in known]
                known.update(zip(new, ask([w.decode("utf-8", "surrogatepass") for w in new])))
                found = [known[w] for w in words]
                sizes = np.array([len(x) for x in found], "<u4").tobytes()
                rows.append((batch, path, b, zstandard.compress(
                    len(found).to_bytes(4, "little") + sizes + b"".join(found), 3)))
            yield pd.DataFrame(rows, columns=["batch", "path", "bucket", "answers"])

    return blocks.repartition(n, "bucket").sortWithinPartitions("bucket").mapInPandas(
        run, "batch string, path string, bucket int, answers binary")


def reassembled(answers: DataFrame, finish, schema: str) -> DataFrame:
    """Bring the answers back to their batches: ``finish(side, answers by word number)``."""
    n = common.partitions(answers.sparkSession)

    def done(path, rows):
        side = unpack(common.read_file(path))
        by_number: list = [b""] * len(side["bucket"])
        for b, data in rows:
            for i, answer in zip(np.flatnonzero(side["bucket"] == b).tolist(), _unpack_words(data)):
                by_number[i] = answer
        return finish(side, by_number)

    def run(frames):
        common.alone("words")
        batch, path, rows = None, None, []
        for frame in frames:
            for name, at, b, data in zip(frame["batch"], frame["path"], frame["bucket"], frame["answers"]):
                if name != batch:
                    if rows:
                        yield done(path, rows)
                    batch, path, rows = name, at, []
                rows.append((b, data))
        if rows:
            yield done(path, rows)

    return answers.repartition(n, "batch").sortWithinPartitions("batch").mapInPandas(run, schema)
