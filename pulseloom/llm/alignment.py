"""Cross-tokenizer alignment: where two tokenizers' tokens of a text end together.

The cumulative byte ends of both id lists become end-to-index dictionaries; their common
keys, sorted, slice both lists into groups, and every slice is expanded into the links of
tokens that share bytes. Both tokenizers always end a token where a single space or newline
begins a word, so a text falls apart there and equal chunks are aligned once.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pulseloom.llm import common, words

BATCH_CHARS = 4 << 20
JOINED = 250  # chunks that are encoded and aligned as one text
MOST = 1_000_000  # chunks a worker remembers
PIECES_A, PIECES_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def byte_letters() -> dict[str, int]:
    """Byte of each letter of byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers with the bytes of their tokens, read once per worker."""

    def __init__(self, name_a: str, name_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(words.vocabulary(name_a))
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=words.vocabulary(name_b))
        letters, found = byte_letters(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(found.values()) + 1)
        for piece, i in found.items():
            self.bytes_a[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # a text may be cut before a space only if no piece goes on across one
        self.cuts = not any(b" " in x.lstrip(b" ") or b"\n" in x[1:] for x in self.bytes_b)
        self.known: dict[str, bytes | None] = {}

    def ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a space and the text; None where the tokens do not spell exactly that."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        raw = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return a, b

    def align(self, text: str) -> tuple[list[int], list[int], list[int], list[int], list[int]] | None:
        """Ids, the common ends in bytes, and the tokens of each list up to every common end."""
        found = self.ids(text)
        if found is None:
            return None
        a, b = found
        at_a = dict(zip(itertools.accumulate(map(len, map(self.bytes_a.__getitem__, a))), itertools.count(1)))
        at_b = dict(zip(itertools.accumulate(map(len, map(self.bytes_b.__getitem__, b))), itertools.count(1)))
        ends = sorted(at_a.keys() & at_b.keys())
        return a, b, ends, [at_a[e] for e in ends], [at_b[e] for e in ends]

    def entry(self, text: str) -> bytes | None:
        """One text on its own, packed: three counts, ids of both, group sizes of both."""
        found = self.align(text)
        if found is None:
            return None
        a, b, ends, upto_a, upto_b = found
        return _packed(np.array(a, "<u4"), np.array(b, "<u4"), np.array(upto_a), np.array(upto_b))

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that no longer hold white space; None for those to be left in their text."""
        plain: dict[bool, list[str]] = {False: [], True: []}
        for c in chunks:
            body = c[1:] if c[:1] == "\n" else c
            if not self.cuts or body.split() != [body]:
                self.known[c] = None
            else:
                plain[c[0] == "\n"].append(c)
        for newline, some in plain.items():
            for at in range(0, len(some), JOINED):
                part = some[at:at + JOINED]
                if not self._block(part, newline):
                    for c in part:
                        if not self._block([c], newline):
                            self.known[c] = None

    def _block(self, part: list[str], newline: bool) -> bool:
        """Chunks joined by spaces are aligned as one text and cut where each of them ends."""
        found = self.align(" ".join(part))
        if found is None:
            return False
        a, b = np.array(found[0], "<u4"), np.array(found[1], "<u4")
        ends, upto_a, upto_b = (np.array(x) for x in found[2:])
        wanted = np.cumsum([1 + len(c.encode()) for c in part])
        group = np.searchsorted(ends, wanted)
        if (ends[np.minimum(group, len(ends) - 1)] != wanted).any():
            return False
        first = np.concatenate([[0], group[:-1] + 1])
        if newline:  # the joining space is not part of the chunk: a token of its own in both
            spaces = np.concatenate([[0], wanted[:-1]]) + 1
            before_a = np.concatenate([[0], upto_a])[first]
            before_b = np.concatenate([[0], upto_b])[first]
            if (ends[first] != spaces).any() or (upto_a[first] != before_a + 1).any() or (
                    upto_b[first] != before_b + 1).any():
                return False
            first = first + 1
        lead_a, lead_b, last = np.concatenate([[0], upto_a]), np.concatenate([[0], upto_b]), group + 1
        n_a, n_b, n = lead_a[last] - lead_a[first], lead_b[last] - lead_b[first], last - first
        sizes = 3 + n_a + n_b + 2 * n
        edges = np.concatenate([[0], np.cumsum(sizes)])
        at, data = edges[:-1].copy(), np.empty(edges[-1], "<u4")
        data[at], data[at + 1], data[at + 2] = n_a, n_b, n
        at += 3
        for values, begins, width in ((a, lead_a[first], n_a), (b, lead_b[first], n_b),
                                      (np.diff(lead_a), first, n), (np.diff(lead_b), first, n)):
            data[_ranges(at, width)] = values[_ranges(begins, width)]
            at += width
        packed, cuts = data.tobytes(), (4 * edges).tolist()
        self.known.update(zip(part, [packed[x:y] for x, y in zip(cuts, cuts[1:])]))
        return True


def _packed(a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> bytes:
    counts = np.array([len(a), len(b), len(upto_a)], "<u4")
    sizes = [np.diff(x, prepend=0).astype("<u4") for x in (upto_a, upto_b)]
    return b"".join(x.tobytes() for x in (counts, a, b, *sizes))


def load(name_a: str, name_b: str) -> Pair:
    key = ("pair", name_a, name_b)
    if key not in words.kept():
        words.kept()[key] = Pair(name_a, name_b)
    return words.kept()[key]


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of ragged slices, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Aligned:
    """A batch of documents as sequences of numbers of aligned chunks."""

    def __init__(self, texts: list[str], pair: Pair):
        marked = pa.array([t.replace("\n", " \n") if t else None for t in texts], pa.string())
        split = pc.split_pattern(marked, " ")
        flat = split.flatten().dictionary_encode()
        chunks, number = flat.dictionary.to_pylist(), flat.indices.to_numpy()
        if len(pair.known) + len(chunks) > MOST:
            pair.known.clear()
        pair.learn([c for c in chunks if c not in pair.known])
        entries = [pair.known[c] for c in chunks]
        missing = np.array([x is None for x in entries], bool)
        edges = split.offsets.to_numpy()
        bad = np.concatenate([[0], np.cumsum(missing[number])])
        whole = np.flatnonzero(bad[edges[1:]] > bad[edges[:-1]])
        sequences = np.split(number.astype(np.int64), edges[1:-1])
        for i in whole.tolist():  # other white space: the text is aligned as one chunk
            found = pair.entry(texts[i])
            sequences[i] = np.array([] if found is None else [len(entries)], np.int64)
            if found is not None:
                entries.append(found)
        self.lengths = np.array([len(x) for x in sequences], np.int64)
        self.sequence = np.concatenate([*sequences, np.array([], np.int64)])
        used = np.bincount(self.sequence, minlength=len(entries)) > 0
        self.sequence = (np.cumsum(used) - 1)[self.sequence]
        self._unpack([x for x, u in zip(entries, used.tolist()) if u], pair)

    def _unpack(self, entries: list[bytes], pair: Pair) -> None:
        data = np.frombuffer(b"".join(entries), "<u4").astype(np.int64)
        sizes = np.array([len(x) // 4 for x in entries], np.int64)
        at = np.cumsum(sizes) - sizes
        self.n_a, self.n_b, self.n_groups = (data[at + i] for i in range(3))
        at = at + 3
        self.a = data[_ranges(at, self.n_a)]
        self.b = data[_ranges(at + self.n_a, self.n_b)]
        at = at + self.n_a + self.n_b
        self.size_a = data[_ranges(at, self.n_groups)]
        self.size_b = data[_ranges(at + self.n_groups, self.n_groups)]
        # a link for each stretch between two ends within a slice; slices end in both lists
        ends_a, ends_b = np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b])
        ends = np.union1d(ends_a, ends_b)
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.pairs, self.link = np.unique(self.a[link_a] << 32 | self.b[link_b], return_inverse=True)
        self.n_links = np.bincount(np.repeat(np.arange(len(self.n_a)), self.n_a)[link_a], minlength=len(self.n_a))

    def documents_of_pairs(self) -> np.ndarray:
        """In how many documents each pair is linked."""
        width = max(len(self.n_a), 1)
        held = np.unique(np.repeat(np.arange(len(self.lengths)), self.lengths) * width + self.sequence)
        doc, chunk = held // width, held % width
        begins = np.cumsum(self.n_links) - self.n_links
        n = self.n_links[chunk]
        linked = np.unique(np.repeat(doc, n) * max(len(self.pairs), 1) + self.link[_ranges(begins[chunk], n)])
        return np.bincount(linked % max(len(self.pairs), 1), minlength=len(self.pairs))


_KEPT = ("lengths", "sequence", "n_a", "n_b", "n_groups", "a", "b", "size_a", "size_b", "pairs", "link", "n_links")
_WIDE = ("lengths", "pairs")


def write(docs: DataFrame, folder: str, name_a: str = PIECES_A, name_b: str = PIECES_B) -> DataFrame:
    """Align all documents; returns the staged (batch, pair, docs) rows of their links.

    The alignments of a batch lie in a file named by it. ``pair`` holds the id of the first
    tokenizer above 32 bits and that of the second below; a batch without links has one
    row with pair -1.
    """

    def run(frames):
        common.alone("alignment")
        pair = load(name_a, name_b)
        for ids, texts in common.batches(frames, BATCH_CHARS):
            found = Aligned(texts, pair)
            batch = uuid.uuid4().int >> 65
            side = {k: getattr(found, k).astype(np.int64 if k in _WIDE else np.uint32) for k in _KEPT}
            common.write_file(_path(folder, batch), words.pack(**words.doc_ids(ids), **side))
            rows = pd.DataFrame({"pair": found.pairs, "docs": found.documents_of_pairs()})
            rows = rows if len(rows) else pd.DataFrame({"pair": [-1], "docs": [0]})
            rows.insert(0, "batch", batch)
            yield rows

    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return common.staged(rows.mapInPandas(run, "batch long, pair long, docs long"), f"{folder}/pairs")


def _path(folder: str, batch: int) -> str:
    return f"{folder}/batches/{batch}"


def counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold the pair linked, and whether no pair of the
    same first id is held by more."""
    whole = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    first = F.shiftright("pair", 32)
    top = whole.groupBy(first.alias("_first")).agg(F.max("count").alias("_top"))
    return whole.withColumn("_first", first).join(top, "_first").select(
        "pair", "count", (F.col("count") == F.col("_top")).alias("best"))


def alignments(pairs: DataFrame, folder: str) -> DataFrame:
    """The aligned documents: ids of both tokenizers and how many of each make up every group."""

    def run(frames):
        common.alone("alignment")
        for frame in frames:
            for batch in frame["batch"].tolist():
                side = words.unpack(common.read_file(_path(folder, batch)))
                doc = np.repeat(np.arange(len(side["lengths"])), side["lengths"])
                out = {"doc_id": words.nullable(side)}
                for name, size in (("a", "n_a"), ("b", "n_b"), ("size_a", "n_groups"), ("size_b", "n_groups")):
                    n = side[size].astype(np.int64)
                    values = side[name][_ranges((np.cumsum(n) - n)[side["sequence"]], n[side["sequence"]])]
                    each = np.bincount(doc, n[side["sequence"]], len(side["lengths"])).astype(np.int64)
                    out[name] = np.split(values.astype(np.int32), np.cumsum(each)[:-1])
                yield pd.DataFrame(out)

    return pairs.select("batch").distinct().mapInPandas(
        run, "doc_id long, a array<int>, b array<int>, size_a array<int>, size_b array<int>")


def _shown(side: dict) -> list[str]:
    """Every chunk's groups as text."""
    a, b = list(map(str, side["a"].tolist())), list(map(str, side["b"].tolist()))
    out, at_a, at_b, groups = [], 0, 0, zip(side["size_a"].tolist(), side["size_b"].tolist())
    for n in side["n_groups"].tolist():
        some = []
        for size_a, size_b in itertools.islice(groups, n):
            some.append(f"{a[at_a] if size_a == 1 else ','.join(a[at_a:at_a + size_a])}|"
                        f"{b[at_b] if size_b == 1 else ','.join(b[at_b:at_b + size_b])}")
            at_a, at_b = at_a + size_a, at_b + size_b
        out.append(";".join(some))
    return out


def _digests(side: dict, count: np.ndarray, best: np.ndarray) -> pd.DataFrame:
    edges = np.concatenate([[0], np.cumsum(side["lengths"])])
    sequence, n_links = side["sequence"], side["n_links"].astype(np.int64)

    def summed(per_chunk: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(per_chunk.astype(np.int64)[sequence])])
        return total[edges[1:]] - total[edges[:-1]]

    def of_links(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values.astype(np.int64)[side["link"]])])
        ends = np.cumsum(n_links)
        return total[ends] - total[ends - n_links]

    shown, order = _shown(side), sequence.tolist()
    texts = [";".join(map(shown.__getitem__, order[x:y])) for x, y in zip(edges.tolist(), edges[1:].tolist())]
    return pd.DataFrame({
        "doc_id": words.nullable(side), "n_a": summed(side["n_a"]), "n_b": summed(side["n_b"]),
        "n_groups": summed(side["n_groups"]), "n_links": summed(n_links), "n_best": summed(of_links(best)),
        "count_sum": summed(of_links(count)),
        "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]})


def report(docs: DataFrame, name_a: str = PIECES_A, name_b: str = PIECES_B) -> DataFrame:
    """Counts of tokens, groups and links of every document, and a digest of its groups.

    A null or empty text, and one whose tokens do not spell it, has no tokens: zeros and an
    empty digest. Ids may be null or repeat, each row stands for itself and counts as a
    document; pairs that tie for the highest count are all best; other columns are ignored;
    an empty table gives no rows.
    """
    folder = common.run_dir(docs.sparkSession, "alignment")
    pairs = write(docs, folder, name_a, name_b)

    def done(batch: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        side = words.unpack(common.read_file(_path(folder, batch)))
        rows = pd.concat(parts)
        rows = rows[rows["pair"] >= 0].sort_values("pair")
        return _digests(side, rows["count"].to_numpy(), rows["best"].to_numpy(dtype=bool))

    def run(frames):
        common.alone("alignment")
        batch, parts = None, []
        for frame in frames:
            for name, part in frame.groupby("batch", sort=False):
                if name != batch and parts:
                    yield done(batch, parts)
                    parts = []
                batch = name
                parts.append(part)
        if parts:
            yield done(batch, parts)

    answers = pairs.join(counts(pairs), "pair").select("batch", "pair", "count", "best")
    return answers.repartition(common.partitions(docs.sparkSession), "batch").sortWithinPartitions("batch").mapInPandas(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
             "groups_sha256 string")
