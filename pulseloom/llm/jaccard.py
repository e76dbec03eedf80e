"""Exact Jaccard self-join of word shingles by token-combination prefixes.

Shingles are ordered by class, then hash: those of one document, rare shared ones, frequent
ones. A set that differs in at most d shingles from any partner only needs a prefix that
still holds a shared signature after d losses. Rare shingles are signatures alone. Frequent
ones are dealt into classes and indexed as pairs within a class, which lose one shingle per
class, so the prefix is extended until enough remain. Candidates are verified on the sets.

Copies (equal sets) collapse first. Within a signature, candidates meet a hub, not each
other, as long as that keeps joining components; what then still lies in different
components is compared exactly, so no link is missed: few sets pair by pair, many (a large
group of loose copies) in blocks, where pairs are counted inside tasks and are no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pulseloom.llm import common, words

SIZE = 5
PERCENT = 75
FREQUENT = 32  # documents from which on a shingle is frequent
PER_CLASS = 16  # shingles of a set for one class of frequent ones
ROUNDS = 2  # times that candidates meet hubs
LIGHT = 12  # sets of a signature up to which pairs are rows
BLOCK = 128  # sets compared at once
CELLS = 1 << 22  # shingle cells of one range of the frequency shuffle, about

_U = np.uint64
_MIX = [_U(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                            0x85EBCA77C2B2AE63)]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mixer (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + _U(seed) * _MIX[0] + _MIX[0]
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def shingles(numbers: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of a batch, by document and hash."""
    h, total = hashes[numbers] if len(numbers) else np.zeros(0, _U), len(numbers)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    with np.errstate(over="ignore"):
        value = np.zeros(max(total - SIZE + 1, 0), _U)
        for k in range(SIZE):
            value += h[k:k + len(value)] * _MIX[k]
        fits = np.arange(len(value)) + SIZE <= ends[doc[:len(value)]]
        value, doc = mix(value[fits]), doc[:len(value)][fits]
        short = np.flatnonzero((lengths > 0) & (lengths < SIZE))
        if len(short):
            whole = [sum((h[ends[i] - lengths[i] + k] * _MIX[k] for k in range(lengths[i])), _U(int(lengths[i])))
                     for i in short]
            value = np.concatenate([value, mix(np.array(whole, _U), 1)])
            doc = np.concatenate([doc, short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return doc[first], value[first]


_ROWS = "uid long, doc_id long, key long, n_shingles long, fp1 long, fp2 long, path string"


def _cut(folder: str):
    def run(frames):
        common.alone("jaccard")
        part, count = TaskContext.get().partitionId(), 0

        def packed(frames):
            # key travels with the id
            for frame in frames:
                yield pd.DataFrame({"doc_id": list(zip(frame["doc_id"].to_numpy(dtype=object), frame["key"])),
                                    "text": frame["text"]})

        for ids, texts in common.batches(packed(frames), words.BATCH_CHARS):
            numbers: dict[bytes, int] = {}
            found, lengths = [], []
            for text in texts:
                own = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
                lengths.append(len(own))
                found += [numbers.setdefault(w, len(numbers)) for w in own]
            sequence, lengths = np.array(found, np.uint32), np.array(lengths, np.int64)
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in numbers], _U)
            doc, value = shingles(sequence, lengths, hashes)
            n = np.bincount(doc, minlength=len(ids))
            with np.errstate(over="ignore"):
                fp = [np.zeros(len(ids), _U), np.zeros(len(ids), _U)]
                for k in range(2):
                    np.add.at(fp[k], doc, mix(value, 2 + k))
            path = f"{folder}/batches/{uuid.uuid4().hex}"
            small = len(numbers) < 1 << 16
            common.write_file(path, words.pack(sequence=sequence.astype(np.uint16 if small else np.uint32),
                                               lengths=lengths, hashes=hashes))
            uid = (((part << 16) | count) << 22) + np.arange(len(ids))
            count += 1
            yield pd.DataFrame({"uid": uid, "doc_id": pd.array([None if pd.isna(d) else int(d) for d, _ in ids], "Int64"),
                                "key": [k for _, k in ids], "n_shingles": n, "fp1": fp[0].view(np.int64),
                                "fp2": fp[1].view(np.int64), "path": path})

    return run


def _load(path: str, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of some documents of a batch, documents numbered as in the batch."""
    side = words.unpack(common.read_file(path))
    lengths = side["lengths"]
    wanted = np.zeros(len(lengths), bool)
    wanted[docs] = True
    sequence = side["sequence"][np.repeat(wanted, lengths)]
    doc, value = shingles(sequence, np.where(wanted, lengths, 0), side["hashes"])
    return doc, value


def _planes(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 3)


def _unplanes(data: bytes, dtype) -> np.ndarray:
    raw, width = zstandard.decompress(data), np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).ravel()


_CELLS = "range int, batch long, path string, cells binary, counts binary"


def _cells(bits: int, ranges: int):
    """What a batch asks of the frequency shuffle: its sorted cells, delta-coded, by range."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        common.alone("jaccard")
        docs = np.sort((frame["uid"].to_numpy() & ((1 << 22) - 1)))
        batch, path = int(frame["batch"].iloc[0]), frame["path"].iloc[0]
        _, value = _load(path, docs)
        cells, counts = np.unique(value >> _U(64 - bits), return_counts=True)
        where = ((cells >> _U(max(bits - 24, 0))) * _U(ranges)) >> _U(min(bits, 24))
        rows = [(-1, batch, path, _planes(docs.astype(np.uint32)), b"")]
        edges = np.searchsorted(where, np.arange(ranges + 1))
        for r in np.flatnonzero(np.diff(edges)):
            own = cells[edges[r]:edges[r + 1]]
            steps = np.diff(own, prepend=_U(0))
            rows.append((int(r), batch, path, _planes(steps),
                         zstandard.compress(np.minimum(counts[edges[r]:edges[r + 1]], 255).astype(np.uint8).tobytes())))
        return pd.DataFrame(rows, columns=["range", "batch", "path", "cells", "counts"])

    return run


def spread(total: int, partitions: int) -> int:
    """Ranges for so many shingles: a group of a range is gathered whole, so its size is bounded."""
    return max(partitions, -(-total // CELLS))


def _classes(frame: pd.DataFrame) -> pd.DataFrame:
    """Class of every cell of a range, for each batch: 0 in one document, 1 rare, 2 frequent."""
    own = [np.cumsum(_unplanes(x, _U), dtype=_U) for x in frame["cells"]]
    counts = [np.frombuffer(zstandard.decompress(x), np.uint8) for x in frame["counts"]]
    every, back = np.unique(np.concatenate(own), return_inverse=True)
    total = np.bincount(back, np.concatenate(counts), len(every))
    kind = ((total > 1).astype(np.uint8) + (total > FREQUENT).astype(np.uint8))[back]
    ends = np.cumsum([len(x) for x in own])
    return pd.DataFrame({"range": frame["range"], "batch": frame["batch"], "path": frame["path"],
                         "cells": [zstandard.compress(kind[e - len(x):e].tobytes()) for e, x in zip(ends, own)]})


def _bands(n: int) -> list[int]:
    """Sizes at which bands begin: partners lie in the same or a neighbouring one."""
    edges = [1]
    while edges[-1] <= n:
        edges.append(max(edges[-1] + 1, -(-4 * edges[-1] // 3)))
    return edges


def signatures(value: np.ndarray, kind: np.ndarray, edges: list[int]) -> np.ndarray:
    """Signatures of one set; see the module."""
    n = len(value)
    d = n - -(-PERCENT * n // 100)
    alone, rare, frequent = (np.sort(value[kind == k]) for k in range(3))
    if len(alone) > d:
        return np.zeros(0, _U)
    out = [mix(rare[:d + 1 - len(alone)], 5)]
    need = d + 1 - len(alone) - len(rare)
    if need > 0:
        short = False
        band = int(np.searchsorted(edges, n, "right")) - 1
        for b in (band, band - 1):
            if b < 0:
                continue
            classes = max(1, edges[b] // PER_CLASS)
            of = (mix(frequent, 7 + b) % _U(classes)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            again = np.ones(len(of), bool)
            if len(of):
                again[order[np.r_[True, of[order][1:] != of[order][:-1]]]] = False
            gain = np.cumsum(again)
            short |= not len(gain) or gain[-1] < need
            used = int(np.searchsorted(gain, need)) + 1
            token, of = frequent[:used], of[:used]
            for c in np.unique(of):
                own = token[of == c]
                i, j = np.triu_indices(len(own), 1)
                with np.errstate(over="ignore"):
                    out.append(mix(own[i] * _MIX[1] + own[j] * _MIX[2], 100 + b))
        if short:  # sets too small for pairs meet each other by single shingles
            out.append(mix(frequent[:need], 6))
    return np.unique(np.concatenate(out))


_SIGNED = "sig long, uid long, n long, members binary"


def _sign(bits: int, ranges: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        common.alone("jaccard")
        frame = frame.sort_values("range")
        batch, path = int(frame["batch"].iloc[0]), frame["path"].iloc[0]
        docs = _unplanes(frame["cells"].iloc[0], np.uint32)
        doc, value = _load(path, docs)
        cells, back = np.unique(value >> _U(64 - bits), return_inverse=True)
        kind = np.frombuffer(b"".join(zstandard.decompress(x) for x in frame["cells"].iloc[1:]), np.uint8)[back]
        n = np.bincount(doc)
        alone = np.bincount(doc[kind == 0], minlength=len(n))
        ends, edges = np.cumsum(n), _bands(int(n.max(initial=1)))
        parts = []
        for i in np.flatnonzero((n > 0) & (alone <= n - -(-PERCENT * n // 100))):
            own = slice(ends[i] - n[i], ends[i])
            found = signatures(value[own], kind[own], edges)
            if len(found):
                uid = (batch << 22) + int(i)
                parts.append(pd.DataFrame({"sig": found.view(np.int64), "uid": uid, "n": int(n[i]), "members": None}))
                parts.append(pd.DataFrame({"sig": [None], "uid": [uid], "n": [int(n[i])],
                                           "members": [value[own].tobytes()]}))
        out = pd.concat(parts) if parts else pd.DataFrame(columns=["sig", "uid", "n", "members"])
        return out.astype({"sig": "Int64", "uid": "int64", "n": "int64"})

    return run


def _similar(frames):
    for frame in frames:
        hit = []
        for a, b in zip(frame["left"], frame["right"]):
            x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            hit.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield frame.loc[hit, ["a", "b"]]


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""
    left = sets.select(F.col("uid").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("uid").alias("b"), F.col("members").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInPandas(
        _similar, "a long, b long")


def _drawn(label: str, step: int) -> Column:
    """A label under a number drawn anew in every step."""
    return F.struct(F.xxhash64(label, F.lit(step)).alias("drawn"), F.col(label).alias("label"))


def merged(labels: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """Labels after joining the components of linked nodes: contraction to drawn labels.

    ``labels`` has (uid, comp), ``links`` pairs of comps (u, v). Each step draws numbers for
    all labels, maps every label to that of the smallest number among itself and those beside
    it, and rewrites the links, until none is left. In whatever order a chain is numbered,
    about half of its labels go in every step, so the steps grow with its logarithm.
    """
    step = 0
    while True:
        links = common.staged(links.filter("u <> v").distinct(), f"{folder}/links-{step}")
        if links.isEmpty():
            return labels
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(_drawn("v", step)).alias("beside"))
        to = common.staged(least.select("u", F.least(_drawn("u", step), "beside")["label"].alias("to")),
                           f"{folder}/to-{step}")
        labels = common.staged(
            labels.join(to, F.col("comp") == F.col("u"), "left").select(
                "uid", F.coalesce("to", "comp").alias("comp")), f"{folder}/labels-{step}")
        of_v = to.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        links = links.join(to, "u").join(of_v, "v").select(F.col("to").alias("u"), F.col("to_v").alias("v"))
        step += 1


def components(signed: DataFrame, folder: str) -> DataFrame:
    """(uid, comp) of the sets that have signatures."""
    sigs = signed.filter(F.col("sig").isNotNull()).select("sig", "uid", "n")
    sets = signed.filter(F.col("sig").isNull()).select("uid", "members")
    # signatures of one set alone lead nowhere
    shared = sigs.groupBy("sig").agg(F.count("*").alias("c")).filter("c > 1").select("sig")
    sigs = common.staged(sigs.join(shared, "sig"), f"{folder}/shared")
    fits = (100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m"))

    sets = common.staged(sets.join(sigs.select("uid").distinct(), "uid", "left_semi"), f"{folder}/sets")
    labels = sets.select("uid", F.col("uid").alias("comp"))
    n = common.partitions(signed.sparkSession)

    def differing(labels):
        # by signature once: the hubs and the join with them share this exchange
        return sigs.join(labels, "uid").repartition(n, "sig")

    def link(labels, pairs, name):
        pairs = common.staged(pairs, f"{folder}/{name}-pairs")
        found = common.staged(verified(pairs, sets), f"{folder}/{name}-found")
        if found.isEmpty():
            return labels, False
        of_a = labels.select(F.col("uid").alias("a"), F.col("comp").alias("u"))
        of_b = labels.select(F.col("uid").alias("b"), F.col("comp").alias("v"))
        return merged(labels, found.join(of_a, "a").join(of_b, "b").select("u", "v"), f"{folder}/{name}"), True

    for turn in range(ROUNDS):
        rows = differing(labels)
        hub = rows.groupBy("sig").agg(
            F.min(F.struct(F.xxhash64("uid", F.lit(turn)).alias("h"), "uid", "comp", "n")).alias("hub"),
            (F.min("comp") != F.max("comp")).alias("open")).filter("open").select(
            "sig", F.col("hub.uid").alias("hub"), F.col("hub.comp").alias("hub_comp"), F.col("hub.n").alias("m"))
        met = rows.join(hub, "sig").filter((F.col("comp") != F.col("hub_comp")) & fits)
        pairs = met.select(F.least("uid", "hub").alias("a"), F.greatest("uid", "hub").alias("b")).distinct()
        labels, more = link(labels, pairs, f"star-{turn}")
        if not more:
            break
    # the rest, exactly: small signatures pair by pair, large ones block against block
    rows = differing(labels)
    open_ = rows.groupBy("sig").agg(F.count("*").alias("c"), F.min(F.struct("comp", "uid")).alias("low"),
                                    F.max("comp").alias("high")).filter("low.comp <> high")
    opened = common.staged(rows.join(open_.select("sig", "c", F.col("low.uid").alias("hub")), "sig"), f"{folder}/open")
    left = opened.filter(F.col("c") <= LIGHT).drop("c", "hub")
    right = left.select("sig", F.col("uid").alias("b"), F.col("comp").alias("comp_b"), F.col("n").alias("m"))
    rest = left.join(right, "sig").filter((F.col("uid") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & fits)
    labels = link(labels, rest.select(F.col("uid").alias("a"), "b").distinct(), "rest")[0]
    return merged(labels, dense(opened.filter(F.col("c") > LIGHT), sets, labels, f"{folder}/dense"), f"{folder}/last")


def dense(opened: DataFrame, sets: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """Links (u, v) between components whose sets meet in large signatures.

    Sets that meet, directly or through others, form a cluster, dealt into blocks. Each task
    compares two blocks by counting shared shingles, so pairs are rows nowhere and each set
    travels once per block of its cluster.
    """
    nodes = opened.select("uid").distinct().withColumn("comp", F.col("uid"))
    meet = opened.select(F.col("uid").alias("u"), F.col("hub").alias("v"))
    clusters = merged(common.staged(nodes, f"{folder}/nodes"), meet, f"{folder}/clusters").withColumnRenamed(
        "comp", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    members = (clusters.join(sizes, "cluster").withColumn("at", F.pmod(F.xxhash64("uid"), F.col("blocks")))
               .join(labels, "uid").join(sets, "uid"))
    every = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "cluster", "comp", "members", F.col("at") == F.least("at", "other"), F.least("at", "other").alias("i"),
        F.greatest("at", "other").alias("j")).toDF("cluster", "comp", "members", "lower", "i", "j")
    n = common.partitions(sets.sparkSession)
    return every.repartition(n, "cluster", "i", "j").groupBy("cluster", "i", "j").applyInPandas(
        _blocks, "u long, v long")


def _blocks(frame: pd.DataFrame) -> pd.DataFrame:
    """Component pairs that some pair of sets from two blocks (or within one) links."""
    one = frame["i"].iloc[0] == frame["j"].iloc[0]
    sides = [frame, frame] if one else [frame[frame["lower"]], frame[~frame["lower"]]]
    sets = [[np.frombuffer(x, _U) for x in side["members"]] for side in sides]
    comps = [side["comp"].to_numpy() for side in sides]
    sizes = [np.array([len(x) for x in side], np.int64) for side in sets]
    if not len(sets[0]) or not len(sets[1]):
        return pd.DataFrame({"u": [], "v": []}, dtype="int64")
    flat = [np.concatenate(side) for side in sets]
    owner = [np.repeat(np.arange(len(n)), n) for n in sizes]
    shared = np.intersect1d(flat[0], flat[1])
    both = np.zeros((len(sets[0]), len(sets[1])), np.float32)
    for at in range(0, len(shared), 8192):
        part, planes = shared[at:at + 8192], []
        for values, of, n in zip(flat, owner, sizes):
            where = np.searchsorted(part, values)
            where[where == len(part)] = 0
            hit = part[where] == values
            plane = np.zeros((len(n), len(part)), np.float32)
            plane[of[hit], where[hit]] = 1
            planes.append(plane)
        both += planes[0] @ planes[1].T
    both = both.astype(np.int64)
    link = 100 * both >= PERCENT * (sizes[0][:, None] + sizes[1] - both)
    link &= comps[0][:, None] != comps[1]
    x, y = np.nonzero(link)
    return pd.DataFrame({"u": comps[0][x], "v": comps[1][y]}).drop_duplicates()


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, first): one row per document.

    ``key`` is a hash of the text; ``first`` marks the row that stands for its component,
    the one with the smallest (doc_id, key), and rows without words, which have no
    component but themselves.
    """
    spark = docs.sparkSession
    folder, n = common.run_dir(spark, "jaccard"), common.partitions(spark)
    keyed = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("key", F.xxhash64("text"))
    rows = common.staged(keyed.select("doc_id", "key", "text").mapInPandas(_cut(folder), _ROWS), f"{folder}/rows")
    same = ["fp1", "fp2", "n_shingles"]
    with_words = rows.filter("n_shingles > 0")
    reps = common.staged(with_words.groupBy(*same).agg(
        F.min(F.struct("uid", "path")).alias("rep"), F.min(F.struct("doc_id", "key")).alias("least")).select(
        *same, "rep.uid", "rep.path", F.col("least.doc_id").alias("doc_id"), F.col("least.key").alias("key")),
        f"{folder}/reps")
    total = reps.agg(F.sum("n_shingles")).first()[0] or 1
    bits = min(64, max(30, int(total).bit_length() + 5))
    ranges = spread(int(total), n)
    by_batch = reps.select("uid", "path", F.shiftright("uid", 22).alias("batch"))
    # a few rows that stand for much work: dealt out by number, not by size
    asked = common.staged(by_batch.repartition(n, "batch").groupBy("batch").applyInPandas(_cells(bits, ranges), _CELLS), f"{folder}/cells")
    told = asked.filter("range >= 0").repartition(n, "range").groupBy("range").applyInPandas(
        _classes, "range int, batch long, path string, cells binary")
    whole = told.unionByName(asked.filter("range < 0").select("range", "batch", "path", "cells"))
    signed = common.staged(whole.repartition(n, "batch").groupBy("batch").applyInPandas(_sign(bits, ranges), _SIGNED), f"{folder}/signed")
    labels = components(signed, folder)
    placed = reps.join(labels, "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))
    least = placed.groupBy("comp").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    known = placed.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_set = placed.join(least.join(known, "comp"), "comp").select(*same, "component_id", "first")
    linked = with_words.join(of_set, same).select(
        "doc_id", "key", "n_shingles", "component_id",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))).alias("first"))
    alone = rows.filter("n_shingles = 0").select(
        "doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return linked.unionByName(alone)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    A text without words has no shingles and stays alone, as does a null text. Ids may
    repeat: each row is linked by its own text, and the component is named by the smallest
    id in it (null only if all are). An empty table gives no rows; other columns are ignored.
    """
    return grouped(docs).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, and every one without words; all columns stay.

    Rows that repeat id and text stay once, whichever of them that is. A null id is the
    largest; a null text counts as empty, and such rows stay, each id once. Other columns may
    have any name. An empty table stays empty.
    """
    first = grouped(docs).filter("first").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    # the row as one value: its columns cannot clash with the helpers
    keyed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_key"))
    held = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    kept = keyed.join(first, held, "left_semi")
    return kept.dropDuplicates(["_doc", "_text_key"]).select("_row.*")
