"""Exact removal of long repeated strings by suffix arrays.

Every window of ``length`` bytes is dealt out by its minimizer, the gram of smallest hash
inside it, so equal windows meet. Neighbouring windows with one minimizer travel as one
piece of text, and equal pieces only once. A task builds the suffix array of its pieces by
two-stage sorting: suffixes smaller than their successors are sorted directly, the others
are induced by scans over the buckets of first bytes. Adjacent common prefixes of at least
``length`` bytes mark the repeated windows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pulseloom.llm import common, words

LENGTH = 400
GRAM = 100
BATCH_CHARS = 3 << 20
TILE = 1 << 21  # window starts that are hashed at a time
BUCKET_BYTES = 1 << 20  # text that shares a task's suffix array, on average
HOT_BYTES = 1 << 21  # a minimizer with more text than this is compared by fingerprints of windows
_TOP = np.uint64(2**64 - 1)


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of ragged slices, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Rolling:
    """Polynomial hashes of substrings modulo 2**64 over random values of the bytes."""

    def __init__(self, seed: int, most: int):
        chosen = np.random.RandomState(seed)
        self.table = chosen.randint(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(chosen.randint(0, 2**61)) * 4 + 1
        self.up, self.down = (self._powers(b, most) for b in (base, pow(base, -1, 2**64)))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum(self.table[data] * self.up[:len(data)])])

    def of(self, sums: np.ndarray, begins, ends) -> np.ndarray:
        return _mixed((sums[ends] - sums[begins]) * self.down[begins])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _rolling(most: int) -> tuple[Rolling, Rolling]:
    key = ("rolling", most)
    if key not in words.kept():
        words.kept()[key] = Rolling(1, most), Rolling(2, most)
    return words.kept()[key]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours, from prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, _TOP)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def pieces(data: np.ndarray, edges: np.ndarray, length: int, gram: int, tile: int = TILE) -> pd.DataFrame:
    """Runs of windows that share a minimizer: ``start``, ``windows``, ``m`` and hashes ``h1``, ``h2``.

    A document is ``data[edges[i]:edges[i + 1]]``; no window leaves it. The minimizer and
    its place are functions of the window alone (the leftmost of equal grams counts).
    """
    first, second = _rolling(tile + length)
    place = np.uint64((1 << 22) - 1)
    sizes = np.diff(edges)
    inside = np.zeros(len(data) + 1, np.int8)
    long = sizes >= length
    inside[edges[:-1][long]] += 1
    inside[edges[1:][long] - length + 1] -= 1
    inside = np.cumsum(inside, dtype=np.int8).astype(bool)
    found = []
    for at in range(0, max(len(data) - length + 1, 0), tile):
        part = data[at:at + tile + length - 1]
        starts = np.flatnonzero(inside[at:at + len(part) - length + 1])
        if not len(starts):
            continue
        sums, other = first.sums(part), second.sums(part)
        grams = np.arange(len(part) - gram + 1)
        hashes = first.of(sums, slice(0, len(grams)), slice(gram, None))
        least = _least((hashes & ~place) | grams.astype(np.uint64), length - gram + 1)
        anchor = (least & place).astype(np.int64)[starts]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)]))
        begin = starts[new]
        end = starts[np.concatenate([new[1:] - 1, [len(starts) - 1]])] + length
        found.append(pd.DataFrame({
            "start": begin + at, "windows": end - begin - length + 1, "m": hashes[anchor[new]].view(np.int64),
            "h1": first.of(sums, begin, end).view(np.int64), "h2": second.of(other, begin, end).view(np.int64)}))
    if not found:
        return pd.DataFrame({c: np.array([], np.int64) for c in ("start", "windows", "m", "h1", "h2")})
    return pd.concat(found, ignore_index=True)


def suffix_order(text: np.ndarray, live: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``live`` suffixes of separated texts (0 separates), sorted by ``depth`` bytes.

    Two stages: suffixes smaller than their successors are sorted directly; each of the
    others is smaller than all of those with its first byte and follows its successor's
    place, so scanning the buckets in order finds them sorted. ``live`` must hold, with a
    position, all up to the next directly sorted suffix or separator.
    """
    n = len(text)
    step = np.sign(text[1:].astype(np.int16) - text[:-1])
    step = np.concatenate([step, [-1]])
    known = np.where(step != 0, np.arange(n), n - 1)
    rises = step[np.minimum.accumulate(known[::-1])[::-1]] > 0  # smaller than its successor
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(padded, depth)
    waiting: dict[int, list[np.ndarray]] = {}
    out = []
    for byte in np.unique(text).tolist():
        here = np.flatnonzero((text == byte) & live)
        if byte == 0:
            order = here
        else:
            direct = here[rises[here]]
            if len(direct) > 1:
                keys = np.ascontiguousarray(views[direct]).view(f"S{depth}").ravel()
                direct = direct[np.argsort(keys, kind="stable")]
            induced = waiting.pop(byte, [])
            last = np.concatenate(induced) if induced else here[:0]
            parts = [last]
            while len(last):  # runs of the byte, shortest first
                last = last - 1
                last = last[(last >= 0) & (text[last] == byte)]
                last = last[live[last]]
                parts.append(last)
            order = np.concatenate([*parts, direct])
        out.append(order)
        before = order[order > 0] - 1
        before = before[live[before] & (text[before] > byte)]
        bytes_before = text[before]
        ranks = np.argsort(bytes_before, kind="stable")
        before, bytes_before = before[ranks], bytes_before[ranks]
        cuts = np.flatnonzero(np.diff(bytes_before)) + 1
        for some in np.split(before, cuts):
            if len(some):
                waiting.setdefault(int(text[some[0]]), []).append(some)
    return np.concatenate(out) if out else np.array([], np.int64)


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each pair of suffixes, up to ``depth`` bytes."""
    out, left = np.full(len(a), depth, np.int64), np.arange(len(a))
    padded = np.concatenate([text, np.zeros(depth + 32, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(padded, 32)
    for at in range(0, depth, 32):
        if not len(left):
            break
        differ = views[a[left] + at] != views[b[left] + at]
        any_ = differ.any(1)
        out[left[any_]] = np.minimum(at + differ[any_].argmax(1), depth)
        left = left[~any_]
    return out


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Of every text, where windows start that also start elsewhere in these texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)  # UTF-8 has no 0xFF: 0 separates
    begins = np.cumsum(sizes + 1) - sizes - 1
    windows = np.zeros(len(joined), bool)
    windows[_ranges(begins, np.maximum(sizes - length + 1, 0))] = True
    # up to the next suffix that is sorted directly, or the separator
    step = np.concatenate([np.sign(joined[1:].astype(np.int16) - joined[:-1]), [-1]])
    stops = np.where((step > 0) | (joined == 0), np.arange(len(joined)), len(joined) - 1)
    stops = np.minimum.accumulate(stops[::-1])[::-1]
    last = begins + np.maximum(sizes - length, -1)
    has = last >= begins
    live = np.zeros(len(joined), bool)
    live[_ranges(begins[has], stops[last[has]] - begins[has] + 1)] = True
    order = suffix_order(joined, live, length)
    order = order[windows[order]]
    same = common_prefixes(joined, order[:-1], order[1:], length) >= length
    again = np.zeros(len(joined), bool)
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    return [np.flatnonzero(again[x:x + n]) for x, n in zip(begins.tolist(), sizes.tolist())]


def _path(folder: str, batch: int) -> str:
    return f"{folder}/batches/{batch}"


def scan(docs: DataFrame, folder: str, length: int, gram: int) -> DataFrame:
    """Stage a row for each distinct piece of a batch; the batch itself lies in a file.

    (batch, nr, m, h1, h2, size, n): ``n`` is how often the batch holds the piece. A batch
    also has one row with ``nr`` -1, so that none is forgotten.
    """

    def run(frames):
        common.alone("suffixes")
        for ids, texts in common.batches(frames, BATCH_CHARS):
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            data = np.frombuffer(b"".join(raw), np.uint8)
            edges = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
            found = pieces(data, edges, length, gram)
            found["nr"] = found.groupby(["m", "h1", "h2"], sort=False).ngroup()
            batch = uuid.uuid4().int >> 65
            common.write_file(_path(folder, batch), words.pack(
                **words.doc_ids(ids), data=data, edges=edges, start=found["start"].to_numpy(np.int64),
                windows=found["windows"].to_numpy(np.int32), nr=found["nr"].to_numpy(np.int32)))
            rows = found.groupby("nr", as_index=False).agg(
                m=("m", "first"), h1=("h1", "first"), h2=("h2", "first"), size=("windows", "first"), n=("m", "size"))
            rows["size"] += length - 1
            none = pd.DataFrame([(-1, 0, 0, 0, 0, 0)], columns=["nr", "m", "h1", "h2", "size", "n"])
            rows = pd.concat([rows, none])
            rows.insert(0, "batch", batch)
            yield rows

    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return common.staged(rows.mapInPandas(
        run, "batch long, nr int, m long, h1 long, h2 long, size int, n long"), f"{folder}/pieces")


PIECE = ("m", "h1", "h2")


def _texts(shared: DataFrame, folder: str, parallel: int) -> DataFrame:
    """The bytes of each piece, from the file of one batch that holds it."""

    def run(frames):
        common.alone("suffixes")
        kept, held = None, {}
        for frame in frames:
            out = []
            for batch, nr, size in zip(frame["batch"], frame["nr"], frame["size"]):
                if batch != kept:
                    side = words.unpack(common.read_file(_path(folder, batch)))
                    numbers, first = np.unique(side["nr"], return_index=True)
                    kept, held = batch, (side["data"], dict(zip(numbers.tolist(), side["start"][first].tolist())))
                at = held[1][nr]
                out.append(held[0][at:at + size].tobytes())
            yield frame.drop(columns=["batch", "nr", "size"]).assign(data=out)

    ordered = shared.select("batch", "nr", "size", *PIECE, "n", "hot").repartition(parallel, "batch")
    return ordered.sortWithinPartitions("batch").mapInPandas(run, "m long, h1 long, h2 long, n long, hot boolean, data binary")


def _packed(starts: np.ndarray) -> bytes:
    return starts.astype("<u4").tobytes()


def _cold(texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """Repeated windows of pieces by one suffix array for each bucket of minimizers."""

    def run(frame):
        common.alone("suffixes")
        found = repeated_windows(frame["data"].tolist(), length)
        return frame[list(PIECE)].assign(starts=[_packed(x) for x in found], n=frame["n"])

    return texts.withColumn("_bucket", F.pmod("m", F.lit(buckets))).groupBy("_bucket").applyInPandas(
        run, "m long, h1 long, h2 long, starts binary, n long").filter(
        (F.col("n") == 1) & (F.length("starts") > 0)).drop("n")


def _hot(texts: DataFrame, folder: str, length: int) -> DataFrame:
    """The same for minimizers that too much text shares: windows meet by 128-bit fingerprints."""

    def run(frames):
        common.alone("suffixes")
        for frame in frames:
            for at in range(0, len(frame), 2000):
                yield _windows(frame.iloc[at:at + 2000], length)

    rows = common.staged(texts.mapInPandas(
        run, "f1 long, f2 long, m long, h1 long, h2 long, at int, n int"), f"{folder}/windows")
    again = rows.groupBy("f1", "f2").agg(F.sum("n").alias("_n")).filter(F.col("_n") > 1).select("f1", "f2")
    met = rows.filter(F.col("n") == 1).join(again, ["f1", "f2"], "left_semi")

    def pack(frame):
        return pd.DataFrame([(*frame[list(PIECE)].iloc[0], _packed(np.unique(frame["at"].to_numpy())))],
                            columns=[*PIECE, "starts"])

    return met.groupBy(*PIECE).applyInPandas(pack, "m long, h1 long, h2 long, starts binary")


def _windows(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    data = frame["data"].tolist()
    sizes = np.array([len(x) for x in data], np.int64)
    first, second = _rolling(TILE + length)
    out = []
    for x, n in zip(data, (sizes - length + 1).tolist()):
        text, at = np.frombuffer(x, np.uint8), np.arange(n)
        out.append([h.of(h.sums(text), at, at + length).view(np.int64) for h in (first, second)])
    counts = sizes - length + 1
    rows = pd.DataFrame({"f1": np.concatenate([x[0] for x in out]), "f2": np.concatenate([x[1] for x in out])})
    for c in PIECE:
        rows[c] = np.repeat(frame[c].to_numpy(), counts)
    rows["at"] = _ranges(np.zeros(len(counts), np.int64), counts)
    rows["n"] = np.repeat(np.minimum(frame["n"].to_numpy(), 2), counts)
    return rows


def _removed(side: dict, marks: list[tuple[int, bytes | None]], length: int) -> np.ndarray:
    """Which bytes of a batch lie in repeated windows."""
    begins, ends = [np.array([], np.int64)], [np.array([], np.int64)]
    whole = np.array([nr for nr, starts in marks if starts is None], np.int64)
    hit = np.isin(side["nr"], whole)
    begins.append(side["start"][hit])
    ends.append(side["start"][hit] + side["windows"][hit] + length - 1)
    some = {nr: np.frombuffer(starts, "<u4").astype(np.int64) for nr, starts in marks if starts is not None}
    hit = np.flatnonzero(np.isin(side["nr"], np.array(list(some), np.int64)))
    for nr, start in zip(side["nr"][hit].tolist(), side["start"][hit].tolist()):
        begins.append(start + some[nr])
        ends.append(start + some[nr] + length)
    n = len(side["data"]) + 1
    depth = np.bincount(np.concatenate(begins), minlength=n) - np.bincount(np.concatenate(ends), minlength=n)
    return np.cumsum(depth)[:-1] > 0


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES,
                 hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) with the remaining bytes of every row.

    A byte goes if any string of ``length`` bytes over it also starts elsewhere, in the same
    text or another one. Equal pieces of text are recognised by 128-bit hashes.

    A null text is an empty one; texts shorter than ``length`` stay as they are. Ids may be
    null or repeat, each row is a text of its own, so a repeated row of enough bytes is
    removed in both; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder, parallel = common.run_dir(spark, "suffixes"), common.partitions(spark)
    rows = scan(docs, folder, length, gram)
    distinct = rows.filter(F.col("nr") >= 0).groupBy(*PIECE).agg(
        F.sum("n").alias("n"), F.min(F.struct("batch", "nr", "size")).alias("_at"))
    several = distinct.groupBy("m").agg(F.count("*").alias("_kinds"), F.sum("_at.size").alias("_bytes")).filter(
        F.col("_kinds") > 1)
    shared = common.staged(distinct.join(several, "m").select(
        *PIECE, "n", "_at.batch", "_at.nr", "_at.size", (F.col("_bytes") > hot_bytes).alias("hot")), f"{folder}/shared")
    amount = shared.agg(F.sum("size")).first()[0] or 0
    texts = common.staged(_texts(shared, folder, parallel), f"{folder}/texts")
    cold = _cold(texts.filter(~F.col("hot")), max(parallel, amount // bucket_bytes), length)
    hot = _hot(texts.filter("hot"), folder, length)
    whole = distinct.filter(F.col("n") > 1).select(*PIECE, F.lit(None).cast("binary").alias("starts"))
    marks = whole.unionByName(cold).unionByName(hot)
    told = rows.filter(F.col("nr") >= 0).join(marks, list(PIECE)).select("batch", "nr", "starts")
    told = told.unionByName(rows.filter(F.col("nr") < 0).select("batch", "nr", F.lit(None).cast("binary").alias("starts")))

    def done(batch: int, found: list) -> pd.DataFrame:
        side = words.unpack(common.read_file(_path(folder, batch)))
        gone, edges = _removed(side, found, length), side["edges"]
        total = np.concatenate([[0], np.cumsum(gone)])
        rises = gone & ~np.concatenate([[False], gone[:-1]])
        rises[edges[:-1][edges[:-1] < len(gone)]] |= gone[edges[:-1][edges[:-1] < len(gone)]]
        spans = np.concatenate([[0], np.cumsum(rises)])
        data = side["data"]
        kept = [data[x:y][~gone[x:y]].tobytes() for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]
        return pd.DataFrame({"doc_id": words.nullable(side), "n_bytes": np.diff(edges),
                             "n_removed": total[edges[1:]] - total[edges[:-1]],
                             "n_spans": spans[edges[1:]] - spans[edges[:-1]], "kept": kept})

    def run(frames):
        common.alone("suffixes")
        batch, found = None, []
        for frame in frames:
            for name, nr, starts in zip(frame["batch"], frame["nr"], frame["starts"]):
                if name != batch and found:
                    yield done(batch, found)
                    found = []
                batch = name
                found.append((nr, None if starts is None else bytes(starts)))
        if found:
            yield done(batch, found)

    return told.repartition(parallel, "batch").sortWithinPartitions("batch").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``deduplicated`` with a digest of the remaining bytes instead of them."""
    return deduplicated(docs, length).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
