"""Vector codes by product quantisation; assignments are bounded by norms of sums.

Every part of a vector keeps, for each group of codebook entries, a lower bound of its
distance to all of them, with the round it was measured in. The history of the codebooks is
retained, so a bound is lowered by how far its entries have really moved since that round
(the norm of the summed steps, never more than the sum of their norms). Only groups whose
bound does not rule them out are measured again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulseloom.llm import common

PARTS, ENTRIES, ROUNDS = 4, 256, 4
GROUP = 32  # entries that share a bound
SCALE = 1024
LARGEST = 1 << 23  # components beyond cannot be measured exactly in 64 bits


def usable(df: DataFrame, parts: int = PARTS, id_col: str = "vec_id", vec_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """(vec_id, label, v) with whole-number components of the vectors that take part.

    Left out are null and empty vectors, those holding null or non-finite components, and
    those that cannot be cut into ``parts`` equal parts. Rows that repeat an id stand for
    themselves; ids and labels may be null.
    """
    x = F.col("x")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                     F.col(vec_col).cast("array<double>").alias("x"))
    rows = rows.filter(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0) & F.coalesce(fine, F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(c * SCALE).cast("long"))
    return rows.select("vec_id", "label", whole.alias("v"))


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances; in floating point only where all sums stay whole."""
    reach = int(np.abs(points).max(initial=0)) + int(np.abs(entries).max(initial=0))
    kind = float if points.shape[1] * reach ** 2 < 1 << 52 else np.int64
    x, c = points.astype(kind), entries.astype(kind)
    found = (x ** 2).sum(1)[:, None] + (c ** 2).sum(1) - 2 * (x @ c.T)
    return found.astype(np.int64)


def moved(history: list[np.ndarray], group: int = GROUP) -> np.ndarray:
    """For each earlier round and group: how far its entries are from where they were."""
    now = history[-1]
    steps = np.array([np.sqrt(((now - then) ** 2).sum(1).astype(float)) for then in history])
    return np.maximum.reduceat(steps, np.arange(0, len(now), group), axis=1) * (1 + 1e-9) + 1e-9


class State:
    """What is known of one part of some vectors: nearest entries, bounds and their rounds."""

    def __init__(self, n: int, groups: int):
        self.near = np.full(n, -1, np.int32)
        self.low = np.zeros((n, groups), np.float32)
        self.stamp = np.zeros((n, groups), np.int32)


def assign(points: np.ndarray, history: list[np.ndarray], state: State, group: int = GROUP) -> tuple[np.ndarray, int]:
    """Nearest entry of every point (ties to the lower index) into ``state``.

    Returns the squared distances and how many pairs of point and group were measured.
    """
    entries, now = history[-1], len(history) - 1
    n, scans = len(points), 0
    best, near = np.full(n, np.iinfo(np.int64).max), np.full(n, len(entries), np.int64)

    def scan(g: int, rows: np.ndarray) -> None:
        nonlocal scans
        scans += len(rows)
        found = distances(points[rows], entries[g * group:(g + 1) * group])
        at = found.argmin(1)
        least = found[np.arange(len(rows)), at]
        at = at + g * group
        wins = (least < best[rows]) | ((least == best[rows]) & (at < near[rows]))
        best[rows[wins]], near[rows[wins]] = least[wins], at[wins]
        state.low[rows, g] = np.nextafter((np.sqrt(least.astype(float)) * (1 - 1e-9)).astype(np.float32), np.float32(-1))
        state.stamp[rows, g] = now

    groups = range(-(-len(entries) // group))
    own = state.near // group
    for g in groups:  # the group of the last nearest entry, which need not be that any more
        rows = np.flatnonzero(own == g) if now else np.arange(n)
        if len(rows):
            scan(g, rows)
    if now:
        far = moved(history, group)
        for g in groups:
            bound = state.low[:, g] - far[state.stamp[:, g], g]
            rows = np.flatnonzero((own != g) & ~(bound > np.sqrt(best.astype(float)) * (1 + 1e-9)))
            if len(rows):
                scan(g, rows)
    state.near = near.astype(np.int32)
    return best, scans


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    width = values.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * width),
                                    pa.array(values.ravel(), kind))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _pass(rows: DataFrame, history: list[list[np.ndarray]], label_type: str, last: bool) -> DataFrame:
    """Assign every part to the newest codebook of its position.

    ``history[part]`` lists the codebooks of a part. Beside the rows a task gives one row of
    ``sums``: by part and entry the count and summed components, then the number of measured
    groups; in the last pass it is left out and so are the bounds.
    """
    parts, (entries, width) = len(history), history[0][0].shape
    groups = -(-entries // GROUP)

    def run(batches):
        total, scans = np.zeros((parts, entries, 1 + width), np.int64), 0
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            points = _matrix(batch.column("v"), n).astype(np.int64)
            if np.abs(points).max(initial=0) > LARGEST:
                raise ValueError(f"a component times {SCALE} exceeds {LARGEST}")
            states = [State(n, groups) for _ in range(parts)]
            if len(history[0]) > 1:
                near, low, stamp = (_matrix(batch.column(c), n) for c in ("near", "low", "stamp"))
                for p, state in enumerate(states):
                    state.near = near[:, p]
                    state.low = low[:, p * groups:(p + 1) * groups].copy()
                    state.stamp = stamp[:, p * groups:(p + 1) * groups].astype(np.int32)
            error = np.zeros(n, np.int64)
            for p, state in enumerate(states):
                own = points[:, p * width:(p + 1) * width]
                best, some = assign(own, history[p], state)
                error, scans = error + best, scans + some
                if not last:
                    total[p, :, 0] += np.bincount(state.near, minlength=entries)
                    for d in range(width):
                        total[p, :, 1 + d] += np.rint(np.bincount(state.near, own[:, d], entries)).astype(np.int64)
            near = np.stack([s.near for s in states], 1)
            columns = [batch.column("vec_id"), batch.column("label")]
            if last:
                code = ["".join(f"{i:02x}" for i in row) for row in near.tolist()]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(code), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])
                continue
            low, stamp = (np.concatenate([getattr(s, c) for s in states], 1) for c in ("low", "stamp"))
            columns += [_lists(points, pa.int64()), _lists(near, pa.int32()), _lists(low, pa.float32()),
                        _lists(stamp.astype(np.int8), pa.int8()), pa.nulls(n, pa.list_(pa.int64()))]
            label_kind.append(columns[1].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if not last and label_kind:
            sums = pa.array([np.append(total.ravel(), scans)], pa.list_(pa.int64()))
            nothing = [pa.nulls(1, k) for k in (pa.int64(), label_kind[0], pa.list_(pa.int64()), pa.list_(pa.int32()),
                                                pa.list_(pa.float32()), pa.list_(pa.int8()))]
            yield pa.RecordBatch.from_arrays([*nothing, sums], names=names)

    names, label_kind = ["vec_id", "label", "v", "near", "low", "stamp", "sums"], []
    if last:
        return rows.mapInArrow(run, f"vec_id long, label {label_type}, code string, error long")
    return rows.mapInArrow(run, f"vec_id long, label {label_type}, v array<long>, near array<int>, low array<float>, "
                                "stamp array<tinyint>, sums array<long>")


def stepped(codebook: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Every entry moves to the floor of the mean of its parts; an unused one stays."""
    used = sums[:, 0] > 0
    out = codebook.copy()
    out[used] = sums[used, 1:] // sums[used, :1]
    return out


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, **columns: str):
    """Codes of all vectors and what they mean.

    Returns ``(codes, codebooks, measured)``: rows (vec_id, label, code, error) with two
    hexadecimal digits a part, the final codebooks by part, and for each round before the
    last pass how many pairs of part and group were measured.

    ``usable`` says which rows take part; of them, those not as long as the vector of the
    smallest id are left out. With fewer than ``entries`` vectors the codebooks are that much
    smaller. Repeated vectors make repeated entries, of which the lower index wins. An empty
    table gives no codes and empty codebooks. Only codebooks and their sums, whose size the
    parameters bound, meet on the driver.
    """
    spark = df.sparkSession
    folder = common.run_dir(spark, "codes")
    rows = usable(df, parts, **columns)
    label_type = rows.schema["label"].dataType.simpleString()
    by_id = [F.asc_nulls_last("vec_id"), F.asc("v")]
    first = rows.orderBy(*by_id).limit(1).collect()
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), [], []
    dim = len(first[0].v)
    rows = rows.filter(F.size("v") == dim)
    start = np.array([r.v for r in rows.orderBy(*by_id).limit(entries).select("v").collect()], np.int64)
    history = [[x] for x in np.split(start, parts, axis=1)]
    measured, before = [], None
    for number in range(rounds):
        state = common.staged(_pass(rows, history, label_type, False), f"{folder}/{number}")
        if before is not None:
            common.discard(before)  # the new state is complete and does not need it
        before, rows = f"{folder}/{number}", state.filter(F.col("sums").isNull())
        told = state.filter(F.col("sums").isNotNull()).select(F.posexplode("sums").alias("at", "x"))
        total = np.zeros(len(history) * len(start) * (1 + dim // parts) + 1, np.int64)
        for at, x in told.groupBy("at").agg(F.sum("x")).collect():
            total[at] = x
        measured.append(int(total[-1]))
        for books, sums in zip(history, total[:-1].reshape(parts, len(start), -1)):
            books.append(stepped(books[-1], sums))
    codes = common.staged(_pass(rows, history, label_type, True), f"{folder}/codes")
    if before is not None:
        common.discard(before)
    return codes, [books[-1] for books in history], measured


def restored(codes: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(vec_id, v): the whole-number vectors that the codes stand for."""
    def run(batches):
        for batch in batches:
            index = np.array([list(bytes.fromhex(c)) for c in batch.column("code").to_pylist()], int)
            if len(index):
                v = np.concatenate([book[index[:, p]] for p, book in enumerate(codebooks)], 1)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _lists(v, pa.int64())], names=["vec_id", "v"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id long, v array<long>")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def report(embeddings: DataFrame, **options) -> DataFrame:
    """Code and error of every kept vector, the error summed over its label, and a digest of
    the codebooks. Null labels are one label; see ``compress`` for the rest."""
    codes, codebooks, _ = compress(embeddings, **options)
    told = ",".join(str(x) for book in codebooks for entry in book.tolist() for x in entry)
    per_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(per_label, _same(F.col("label"), F.col("_label"))).select(
        "vec_id", "code", "error", "label_error",
        F.lit(hashlib.sha256(told.encode()).hexdigest()).alias("codebooks_sha256"))
