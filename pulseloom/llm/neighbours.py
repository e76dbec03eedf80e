"""Nearest neighbours by inner product: vantage-point trees per shard.

Inner product is turned into a metric by one more coordinate (the norm missing to the
largest one of the shard), so the triangle inequality holds. A leaf is left out when
``factor`` times its least possible distance exceeds the distance of the current k-th
neighbour; factor 1 gives exact search, a larger one trades recall for work. Unless one is
given, every shard fits its own factor on a bounded sample of its rows (``PROBES``).
"""

from __future__ import annotations

import io
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from pulseloom.llm import common

SHARD_ROWS = 16384
BLOCK_ROWS = 1024
LEAF = 64
FIRST = 4  # leaves that a query visits before any is left out
PROBES = 128  # rows of a shard, spread over its ids, on which its factor is fitted
RECALL = 0.92  # share of the probes' true neighbours that the fitted factor must not leave out
LARGEST_FACTOR = 1000.0
SALTS = 16  # parts into which the join of blocks and trees of one length is split
_UNIT = float(np.finfo(float).eps)


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part.

    Left out are null, empty or all-zero vectors, those holding null or non-finite
    components, and null ids. Rows that repeat an id count once, with the smallest vector.
    """
    v = F.col("v")
    infinite = F.lit(float("inf"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.filter(F.exists(v, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def build(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and nodes (begin, end, vantage, split, lo/hi of both sides).

    A node splits at the median distance from its first point; one whose points all lie at
    the same distance, such as copies, stays a leaf however large it is.
    """
    order = np.arange(len(points))
    nodes: list[list[float]] = []
    todo = [(0, len(points), -1, 0)]
    while todo:
        begin, end, parent, side = todo.pop()
        at = len(nodes)
        nodes.append([begin, end, -1, -1, 0, 0, 0, 0, -1])
        if parent >= 0:
            nodes[parent][2 + side] = at
        if end - begin <= leaf:
            continue
        inside = order[begin:end]
        vantage = inside[0]
        far = np.sqrt(((points[inside] - points[vantage]) ** 2).sum(1))
        ranks = np.argsort(far, kind="stable")
        far = far[ranks]
        if far[0] == far[-1]:
            continue
        mid = len(far) // 2
        order[begin:end] = inside[ranks]
        nodes[at][4:] = [far[0], far[mid - 1], far[mid], far[-1], vantage]
        todo += [(begin, begin + mid, at, 0), (begin + mid, end, at, 1)]
    return order, np.array(nodes, float).reshape(-1, 9)


def _exact(queries: np.ndarray, points: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of pairs, summed from the first to the last component, so equal vectors tie."""
    out = np.zeros(len(rows))
    for d in range(points.shape[1]):
        out += queries[rows, d] * points[cols, d]
    return out


class _Best:
    """The k best (score, smaller id first) of each query so far, and how many pairs were scored."""

    def __init__(self, own: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.queries, self.k, self.scored = own, queries, k, 0
        self.norms = np.sqrt((queries ** 2).sum(1))
        self.score = np.full((len(own), k), -np.inf)
        self.ids = np.full((len(own), k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        """Matrix products tell which pairs may matter; those are summed in a fixed order."""
        self.scored += len(rows) * len(ids)
        rough = self.queries[rows] @ points.T
        error = 2 * _UNIT * (points.shape[1] + 2) * self.norms[rows] * np.sqrt((points ** 2).sum(1).max(initial=0))
        hopeful = rough >= (self.score[rows, -1] - error)[:, None]
        hopeful &= self.own[rows][:, None] != ids
        if len(ids) > self.k:  # of many, those that the k-th best of them does not beat
            others = np.where(hopeful, rough, -np.inf)
            kth = -np.partition(-others, self.k - 1, axis=1)[:, self.k - 1]
            hopeful &= rough >= (kth - 2 * error)[:, None]
        some = np.flatnonzero(hopeful.any(1))
        if not len(some):
            return
        at, cols = np.nonzero(hopeful[some])
        found = _exact(self.queries, points, rows[some][at], cols)
        width = np.bincount(at, minlength=len(some))
        place = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width)
        scores = np.full((len(some), width.max()), -np.inf)
        names = np.full(scores.shape, np.iinfo(np.int64).max)
        scores[at, place], names[at, place] = found, ids[cols]
        rows = rows[some]
        both = np.concatenate([self.score[rows], scores], 1)
        names = np.concatenate([self.ids[rows], names], 1)
        order = np.lexsort((names, -both), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(both, order, 1)
        self.ids[rows] = np.take_along_axis(names, order, 1)


def _squared(tree: dict, queries: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances that inner products stand for, and how far rounding may move them.

    A query is stretched to the length of the longest point: the order of its products stays,
    and its distances differ most where all points lie on one sphere with it.
    """
    top = float(tree["top"])
    norms = np.sqrt((queries ** 2).sum(1))
    return 2 * top - 2 * products * (np.sqrt(top) / norms)[:, None], 16 * _UNIT * (queries.shape[1] + 4) * top


def least_distances(tree: dict, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of a tree and, per query, the least distance that a point of each can have.

    A leaf inherits the bounds of all nodes above it: the distance to a vantage point less
    the range that the points below have from it.
    """
    points, nodes = tree["points"], tree["nodes"]
    inner = np.flatnonzero(nodes[:, 2] >= 0)
    squared, slack = _squared(tree, queries, queries @ points[nodes[inner, 8].astype(int)].T)
    near = dict(zip(inner.tolist(), np.sqrt(np.maximum(squared - slack, 0)).T))
    far = dict(zip(inner.tolist(), np.sqrt(np.maximum(squared + slack, 0)).T))
    leaves, bounds = [], []
    todo = [(0, np.zeros(len(queries)))]
    while todo:
        at, least = todo.pop()
        if at not in near:
            leaves.append(at)
            bounds.append(least)
            continue
        for side in (1, 0):
            lo, hi = nodes[at, 4 + 2 * side], nodes[at, 5 + 2 * side]
            todo.append((int(nodes[at, 2 + side]), np.maximum(least, np.maximum(near[at] - hi, lo - far[at]))))
    return np.array(leaves), np.array(bounds).T.reshape(len(queries), -1)


def search(tree: dict, own: np.ndarray, queries: np.ndarray, k: int, factor: float | None = None) -> _Best:
    """The k best of one tree: every query visits its ``FIRST`` most hopeful leaves, then
    all those that its k-th distance does not rule out. Without a factor the tree's own one is taken."""
    points, ids, nodes = tree["points"], tree["ids"], tree["nodes"]
    factor = float(tree["factor"]) if factor is None else factor
    best = _Best(own, queries, k)
    leaves, least = least_distances(tree, queries)

    def visit(leaf, rows):
        # a leaf of copies may be large: in steps
        for at in range(int(nodes[leaf, 0]), int(nodes[leaf, 1]), 4096):
            to = min(at + 4096, int(nodes[leaf, 1]))
            best.add(rows, ids[at:to], points[at:to])

    first = np.zeros(least.shape, bool)
    some = min(FIRST, len(leaves))
    np.put_along_axis(first, np.argpartition(least, some - 1, axis=1)[:, :some], True, 1)
    for j in np.flatnonzero(first.any(0)):
        visit(leaves[j], np.flatnonzero(first[:, j]))
    for j, leaf in enumerate(leaves):
        kth, slack = _squared(tree, queries, best.score[:, -1:])  # infinite while fewer than k are known
        rows = np.flatnonzero(~first[:, j] & (factor * least[:, j] <= np.sqrt(np.maximum(kth[:, 0] + slack, 0))))
        if len(rows):
            visit(leaf, rows)
    return best


def fitted(tree: dict, k: int) -> float:
    """The largest factor that keeps ``RECALL`` of the true neighbours of a shard's probes.

    A neighbour in a leaf of least distance l stays as long as factor * l is at most the
    distance of the k-th neighbour; so the factor is a quantile of their ratios. What a
    search really does keeps more, as its k-th distance starts above the true one.
    """
    points, ids, nodes = tree["points"], tree["ids"], tree["nodes"]
    if len(ids) < 2:
        return 1.0
    k = min(k, len(ids) - 1)
    probes = np.argsort(ids)[np.unique(np.linspace(0, len(ids) - 1, PROBES).astype(int))]
    queries = points[probes]
    rough = queries @ points.T
    rough[np.arange(len(probes)), probes] = -np.inf
    nearest = np.argpartition(-rough, k - 1, axis=1)[:, :k]
    squared, slack = _squared(tree, queries, np.take_along_axis(rough, nearest, 1).min(1)[:, None])
    kth = np.sqrt(np.maximum(squared[:, 0] + slack, 0))
    leaves, least = least_distances(tree, queries)
    leaf_of = np.empty(len(ids), int)
    for j, leaf in enumerate(leaves):
        leaf_of[int(nodes[leaf, 0]):int(nodes[leaf, 1])] = j
    bound = np.take_along_axis(least, leaf_of[nearest], 1)
    ratio = np.where(bound > 0, kth[:, None] / np.where(bound > 0, bound, 1), LARGEST_FACTOR)
    return float(np.clip(np.quantile(ratio, 1 - RECALL, method="lower"), 1, LARGEST_FACTOR))


def grown(ids: np.ndarray, points: np.ndarray, k: int) -> dict:
    """The tree of one shard with its fitted factor."""
    norm2 = (points ** 2).sum(1)
    top = float(norm2.max())
    order, nodes = build(np.column_stack([points, np.sqrt(np.maximum(top - norm2, 0))]), LEAF)
    # the vantage's own lift does not matter to a query, whose last coordinate is 0
    nodes[:, 8] = np.where(nodes[:, 8] >= 0, np.argsort(order)[nodes[:, 8].astype(int)], -1)
    tree = {"points": points[order], "ids": ids[order], "nodes": nodes, "top": np.array(top)}
    return tree | {"factor": np.array(fitted(tree, k))}


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _read(path: str) -> dict:
    with np.load(io.BytesIO(common.read_file(path))) as data:
        return {name: data[name] for name in data.files}


def _in_files(vectors: DataFrame, rows_each: int, folder: str, made) -> DataFrame:
    """Deal vectors of one length out by a hash of their ids, about ``rows_each`` together.

    ``made(ids, points)`` gives the arrays of a part, written as one file. Returns
    (dim, part, path), staged. The number of parts is a scalar, so nothing is joined.
    """
    parts = max(-(-vectors.count() // rows_each), 1)

    def write(key, frame):
        frame = frame.sort_values("vec_id")
        arrays = made(frame["vec_id"].to_numpy(), np.stack(frame["v"].to_numpy()).astype(float))
        path = f"{folder}/{key[0]}-{key[1]}-{uuid.uuid4().hex}.npz"
        common.write_file(path, _pack(**arrays))
        return pd.DataFrame({"dim": [key[0]], "part": [key[1]], "path": [path]})

    dealt = vectors.select("vec_id", "v", F.size("v").alias("dim"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("long").alias("part"))
    files = dealt.groupBy("dim", "part").applyInPandas(write, "dim int, part long, path string")
    return common.staged(files, f"{folder}/list")


def index(vectors: DataFrame, folder: str, k: int = 20) -> DataFrame:
    """Build the tree of every shard as a file; returns (dim, part, path), staged.

    Every row is indexed; only the factor of a shard comes from a sample of its rows.
    """
    return _in_files(vectors, SHARD_ROWS, folder, lambda ids, points: grown(ids, points, k))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float | None = None) -> DataFrame:
    """The k nearest of every query among all other vectors of its length.

    Both frames come from ``usable``. Blocks of queries and trees are files; what is joined
    and shuffled are pairs of their names. A shard answers with its k best, and the best k
    of those remain. Ties go to smaller ids. ``factor`` 1 is exact; None takes what each
    shard has fitted for these k.
    """
    spark = vectors.sparkSession
    folder = common.run_dir(spark, "trees")
    trees = index(vectors, f"{folder}/trees", k).select("dim", F.col("path").alias("tree"))
    blocks = _in_files(queries, BLOCK_ROWS, f"{folder}/blocks", lambda ids, points: {"ids": ids, "points": points})
    blocks = blocks.select("dim", F.col("path").alias("block"), F.pmod(F.xxhash64("path"), F.lit(SALTS)).alias("salt"))
    salted = trees.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))

    def answer(frames):
        common.alone("trees")
        held = common.kept().setdefault("tree", {})  # the last tree this worker has read
        for frame in frames:
            for path, block in zip(frame["tree"], frame["block"]):
                if path not in held:
                    held.clear()
                    held[path] = _read(path)
                asked = _read(block)
                found = search(held[path], asked["ids"], asked["points"], k, factor)
                real = np.isfinite(found.score)
                yield pd.DataFrame({"query_id": np.repeat(asked["ids"], real.sum(1)), "vec_id": found.ids[real],
                                    "score": found.score[real]})

    # a stated query set against all shards, in blocks
    pairs = blocks.join(salted, ["dim", "salt"]).select("tree", "block")
    pairs = pairs.repartition(common.partitions(spark), "tree", "block").sortWithinPartitions("tree")
    asked = pairs.mapInPandas(answer, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return asked.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame, every: int = 20, k: int = 20, factor: float | None = None) -> DataFrame:
    """The k nearest of every row whose id ``every`` divides, among all other rows.

    Vectors that are null, empty, all zero or hold null or non-finite components, and rows
    without an id, take no part, neither as queries nor as candidates. Rows that repeat an id
    count as one, with the smallest vector. Equal scores are ranked by id, the smaller first.
    Only vectors of one length are compared; with fewer than k candidates all are returned.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    vectors = common.staged(usable(embeddings), common.run_dir(embeddings.sparkSession, "vectors"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % every == 0), k, factor)
