"""Recall and scored share of the vantage-point trees: python tests/llm/recall.py FOLDER [factor]

FOLDER holds embeddings.parquet. Every row whose id 20 divides is a query, as in the
registered query; shards are dealt out at random here.
"""

import glob
import os
import sys

import numpy as np
import pyarrow.dataset as ds

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pulseloom.llm import neighbours  # noqa: E402


def measured(points, shard_rows, k=20, factor=None, every=20):
    """(recall, share of all pairs that were scored, fitted factors) over several shards."""
    ids = np.arange(len(points))
    part = np.random.default_rng(1).permutation(len(points)) // shard_rows
    trees = [neighbours.grown(ids[part == p], points[part == p], k) for p in range(part.max() + 1)]
    hits = total = scored = 0
    for at in range(0, len(ids), 1024 * every):
        own = ids[at:at + 1024 * every:every]
        found = [neighbours.search(t, own, points[own], k, factor) for t in trees]
        scored += sum(f.scored for f in found)
        best = -np.sort(-np.concatenate([f.score for f in found], 1), 1)[:, :k]
        true = points[own] @ points.T
        true[np.arange(len(own)), own] = -np.inf
        kth = -np.partition(-true, k - 1, axis=1)[:, k - 1]
        hits += (best >= kth[:, None] - 1e-12).sum()
        total += best.size
    return hits / total, scored / (len(ids[::every]) * len(ids)), [float(t["factor"]) for t in trees]


if __name__ == "__main__":
    path = sys.argv[1] + "/embeddings.parquet"
    vectors = ds.dataset(glob.glob(path + "/*.parquet") or path).to_table(columns=["embedding"])["embedding"].to_pylist()
    points = np.array([v for v in vectors if v is not None], float)
    recall, share, factors = measured(points, neighbours.SHARD_ROWS, factor=float(sys.argv[2]) if sys.argv[2:] else None)
    print(f"{len(points)} vectors, {len(factors)} shards, factors {[round(f, 2) for f in factors]}: "
          f"recall {recall:.3f}, {100 * share:.1f} % of pairs scored")
