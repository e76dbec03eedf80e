"""Vector codes against a plain version that measures every distance."""

import hashlib

import numpy as np
import pytest

from pulseloom.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int, error string, sums long"


def plain(rows, parts=4, entries=256, rounds=4):
    kept = []
    for i, x, label in rows:
        if x and None not in x and np.isfinite(x).all():
            kept.append((i, np.floor(np.array(x, np.float32).astype(float) * 1024).astype(np.int64), label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    if not kept:
        return [], []
    points = np.array([r[1] for r in kept])
    codes_, error, books = [], np.zeros(len(kept), np.int64), []
    for own in np.split(points, parts, axis=1):
        book = own[:entries].copy()
        for n in range(rounds + 1):
            far = ((own[:, None] - book) ** 2).sum(2)
            near = far.argmin(1)
            if n < rounds:
                for e in set(near.tolist()):
                    book[e] = own[near == e].sum(0) // (near == e).sum()
        codes_.append(near)
        error += far.min(1)
        books.append(book)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    label_error = {}
    for (_, _, label), e in zip(kept, error.tolist()):
        label_error[label] = label_error.get(label, 0) + e
    return [(i, "".join(f"{c[k]:02x}" for c in codes_), int(error[k]), label_error[label], digest)
            for k, (i, _, label) in enumerate(kept)], books


def order(row):
    return [(x is None, x) for x in row]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, None, 2) for r in rows], SCHEMA).repartition(3)


def clustered(n, dim=16, seed=1):
    rng = np.random.RandomState(seed)
    centres = rng.randn(40, dim)
    return (centres[rng.randint(0, 40, n)] + 0.1 * rng.randn(n, dim)).astype(np.float32).tolist()


def rows_of(n):
    rows = [(i * 3 % n, x, [None, 1, 2, 1, 1][i % 5]) for i, x in enumerate(clustered(n))]
    rows += [(n + 1, None, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, [float("inf")] + [0.0] * 15, 2),
             (n + 4, [None] + [0.0] * 15, 2), (n + 5, [], 1), (None, [0.5] * 16, None), (None, [-0.25] * 16, 3),
             (7, rows[3][1], 1), (n + 6, rows[3][1], 2), (n + 7, [0.0] * 16, 2), (n + 8, [-1e-9] * 16, 2)]
    return rows


@pytest.mark.parametrize("n", [40, 900])
def test_against_plain_version(spark, n):
    rows = rows_of(n)
    got = sorted(map(tuple, codes.report(frame(spark, rows)).collect()), key=order)
    assert got == sorted(plain(rows)[0], key=order)


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in df.collect()]
    assert sorted(map(tuple, codes.report(df).collect())) == sorted(plain(rows)[0])


def test_bounds_save_work_and_restore(spark):
    rows = [(i, x, 1) for i, x in enumerate(clustered(3000))]
    found, books, measured = codes.compress(frame(spark, rows))
    everything = 3000 * 4 * 8
    assert measured[0] == everything and all(m < 0.6 * everything for m in measured[1:]), measured
    back = {r.vec_id: r.v for r in codes.restored(found, books).collect()}
    expected, _ = plain(rows)
    for i, _, error, *_ in expected[::97]:
        whole = np.floor(np.array(rows[i][1]) * 1024)
        assert ((whole - back[i]) ** 2).sum() == error


def test_net_displacement_is_tighter():
    """An entry that goes and comes back has not moved, whatever its steps add up to."""
    there, back = np.array([[0, 0], [9, 9]]), np.array([[5, 0], [9, 9]])
    assert codes.moved([there, back, there], 1)[0].max() < 1e-6 < 5 <= codes.moved([back, there], 1)[0][0]


def test_large_components(spark):
    rows = [(i, [float(i * 1000 - 4000)] * 8, i % 2) for i in range(9)]
    assert sorted(map(tuple, codes.report(frame(spark, rows)).collect())) == sorted(plain(rows)[0])


def test_odd_lengths_and_empty(spark):
    rows = [(0, [1.0] * 8, 1), (1, [1.0] * 7, 1), (2, [2.0] * 12, 1), (3, [0.5] * 8, None)]
    got = codes.report(frame(spark, rows))
    assert sorted(r.vec_id for r in got.collect()) == [0, 3]
    assert codes.report(spark.createDataFrame([], SCHEMA)).count() == 0
