"""Vector codes against plain Lloyd rounds."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from strainframe.llm import quantiser

SCHEMA = "vec_id long, embedding array<float>, label int, key int, code string"


def brute_force(rows: list[tuple], parts: int = 16, entries: int = 64, rounds: int = 2) -> list[tuple]:
    """One part and one entry at a time, in Python integers."""
    kept = [(k, v, label) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, list(r[1])))
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in kept]
    d = len(whole[0]) // parts
    cut = [[tuple(w[p * d : p * d + d]) for p in range(parts)] for w in whole]
    books = [[list(cut[i][p]) for i in range(min(entries, len(cut)))] for p in range(parts)]
    nearest = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            own: dict[int, list[tuple]] = {}
            for c in cut:
                own.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for i, points in own.items():
                books[p][i] = [sum(x) // len(points) for x in zip(*points, strict=True)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(e for e, _ in f) for f in found]
    total: dict = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        total[label] = total.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(k, "".join(f"{i:02x}" for _, i in f), e, total[label], sha) for (k, _, label), f, e in zip(kept, found, errors, strict=True)]


def coded(df) -> list[tuple]:
    forest = quantiser.planted(df, "vec_id", "embedding", "label")
    books = quantiser.fitted(forest)
    return [(r.key, bytes(r.code).hex(), r.error, r.label_error, books.sha256()) for r in quantiser.label_errors(quantiser.coded(forest, books)).collect()]


def same(got: list[tuple], want: list[tuple]) -> None:
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("digits", [0, 1, 5])
def test_codes_against_brute_force(spark, digits):
    rng = random.Random(digits)
    near = [[round(rng.gauss(0, 1), digits) for _ in range(32)] for _ in range(5)]
    rows = [(i * 3, [np.float32(round(x + rng.gauss(0, 0.3), digits)).item() for x in rng.choice(near)], rng.choice([None, 1, 2])) for i in range(500)]
    rows += [(7, near[0], 1), (7, near[0], 1), (7, near[1], 4), (None, near[2], None), (2, None, 1), (4, [*near[0][:31], None], 1), (5, [*near[0][:31], float("nan")], 1), (8, [*near[0][:31], float("inf")], 1)]
    rows = [(k, None if v is None else [None if x is None else np.float32(x).item() for x in v], label) for k, v, label in rows]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    same(coded(df), brute_force(rows))


def test_many_equal_vectors_and_few_entries(spark):
    rows = [(i, [0.5] * 16, 1) for i in range(300)] + [(300 + i, [float(i % 3)] * 16, None) for i in range(9)]
    same(coded(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)), brute_force(rows))
    few = rows[298:303]
    same(coded(spark.createDataFrame([(*r, 1, "x") for r in few], SCHEMA)), brute_force(few))


def test_vectors_that_cannot_be_coded_take_no_part(spark):
    rows = [(1, [0.1] * 32, 1), (2, [], 1), (3, [0.2] * 15, 1), (4, [0.2] * 16, 1), (5, [1e30] * 32, 1), (6, [0.3] * 32, 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    same(coded(df), brute_force([rows[0], rows[5]]))


def test_no_vectors(spark):
    assert coded(spark.createDataFrame([], SCHEMA)) == [] and coded(spark.createDataFrame([(1, None, 2, 1, "x")], SCHEMA)) == []


def test_trees_assign_as_comparing_all_does():
    rng = np.random.default_rng(3)
    for n, spread in ((1, 5), (40, 2), (3000, 6), (3000, 200)):
        points, entries = rng.integers(-spread, spread + 1, (n, 4)), rng.integers(-spread, spread + 1, (64, 4))
        tree = quantiser.Tree.of(quantiser.Tree.over(points).arrays(), 4)
        apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        code, error = tree.codes(entries)
        assert np.array_equal(code, apart.argmin(axis=1)) and np.array_equal(error, apart.min(axis=1))
        total, count = tree.sums(entries)
        assert np.array_equal(count, np.bincount(code, minlength=64)) and np.array_equal(total[code[0]], points[code == code[0]].sum(axis=0))
    # Near clusters, whole subtrees are assigned without a look at their points.
    points = np.repeat(entries[:4] * 1000, 500, axis=0) + rng.integers(-3, 4, (2000, 4))
    seen = sum(len(what) for level, what, _ in quantiser.Tree.over(points).assigned(entries * 1000) if level < 0)
    assert seen < len(points) / 4


def test_query_against_brute_force(spark):
    import pyarrow.parquet as pq

    from strainframe.llm.queries import op12_filtering_codes

    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{sf}/embeddings.parquet").to_pylist()]
    got = op12_filtering_codes(spark, sf)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    same([tuple(r) for r in got.collect()], brute_force(rows))
