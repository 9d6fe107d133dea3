"""Centroid clustering against a plain computation with Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from marquee.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string"


def brute(rows, p):
    kept = [(i, [math.floor(p.scale * x) if abs(x) < 2**60 else int(x) * p.scale for x in v]) for i, v in rows
            if v is not None and len(v) == p.dims and all(x is not None and math.isfinite(x) for x in v)]

    def rank(r):
        return (r[0] is None, hashlib.sha256(f"{p.seed}:{r[0]}".encode()).hexdigest(), r[1])

    centres = [v for _, v in sorted(kept, key=rank)[:p.k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(p.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(centres)]
    return centres, sorted(((i, nearest(v)[1], min(nearest(v)[0], C.LONG_MAX)) for i, v in kept), key=str)


def run(spark, rows, p):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    out, centres = C.cluster(df, p=p)
    return centres, sorted(((r.vec_id, r.cluster, r.distance) for r in out.collect()), key=str), out


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    return [[rng.gauss(rng.choice([-1, 0, 2]) * spread, spread / 3) for _ in range(dims)] for _ in range(n)]


@pytest.mark.parametrize("spread", [0.02, 1.0, 1e9, 1e30])
def test_equals_plain_computation(spark, spread):
    p = C.Plan(k=5, dims=4)
    rows = list(enumerate(vectors(1, 90, 4, spread)))
    centres, got, _ = run(spark, rows, p)
    assert (centres, got) == brute(rows, p)


def test_edges(spark):
    p = C.Plan(k=4, dims=3)
    good = [(i, v) for i, v in enumerate(vectors(2, 20, 3))]
    odd = [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [1.0, float("nan"), 0.0]), (105, [float("inf"), 0.0, 0.0]), (106, [1.0] * 4)]
    same = [(7, [0.5, 0.5, 0.5])] * 15 + [(None, [0.25, 0.0, -0.1])] * 15
    rows = good + odd + same
    centres, got, _ = run(spark, rows, p)
    want = brute(rows, p)
    assert centres == want[0] and got == want[1]
    assert not {r[0] for r in got} & set(range(100, 107))


def test_ties_go_to_the_smaller_number():
    pairs = C.Bisectors([[2, 0], [0, 2], [2, 0], [-2, 0]])
    assert pairs.nearest(np.array([[1, 1], [2, 0], [0, 0], [-1, 1], [-5, 0]])).tolist() == [0, 0, 0, 1, 3]


def test_few_and_no_vectors(spark):
    p = C.Plan(k=16, dims=2)
    centres, got, _ = run(spark, [(1, [0.0, 1.0]), (2, [3.0, 1.0])], p)
    assert len(centres) == 2 and sorted(d for _, _, d in got) == [0, 0]
    assert run(spark, [(1, None)], p)[:2] == ([], [])
    out, centres = C.cluster(spark.createDataFrame([], SCHEMA), p=p)
    assert C.with_inertia(out, centres).collect() == []


def test_inertia_is_exact_and_saturates(spark):
    p = C.Plan(k=2, dims=2)
    df = spark.createDataFrame([(i, [float(i % 2) * 1e25, 0.0], "", "") for i in range(6)], SCHEMA)
    out = spark.createDataFrame([(i, i % 2, C.LONG_MAX) for i in range(4)], "vec_id long, cluster int, distance long")
    got = C.with_inertia(out, [[1, 2], [3, 4]]).collect()
    assert {(r.cluster_inertia, r.inertia) for r in got} == {(C.LONG_MAX, C.LONG_MAX)}
    assert {r.cluster: r.centroid_sha256 for r in got}[0] == hashlib.sha256(b"1,2").hexdigest()
    assert {r.inertia for r in C.with_inertia(*C.cluster(df, p=p)).collect()} == {0}
