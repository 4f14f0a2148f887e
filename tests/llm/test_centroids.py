"""Centroid clustering against plain Python integers."""

import hashlib
import math

import pytest

from ridemart.llm import centroids
from conftest import plan_of


def brute(rows, dims, k, rounds, seed):
    kept = []
    for name, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((name, [max(-centroids.MOST, min(centroids.MOST, math.floor(256 * x) if abs(x) < 1e15 else math.copysign(1e15, x))) for x in vector]))
    order = sorted(kept, key=lambda x: (hashlib.sha256(f"{seed}:{'' if x[0] is None else x[0]}".encode()).hexdigest(), x[1]))
    middle = [vector for _, vector in order[:k]]

    def best(vector):
        return min((sum((a - b) ** 2 for a, b in zip(vector, c)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        members = {}
        for _, vector in kept:
            members.setdefault(best(vector)[1], []).append(vector)
        for j, found in members.items():
            middle[j] = [sum(column) // len(found) for column in zip(*found)]
    chosen = [(name, *best(vector)) for name, vector in kept]

    def fitting(number):
        return number if number < 2**63 else None

    return sorted([(
        name, j, d, fitting(sum(y for _, y, c in chosen if c == j)), fitting(sum(y for _, y, _ in chosen)),
        hashlib.sha256(",".join(map(str, map(int, middle[j]))).encode()).hexdigest(),
    ) for name, d, j in chosen], key=repr)


@pytest.fixture(scope="module")
def rows():
    out = [(k, [math.sin(k * (d + 1)) / 3 for d in range(4)]) for k in range(90)]
    out += [(k, [0.25, -0.5, 0.125, 0.0]) for k in range(100, 140)] + [(100, [0.25, -0.5, 0.125, 0.0])]
    out += [(500, None), (501, []), (502, [1.0] * 3), (503, [1.0] * 5), (504, [1.0, None, 1.0, 1.0])]
    return out + [(505, [1.0, float("nan"), 1.0, 1.0]), (506, [1.0, float("-inf"), 1.0, 1.0]), (None, [0.5] * 4), (None, [-0.001] * 4)]


def frame(spark, rows):
    return spark.createDataFrame([(*row, 3) for row in rows], "vec_id long, embedding array<float>, cluster int").repartition(4)


@pytest.mark.parametrize("k, rounds", [(8, 4), (3, 0), (400, 2)])
def test_against_brute_force(spark, rows, k, rounds):
    docs = frame(spark, rows)
    exact = [(row.vec_id, row.embedding) for row in docs.collect()]
    got = centroids.cluster_vectors(docs, dims=4, k=k, rounds=rounds)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(exact, 4, k, rounds, 2)


def test_huge_components_count_as_the_most(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.1, 0.2]), (4, [3e38, -3e38])]
    docs = frame(spark, rows)
    exact = [(row.vec_id, row.embedding) for row in docs.collect()]
    got = centroids.cluster_vectors(docs, dims=2, k=2, rounds=1)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(exact, 2, 2, 1, 2)


def test_no_vector_is_kept(spark, rows):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for docs in (frame(spark, rows[:3]), frame(spark, rows).limit(0)):
        got = centroids.cluster_vectors(docs, dims=9, k=5, rounds=2)
        assert got.columns == columns and got.count() == 0


def test_stays_in_the_jvm(spark, rows):
    kept = centroids.to_integers(frame(spark, rows), "vec_id", "embedding", 4)
    plan = plan_of(kept.select(centroids.nearest(kept["_v"], [[1, 2, 3, 4], [5, 6, 7, 8]])))
    assert "Python" not in plan and "zip" in plan.lower()
