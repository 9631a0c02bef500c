"""Centroid clustering against brute force."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.centroids import cluster_vectors, largest_component


def by_hand(vectors, clusters, rounds):
    """(id, vector) pairs to sorted (id, cluster, distance), centroids, and inertia per cluster."""

    def first(item):
        return hashlib.sha256(f"2:{item[0]}".encode()).hexdigest(), item[1]

    centroids = [v for _, v in sorted((x for x in vectors if x[0] is not None), key=first)[:clusters]]

    def nearest(v):
        gaps = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return min((g, j) for j, g in enumerate(gaps))

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in vectors:
            groups[nearest(v)[1]].append(v)
        centroids = [
            [sum(column) // len(g) for column in zip(*g)] if g else c for g, c in zip(groups, centroids)
        ]
    rows = [(i, nearest(v)[1], nearest(v)[0]) for i, v in vectors]
    inertia = [sum(d for _, c, d in rows if c == j) for j in range(len(centroids))]
    return sorted(rows, key=str), centroids, inertia


def clustered(df, **settings):
    found = cluster_vectors(df, **settings)
    assigned = sorted(map(tuple, found.assigned.collect()), key=str)
    return assigned, sorted(found.centroids.collect())


@pytest.mark.parametrize(("dims", "clusters", "rounds"), [(4, 6, 3), (3, 40, 5), (2, 5, 0)])
def test_rounds_are_those_of_brute_force(spark, dims, clusters, rounds):
    rng = random.Random(dims)
    data = [(i, [rng.uniform(-2, 2) for _ in range(dims)]) for i in range(150)]
    # Ties, copies, repeated ids with one text and with two, and a row without an id.
    data += [(i, [0.5] * dims) for i in range(200, 230)]
    data += [(3, data[3][1]), (4, data[5][1]), (None, [1.0] * dims), (None, [9.0] * dims)]
    odd = [(300, None), (301, [1.0]), (302, [1.0] * dims + [2.0]), (303, [None] * dims), (309, [])]
    odd += [(304 + i, [x] + [0.0] * (dims - 1)) for i, x in enumerate([math.nan, math.inf, -math.inf, 1e38, -1e38])]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>")
    clashing = {"cluster": F.lit(1), "v": F.lit("x"), "dots": F.lit(2), "first": F.lit(3), "distance": F.lit(4)}
    df = df.withColumns(clashing)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in data]
    rows, centroids, inertia = by_hand(whole, clusters, rounds)
    got, found = clustered(df, clusters=clusters, rounds=rounds, dims=dims)
    assert got == rows
    assert [(r["cluster"], r["centroid"], r["inertia"]) for r in found] == [
        (j, c, n) for j, (c, n) in enumerate(zip(centroids, inertia))
    ]
    assert {r["total_inertia"] for r in found} == {sum(inertia)}
    assert sum(r["size"] for r in found) == len(data)
    assert (got, found) == clustered(df.repartition(7), clusters=clusters, rounds=rounds, dims=dims)


def test_fewer_vectors_than_centroids_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got, found = clustered(df, dims=2)
    assert sorted(c for _, c, _ in got) == [0, 1] and {d for _, _, d in got} == {0} and len(found) == 2
    for empty in (df.limit(0), df.withColumn("vec_id", F.lit(None).cast("long"))):
        assert clustered(empty, dims=2) == ([], [])
    # Components just within the bound, and just beyond it.
    most = largest_component(2)
    rows = [(1, [most / 256.0, -most / 256.0]), (2, [-most / 256.0, most / 256.0]), (3, [most / 256.0 + 1, 0.0])]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, _ = clustered(wide, dims=2, clusters=1, rounds=0)
    assert sorted(d for _, _, d in got) == [0, 8 * most * most]


def test_other_starts(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(10)], "vec_id long, embedding array<double>")
    _, found = clustered(df, dims=1, clusters=2, rounds=0, start=-F.col("vec_id"))
    assert [r["centroid"] for r in found] == [[9 * 256], [8 * 256]]
