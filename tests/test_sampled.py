"""Sampled silhouettes against the measure over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sampled
from tidemark.operators.quality import as_points, silhouette, silhouette_values
from tidemark.operators.sampled import cluster_samples, silhouette_estimates, silhouette_of_sample

SF_DIR = "/root/testdata/sf0.1"


def points_of(spark, rows, label="string"):
    ddl = f"id long, label {label}, x array<double>"
    return as_points(spark.createDataFrame(rows, ddl), "x", "label", "id")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(8)
    rows = []
    for i in range(900):
        g = rng.choice((0, 0, 1, 1, 1, 2, 2, 2, 2, 3))
        x = [rng.gauss(g * 2, 1 + (rng.random() < 0.05) * 5) for _ in range(3)]
        rows.append((i, g, x))
    return points_of(spark, rows, "int").cache()


def values(df):
    return {r["key"]: r["silhouette"] for r in df.collect()}


@pytest.mark.parametrize("room", [4_000_000, 500])
def test_clusters_that_enter_whole_are_exact(spark, monkeypatch, room):
    monkeypatch.setattr(sampled, "SAMPLE_VALUES", room)
    rng = random.Random(2)
    rows = [(i, "abc"[i % 3], [rng.random(), rng.random() + i % 3, 1e6]) for i in range(90)]
    # A point alone, a cluster of equal points, and a repeated row.
    rows += [(90, "d", [9.0, 9.0, 1e6]), (91, "e", [5.0] * 3), (92, "e", [5.0] * 3), (92, "e", [5.0] * 3)]
    points = points_of(spark, rows)
    got = silhouette_estimates(points).collect()
    assert len(got) == len(rows) and {round(r["error"], 12) for r in got} == {0.0}
    # The exact measure wants unique keys.
    numbered = points_of(spark, [(i, g, x) for i, (_, g, x) in enumerate(rows)])
    exact = sorted(values(silhouette_values(numbered)).values())
    assert sorted(r["silhouette"] for r in got) == pytest.approx(exact, abs=1e-9)


@pytest.mark.parametrize("squared", [False, True])
def test_the_exact_mean_is_within_the_error(blobs, squared):
    exact = silhouette(blobs) if squared else sum(values(silhouette_values(blobs)).values()) / 900
    off = []
    for seed in range(6):
        row = silhouette_of_sample(blobs, 40, squared, seed).first()
        assert row["n"] == 900 and 0 < row["standard_error"] < 0.05
        assert abs(row["silhouette"] - exact) <= row["bound"] < 0.2
        off.append(abs(row["silhouette"] - exact) / row["standard_error"])
    assert sum(o < 3 for o in off) >= 5


def test_every_point_is_near_its_own_value(blobs):
    exact, got = values(silhouette_values(blobs)), silhouette_estimates(blobs, 120).collect()
    assert len(got) == 900
    off = [abs(r["silhouette"] - exact[r["key"]]) for r in got]
    assert sum(off) / 900 < 0.03
    assert sum(o <= 3 * r["error"] + 1e-9 for o, r in zip(off, got)) > 850


def test_chances_make_sums_unbiased(blobs):
    """Over many seeds the weights of a cluster's sample add up to its size."""
    sizes = {r["label"]: r["count"] for r in blobs.groupBy("label").count().collect()}
    totals = dict.fromkeys(sizes, 0.0)
    for seed in range(12):
        drawn = cluster_samples(blobs, 4, 60, seed)
        for r in drawn.groupBy("label").agg(F.sum(1 / F.col("chance")).alias("n")).collect():
            totals[r["label"]] += r["n"] / 12
    for label, n in sizes.items():
        assert totals[label] == pytest.approx(n, rel=0.1)


def test_the_same_for_any_split_of_rows(blobs):
    one, two = (values(silhouette_estimates(p, 40)) for p in (blobs, blobs.repartition(11)))
    assert one == pytest.approx(two)


def test_one_cluster_and_no_points(spark):
    points = points_of(spark, [(i, "a", [float(i)]) for i in range(5)])
    assert set(values(silhouette_estimates(points)).values()) == {0.0}
    assert silhouette_estimates(points.limit(0)).count() == 0
    assert silhouette_of_sample(points.limit(0)).first()["n"] == 0


def test_plain_distances_of_the_test_vectors(spark):
    points = as_points(spark.read.parquet(f"{SF_DIR}/embeddings.parquet"), "embedding", "label", key="vec_id")
    exact = silhouette_values(points).agg(F.avg("silhouette")).first()[0]
    row = silhouette_of_sample(points, 64).first()
    assert abs(row["silhouette"] - exact) <= row["bound"] < 0.05
    plan = silhouette_estimates(points, 64)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
