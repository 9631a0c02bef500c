"""Worst ratios of clusters by search against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import neighbours
from tidemark.operators.neighbours import Cuts, worst_ratios


def by_hand(x, s):
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    both = s[:, None] + s
    return np.divide(both, gaps, out=np.zeros(gaps.shape), where=gaps != 0).max(1)


def clusters(kind, n):
    rng = np.random.default_rng(n)
    x, s = rng.normal(size=(n, 3)) * (1, 20, 5), rng.uniform(0, 9, n)
    if kind == "equal":
        x[: n // 2] = x[0]
    if kind == "wide":
        # One cluster far off is the worst partner of all.
        x[7], s[7] = 1e4, 1e9
    if kind == "points":
        s[:] = 0
    return x, s


@pytest.mark.parametrize("kind", ["plain", "equal", "wide", "points"])
def test_search_equals_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "BLOCK_CLUSTERS", 20)
    monkeypatch.setattr(neighbours, "GROUP_CLUSTERS", 50)
    monkeypatch.setattr(neighbours, "RATIOS", 300)
    x, s = clusters(kind, 600)
    rows = [(f"c{i}", a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, s))]
    spread = spark.createDataFrame(rows, "label string, centre array<double>, mean_distance double")
    got = {r["label"]: r["worst"] for r in worst_ratios(spread, 600).collect()}
    assert got == {f"c{i}": pytest.approx(w, rel=1e-12) for i, w in enumerate(by_hand(x, s))}


def test_few_pairs_are_measured(spark, monkeypatch):
    measured = spark.sparkContext.accumulator(0)
    worst = neighbours._worst

    def counted(x, s, y, t):
        measured.add(len(x) * len(y))
        return worst(x, s, y, t)

    monkeypatch.setattr(neighbours, "_worst", counted)
    monkeypatch.setattr(neighbours, "BLOCK_CLUSTERS", 64)
    n = 8_000
    numbers = [F.rand(seed).alias(f"r{seed}") for seed in range(3)]
    spread = spark.range(n).select(
        F.col("id").alias("label"), F.array(*numbers).alias("centre"), (F.rand(3) + 5).alias("mean_distance")
    )
    assert worst_ratios(spread, n).count() == n
    assert n < measured.value < n * n / 10


def test_cuts_are_even():
    x = np.random.default_rng(1).normal(size=(5000, 2))
    cuts = Cuts(x, 64)
    sizes = np.bincount(cuts.parts_of(x))
    assert len(sizes) == cuts.parts == 64 and sizes.min() > 60 and sizes.max() < 100
    assert Cuts(np.zeros((9, 2)), 4).parts == 1
    assert Cuts(np.array([[1.0], [1.0], [1.0], [2.0]]), 4).parts == 2
