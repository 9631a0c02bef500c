"""Gapless numbers and contiguous parts against sorted lists."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.operators.clusters import kmeans_grid
from tidemark.operators.ordering import contiguous_parts, exact_quantiles, order_number, with_gapless_id
from tidemark.params import ClusterParams


def test_numbers_have_no_gaps_and_survive_another_split(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(50), f"p{i}", rng.choice((None, 1.5))) for i in range(500)] + [(None, "x", 1.0)] * 2
    df = spark.createDataFrame(rows, "day int, player string, v double")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] is not None))
    for source in (df, df.repartition(13), df.coalesce(1)):
        got = sorted(map(tuple, with_gapless_id(source, ["day"], "id", 5).collect()), key=lambda r: r[-1])
        assert [r[-1] for r in got] == list(range(5, 507)) and [r[:-1] for r in got] == order
    assert with_gapless_id(df.limit(0), ["day"]).columns == [*df.columns, "battlelog_id"]
    assert with_gapless_id(df.limit(0), ["day"]).count() == 0


def test_no_window_sees_all_rows(spark):
    df = with_gapless_id(spark.range(1000), ["id"], "n")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The one window is over the counts of the ranges.
    window = plan[plan.index("Window "):]
    assert plan.count("Window ") == 1 and "HashAggregate" in window


@pytest.mark.parametrize("steps", [4096, 2])
def test_quantiles(spark, monkeypatch, steps):
    monkeypatch.setattr(ordering, "STEPS", steps)
    rng = random.Random(steps)
    values = [rng.randrange(-20, 20) for _ in range(60)] + [-(1 << 63), (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ranks = [0, 1, 30, 60, 61]
    expected = [(sorted(values)[r], sum(v < sorted(values)[r] for v in values)) for r in ranks]
    assert exact_quantiles(df, F.col("v"), ranks) == expected
    odd = [v for v in values if v % 2]
    held = [F.col("v") % 2 != 0]
    assert exact_quantiles(df, F.col("v"), [3], held) == [(sorted(odd)[3], sum(v < sorted(odd)[3] for v in odd))]
    assert exact_quantiles(df, F.col("v"), []) == []


def test_few_passes_over_tied_rows(spark, monkeypatch):
    passes = []
    refined = ordering._refined
    monkeypatch.setattr(ordering, "_refined", lambda rows, cuts: passes.append(len(cuts)) or refined(rows, cuts))
    df = spark.range(5000).withColumn("t", F.concat(F.lit("same text"), (F.col("id") % 3).cast("string")))
    got = contiguous_parts(df, "t", 9).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in got) == [555] * 4 + [556] * 5
    # The texts start alike, so one range holds them; the hash takes few passes.
    assert len(passes) <= 3


@pytest.mark.parametrize(("n", "parts"), [(100, 7), (5, 5), (3, 5), (1, 2), (0, 3)])
def test_parts_of_unique_keys(spark, n, parts):
    keys = random.Random(n).sample(range(-10**12, 10**12), n)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [f for _, f in sorted(map(tuple, contiguous_parts(df, "k", parts).collect()))]
    sizes = [n // parts + (i < n % parts) for i in range(parts)]
    assert got == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_parts_of_repeated_keys(spark):
    """A third of all rows have one key, which is in several parts."""
    rng = random.Random(4)
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(100), f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k int, t string")
    got = contiguous_parts(df, "k", 8)
    sizes = [r["count"] for r in got.groupBy("fold").count().orderBy("fold").collect()]
    assert sum(sizes) == 300 and max(sizes) - min(sizes) <= 1 and len(sizes) == 8
    bounds = got.groupBy("fold").agg(F.min("k"), F.max("k")).orderBy("fold").collect()
    assert all(a[2] <= b[1] for a, b in zip(bounds, bounds[1:]))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in contiguous_parts(df.repartition(5), "k", 8).collect()}


def test_keys_of_other_types(spark):
    days = [dt.date(1969, 12, 28) + dt.timedelta(days=i) for i in range(9)]
    df = spark.createDataFrame([(d, dt.datetime(d.year, d.month, d.day, 3, 4, 5, 678), f"é{i}", None) for i, d in enumerate(days)],
                               "d date, t timestamp, s string, n int")
    df = df.withColumn("z", F.col("t").cast("timestamp_ntz"))
    for key in ("d", "t", "z", "s"):
        numbers = [r[0] for r in df.orderBy("d").select(order_number(df, key)).collect()]
        assert numbers == sorted(set(numbers)), key
    assert contiguous_parts(df, "n", 3).select("fold").distinct().count() == 3
    with pytest.raises(ValueError, match="no order number"):
        order_number(df.withColumn("x", F.array()), "x")


def test_grid_with_contiguous_folds(spark):
    rows = [(i, float(i), float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "player_id long, a double, b double")
    params = ClusterParams(max_n_cluster=4, cross_validations=3, n_init=2, folds="contiguous")
    grid = kmeans_grid(df, ["a", "b"], params)
    scores = {(r["n_clusters"], r["fold"]): r["inertia"] for r in grid.scores.collect()}
    assert set(scores) == {(k, f) for k in (2, 3) for f in range(3)}
    # The outer thirds are far from what the others hold, the middle one is between.
    assert scores[2, 1] < min(scores[2, 0], scores[2, 2])
