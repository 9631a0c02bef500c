"""Many k-means fits at once, against fits one by one."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import lloyd
from tidemark.operators.clusters import VECTOR, GridPoint, fit_kmeans, kmeans_grid, model_of, with_vector
from tidemark.operators.lloyd import EVERYTHING, Fit, Points, as_rows, fit_all, seed_centres, step_sums
from tidemark.params import ClusterParams

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def players(spark):
    """Points around five corners, far from the origin."""
    rng = random.Random(5)
    corners = [(1000 + 3 * i, 2000 + 5 * (i * i % 7)) for i in range(5)]
    rows = [(i, *[x + rng.gauss(0, 0.4) for x in corners[i % 5]]) for i in range(400)]
    return spark.createDataFrame(rows, "player_id long, a double, b double")


def rows_of(players, folds=4):
    return as_rows(players, FEATURES, F.pmod("player_id", F.lit(folds)), "player_id")


def matrix(players):
    found = sorted(players.collect())
    return np.array([r[1:] for r in found], float), np.array([r[0] for r in found])


def lloyd_by_hand(x, centres, max_iter, limit):
    for step in range(max_iter):
        nearest = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        new = np.array([x[nearest == j].mean(0) if (nearest == j).any() else c for j, c in enumerate(centres)])
        shift, centres = ((new - centres) ** 2).sum(), new
        if shift <= limit:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(2).min(1).sum(), step + 1


@pytest.mark.parametrize("distances", [2_000_000, 50])
def test_fits_are_those_made_one_by_one(players, monkeypatch, distances):
    monkeypatch.setattr(lloyd, "DISTANCES", distances)
    fits = [
        Fit(k, fold, start, init, 30, 1e-4)
        for k in (2, 5, 7)
        for fold in (0, 3, EVERYTHING)
        for start in (0, 1)
        for init in ("k-means++", "random")
    ]
    x, ids = matrix(players)
    with Points(rows_of(players)) as points:
        assert points.count == 400 and points.variance == pytest.approx(x.var(0).mean())
        first = seed_centres(points, fits, 42)
        found = fit_all(points, fits, 42)
    for fit, start, f in zip(fits, first, found):
        assert 1 <= len(start) <= fit.n_clusters and len(np.unique(start, axis=0)) == len(start)
        own = x[ids % 4 != fit.fold]
        # The first centres are points that the fit may see.
        assert all((own == c).all(1).any() for c in start)
        centres, cost, steps = lloyd_by_hand(own, start, 30, 1e-4 * points.variance)
        np.testing.assert_allclose(f.centres, centres, rtol=1e-9)
        assert f.steps == steps and f.cost == pytest.approx(cost, rel=1e-6)
        held = x[ids % 4 == fit.fold]
        if len(held):
            assert f.held_out == pytest.approx(((held[:, None] - f.centres) ** 2).sum(2).min(1).sum(), rel=1e-6)
        else:
            assert f.held_out is None


def test_starts_do_not_depend_on_the_split_of_the_rows(players):
    fits = [Fit(k, fold, start) for k in (3, 6) for fold in (0, EVERYTHING) for start in (0, 1, 2)]
    seen = []
    for rows in (rows_of(players), rows_of(players.repartition(13))):
        with Points(rows) as points:
            seen.append(seed_centres(points, fits, 7))
    for one, two in zip(*seen):
        np.testing.assert_allclose(one, two)
    # Starts differ, and one start has the same candidates for every k.
    assert not np.array_equal(seen[0][0], seen[0][1])


def test_starts_are_spread_out(players):
    with Points(rows_of(players)) as points:
        starts = seed_centres(points, [Fit(5, start=s) for s in range(20)], 1)
    corners = [{round((c[0] - 1000) / 3) for c in centres} for centres in starts]
    # Two corners are near each other, so not always a point of every corner; an even sample
    # has that in one of 26.
    assert sum(len(c) == 5 for c in corners) >= 12


def test_jobs_are_as_many_as_the_slowest_fit_has_steps(spark, players):
    fits = [Fit(k, fold, s, max_iter=12) for k in range(2, 8) for fold in range(4) for s in range(10)]
    group = uuid.uuid4().hex
    with Points(rows_of(players)) as points:
        spark.sparkContext.setJobGroup(group, "fits")
        found = fit_all(points, fits, 42)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setJobGroup("", "")
    seeding = 2 + lloyd.SEED_ROUNDS
    assert len(jobs) <= seeding + max(f.steps for f in found) + 1
    assert len(found) == 240 and min(f.steps for f in found) >= 1


def test_many_centres_go_in_turns(players, monkeypatch):
    fits = [Fit(k, fold) for k in (2, 3) for fold in (0, 1)]
    with Points(rows_of(players)) as points:
        whole = fit_all(points, fits)
        monkeypatch.setattr(lloyd, "CENTRE_VALUES", 20)
        assert [len(p) for p in lloyd._together(fits, 2)] == [1, 1, 1, 1]
        for one, two in zip(whole, fit_all(points, fits)):
            np.testing.assert_allclose(one.centres, two.centres)
            assert one.held_out == pytest.approx(two.held_out)


def test_odd_points(spark, players):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(6)], "player_id long, a double, b double")
    with Points(rows_of(same)) as points:
        found = fit_all(points, [Fit(3), Fit(2, 0), Fit(2, init="random")])
    assert [len(f.centres) for f in found] == [1, 1, 1] and {f.cost for f in found} == {0.0}
    # One fold holds every row: nothing to fit without it.
    one = spark.createDataFrame([(4, 1.0, 2.0), (8, 2.0, 3.0)], "player_id long, a double, b double")
    with Points(rows_of(one)) as points:
        without, whole = fit_all(points, [Fit(2, 0), Fit(2, 1)])
    assert len(without.centres) == 0 and without.held_out is None
    assert len(whole.centres) == 2 and whole.cost == 0 and whole.held_out is None
    with pytest.raises(ValueError, match="no rows"):
        Points(rows_of(players.limit(0))).measure()
    with pytest.raises(Exception, match="NULL or NaN"):
        as_rows(players.withColumn("a", F.lit(None)), FEATURES, F.lit(0), "player_id").collect()


def test_step_without_points_of_a_cluster(spark):
    df = spark.createDataFrame([(i, float(i), 0.0) for i in range(4)], "player_id long, a double, b double")
    rows = rows_of(df, 2)
    centres = [np.array([[0.0, 0.0], [99.0, 0.0], [3.0, 0.0]]), np.array([[1.5, 0.0]])]
    got = sorted(map(tuple, step_sums(rows, centres, [0, EVERYTHING]).collect()))
    assert got == [
        (0, -1, 2, 1.0, [0.0, 0.0]),
        (0, 0, 1, 1.0, [1.0, 0.0]),
        (0, 2, 1, 0.0, [3.0, 0.0]),
        (1, 0, 4, 5.0, [6.0, 0.0]),
    ]


def test_grid_is_as_good_as_single_fits(players):
    params = ClusterParams(max_n_cluster=7, cross_validations=3, n_init=5)
    grid = kmeans_grid(players, FEATURES, params)
    curve = {r["n_clusters"]: r["mean_inertia"] for r in grid.curve.collect()}
    assert sorted(curve) == [2, 3, 4, 5, 6] and grid.scores.count() == 15
    assert curve[5] < curve[4] / 2
    k = grid.model.getK()
    assert k == min(curve, key=curve.get)
    vectors = with_vector(players, FEATURES).select(VECTOR)
    alone = fit_kmeans(vectors, GridPoint(k, "k-means++", 200, 1e-4), 42, n_init=5)
    x, _ = matrix(players)
    centres = np.array(grid.model.clusterCenters())
    cost = ((x[:, None] - centres) ** 2).sum(2).min(1).sum()
    assert cost <= alone.summary.trainingCost * 1.02


def test_model_of_given_centres(spark, tmp_path):
    centres = [[1.0, 2.0], [3.0, 4.5], [0.1, 0.2]]
    point = GridPoint(len(centres), "k-means++", 77, 1e-3)
    model = model_of(spark, centres, point, 0.25)
    assert sorted(map(list, model.clusterCenters())) == sorted(centres)
    assert (model.getMaxIter(), model.getTol(), model.getInitMode()) == (77, 0.25, "k-means||")
    model.write().overwrite().save(str(tmp_path / "m"))
    assert type(model).load(str(tmp_path / "m")).getMaxIter() == 77
    with pytest.raises(ValueError, match="nothing to cluster"):
        model_of(spark, centres[:1], point, 0.25)


@pytest.mark.parametrize(("few", "near"), [(64, 131_072), (1, 131_072), (64, 1)])
def test_points_of_models_of_one_size_are_added_at_once(monkeypatch, few, near):
    monkeypatch.setattr(lloyd, "FEW_CENTRES", few)
    monkeypatch.setattr(lloyd, "NEAR_DISTANCES", near)
    rng = np.random.default_rng(few)
    x, fold = rng.normal(size=(500, 3)), rng.integers(0, 3, 500)
    centres = [rng.normal(size=(5, 3)) for _ in range(4)]
    # Of two equal centres the first one gets the points.
    centres[2][3] = centres[2][1]
    folds = [0, 1, lloyd.EVERYTHING, 2]
    models = lloyd._Models(centres, folds, np.zeros(3))
    got = models.added(0, 4, 5, x, fold).reshape(5, 4, 6)
    for i, (c, f) in enumerate(zip(centres, folds)):
        gaps = ((x[:, None] - c) ** 2).sum(2)
        place = np.where(fold == f, 5, gaps.argmin(1))
        for j in range(6):
            mine = place == j
            np.testing.assert_allclose(got[:2, i, j], [mine.sum(), gaps.min(1)[mine].sum()])
            np.testing.assert_allclose(got[2:, i, j], x[mine].sum(0), atol=1e-9)
