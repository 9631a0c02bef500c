import math
import random

import pytest

from tidemark.operators.clusters import (
    VECTOR,
    GridPoint,
    assign_clusters,
    best_point,
    centre_lists,
    centroid_pairs,
    fit_kmeans,
    grid_points,
    held_out_inertia,
    kmeans_grid,
    mean_variance,
    with_fold,
    with_vector,
)
from tidemark.operators import quality
from tidemark.operators.quality import (
    as_points,
    cluster_metrics,
    separation,
    silhouette,
    silhouette_values,
)
from tidemark.params import ClusterParams

FEATURES = ["a", "b", "c"]
POINT = GridPoint(3, "k-means++", 50, 1e-4)


@pytest.fixture(scope="module")
def players(spark):
    """Sixty points around three far corners."""
    rng = random.Random(3)
    corners = [(0.0, 0.0, 0.0), (1.0, 0.0, 1.0), (0.0, 1.0, 1.0)]
    rows = [
        (f"p{i}", *[x + rng.gauss(0, 0.05) for x in corners[i % 3]]) for i in range(60)
    ]
    return spark.createDataFrame(rows, "player_id string, a double, b double, c double")


@pytest.fixture(scope="module")
def model(players):
    return fit_kmeans(with_vector(players, FEATURES), POINT, 42)


def test_grid_points():
    points = grid_points(ClusterParams(max_n_cluster=4, max_iter=(5, 10)))
    assert [(p.n_clusters, p.max_iter) for p in points] == [(2, 5), (2, 10), (3, 5), (3, 10)]
    with pytest.raises(ValueError):
        ClusterParams(metric="other")


def test_assignment_finds_the_corners(players, model):
    rows = assign_clusters(players, model, FEATURES)
    assert rows.columns == ["player_id", "cluster_labels", *FEATURES]
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["cluster_labels"], set()).add(int(r["player_id"][1:]) % 3)
    assert sorted(map(sorted, groups.values())) == [[0], [1], [2]]


def test_fit_is_repeatable(players, model):
    again = fit_kmeans(with_vector(players, FEATURES), POINT, 42)
    assert [list(c) for c in again.clusterCenters()] == [
        list(c) for c in model.clusterCenters()
    ]


def test_held_out_inertia(players, model):
    folded = with_fold(with_vector(players, FEATURES), "player_id", 2)
    assert {r[0] for r in folded.select("fold").distinct().collect()} == {0, 1}
    centres = centre_lists(model)
    scores = held_out_inertia(folded, [(0, 0, centres), (0, 1, centres)]).collect()
    for score in scores:
        rows = folded.filter(f"fold = {score['fold']}").collect()
        expected = sum(
            min(sum((r[f] - v) ** 2 for f, v in zip(FEATURES, c)) for c in centres)
            for r in rows
        )
        assert score["inertia"] == pytest.approx(expected)


def test_mean_variance(players):
    rows = players.collect()
    spread = 0.0
    for f in FEATURES:
        mean = sum(r[f] for r in rows) / len(rows)
        spread += sum((r[f] - mean) ** 2 for r in rows) / len(rows)
    assert mean_variance(with_vector(players, FEATURES)) == pytest.approx(spread / 3)


@pytest.mark.parametrize("metric", ["inertia", "silhouette"])
def test_grid(players, metric):
    params = ClusterParams(max_n_cluster=5, cross_validations=2, metric=metric)
    grid = kmeans_grid(players, FEATURES, params)
    curve = grid.curve.collect()
    assert [r["n_clusters"] for r in curve] == [2, 3, 4]
    assert grid.scores.count() == 6
    best = grid.best_params.first().asDict()
    if metric == "silhouette":
        assert best["n_clusters"] == "3"
    else:
        means = [r["mean_inertia"] for r in curve]
        assert means[1] < means[0]
        assert int(best["n_clusters"]) == 2 + means.index(min(means))
    assert best["init"] == "k-means++" and best["max_iter"] == "200"
    assert grid.model.getK() == int(best["n_clusters"])
    assert best_point(grid.curve, metric).first()["n_clusters"] == grid.model.getK()
    assert grid.eval_params.first()["n_clusters"] == "[2, 3, 4]"
    assert grid.eval_params.first()["random_state"] == 42


def test_centroid_pairs(players, model):
    rows = centroid_pairs(players, model, FEATURES)
    counts = {
        (r["feature_x"], r["feature_y"], r["kind"]): r["count"]
        for r in rows.groupBy("feature_x", "feature_y", "kind").count().collect()
    }
    pairs = [("a", "b"), ("a", "c"), ("b", "c")]
    assert counts == {(*p, "point"): 60 for p in pairs} | {(*p, "centroid"): 3 for p in pairs}


def test_centroid_pairs_with_noise(players, model):
    rows = centroid_pairs(players, model, FEATURES, noise=0.05)
    assert rows.filter("kind = 'centroid'").count() == 9
    clean = {(r["x"], r["y"]) for r in rows.filter("kind = 'point' AND feature_x = 'b'").collect()}
    assert clean == {(r["b"], r["c"]) for r in players.collect()}


def by_hand(points):
    """The four scores of (label, x) points, straight from their definitions."""
    groups = {}
    for label, x in points:
        groups.setdefault(label, []).append(x)
    dims = range(len(points[0][1]))

    def mean(xs):
        return [sum(x[i] for x in xs) / len(xs) for i in dims]

    centres = {g: mean(xs) for g, xs in groups.items()}
    grand = mean([x for _, x in points])
    within = sum(math.dist(x, centres[g]) ** 2 for g, x in points)
    between = sum(len(xs) * math.dist(centres[g], grand) ** 2 for g, xs in groups.items())
    n, k = len(points), len(groups)
    spread = {g: sum(math.dist(x, centres[g]) for x in xs) / len(xs) for g, xs in groups.items()}

    def ratio(a, b):
        gap = math.dist(centres[a], centres[b])
        return (spread[a] + spread[b]) / gap if gap else 0.0

    worst = [max(ratio(a, b) for b in groups if b != a) for a in groups]
    widths = []
    for g, x in points:
        if len(groups[g]) == 1:
            widths.append(0.0)
            continue
        a = sum(math.dist(x, y) for y in groups[g]) / (len(groups[g]) - 1)
        b = min(
            sum(math.dist(x, y) for y in xs) / len(xs) for h, xs in groups.items() if h != g
        )
        widths.append((b - a) / max(a, b))
    return {
        "total_inertia": within,
        "calinski_harabasz_score": (between / (k - 1)) / (within / (n - k)),
        "davies_bouldin_score": sum(worst) / k,
        "silhouette_score": sum(widths) / n,
    }


@pytest.mark.parametrize(("block_rows", "few"), [(7, 10_000), (1000, 10_000), (2, 1)])
def test_scores_by_hand(spark, monkeypatch, block_rows, few):
    monkeypatch.setattr(quality, "CENTRE_ROWS", few)
    monkeypatch.setattr(quality, "BLOCK_ROWS", block_rows)
    rng = random.Random(5)
    data = [
        (i, i % 4, [rng.random(), rng.random() + i % 4]) for i in range(40)
    ] + [(40, 9, [5.0, 5.0])]
    df = spark.createDataFrame(data, "id int, label int, x array<double>")
    points = as_points(df, "x", "label", key="id")
    got = cluster_metrics(points).first().asDict()
    widths = silhouette_values(points, block_rows)
    got["silhouette_score"] = widths.agg({"silhouette": "avg"}).first()[0]
    expected = by_hand([(label, x) for _, label, x in data])
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, abs=1e-9)
    single = silhouette_values(points, block_rows).filter("key = 40").first()
    assert single["silhouette"] == 0.0


def test_metrics_of_a_model(players, model):
    points = as_points(assign_clusters(players, model, FEATURES), FEATURES)
    row = cluster_metrics(points).first()
    assert row["silhouette_score"] == pytest.approx(silhouette(points))
    assert row["silhouette_score"] > 0.9
    assert row["total_inertia"] == pytest.approx(model.summary.trainingCost)


def test_rows_without_a_label_are_left_out(spark):
    df = spark.createDataFrame(
        [(1, [0.0]), (1, [1.0]), (2, [5.0]), (None, [9.0])], "label int, x array<double>"
    )
    assert as_points(df, "x", "label").count() == 3
    assert separation(as_points(df, "x", "label")).first()["total_inertia"] == 0.5


def test_one_cluster_is_an_error(spark):
    df = spark.createDataFrame([(1, [0.0]), (1, [1.0])], "label int, x array<double>")
    for score in ("davies_bouldin_score", "calinski_harabasz_score"):
        with pytest.raises(Exception, match="needs 2"):
            separation(as_points(df, "x", "label")).select(score).collect()


def test_equal_centres_and_tight_clusters(spark):
    df = spark.createDataFrame(
        [(1, [0.0]), (1, [2.0]), (2, [0.0]), (2, [2.0])], "label int, x array<double>"
    )
    assert separation(as_points(df, "x", "label")).first()["davies_bouldin_score"] == 0.0
    tight = spark.createDataFrame(
        [(1, [0.0]), (1, [0.0]), (2, [2.0])], "label int, x array<double>"
    )
    row = separation(as_points(tight, "x", "label")).first()
    assert (row["total_inertia"], row["calinski_harabasz_score"]) == (0.0, 1.0)


def test_near_centres_count_the_same_for_any_number_of_clusters(spark, monkeypatch):
    far = 1e8
    data = [(g, [far + c + e]) for g, c in ((1, 0.0), (2, 1e-3), (3, 4.0)) for e in (0, 2e-3)]
    points = as_points(spark.createDataFrame(data, "label int, x array<double>"), "x", "label")
    scores = []
    for few in (1_000, 1):
        monkeypatch.setattr(quality, "CENTRE_ROWS", few)
        scores.append(separation(points).first()["davies_bouldin_score"])
    assert scores[0] == pytest.approx(scores[1]) and scores[0] > 1.0
    monkeypatch.undo()
    values = [(i, i // 2, [far + v]) for i, v in enumerate((0.0, 1.0, 2.0, 50.0))]
    rows = as_points(
        spark.createDataFrame(values, "id int, label int, x array<double>"), "x", "label", "id"
    )
    sums = {(r["key"], r["other"]): r["total"] for r in quality.distance_sums(rows, 2).collect()}
    assert (sums[0, 0], sums[0, 1], sums[3, 0], sums[3, 1]) == (1.0, 52.0, 99.0, 48.0)
    with pytest.raises(ValueError, match="unique"):
        silhouette_values(rows.union(rows))


def test_copies_of_points_do_not_grow_with_their_number(spark):
    assert [quality.slice_count(n, 256, 64, 10) for n in (0, 100, 2_000, 20_000, 900_000)] == [1, 1, 8, 16, 16]
    assert quality.slice_count(2_000_000, 256, 64, 10) == 32
    assert quality.slice_count(20_000, 256, 64, 20_000) == 79
    copies = [
        quality.block_pairs(spark.range(n), "id", quality.slice_count(n, 2, 2, 3)).count() / n
        for n in (100, 1000)
    ]
    assert copies == [16, 16]


def test_slices_of_many_blocks_by_hand(spark):
    rng = random.Random(8)
    data = [(i, i % 3, [rng.random(), rng.random()]) for i in range(130)]
    points = as_points(
        spark.createDataFrame(data, "id int, label int, x array<double>"), "x", "label", "id"
    )
    got = {(r["key"], r["other"]): (r["total"], r["n"]) for r in quality.distance_sums(points, 3).collect()}
    for i, label, x in data:
        for other in range(3):
            gaps = [math.dist(x, y) for j, g, y in data if g == other and j != i]
            assert got[i, other] == (pytest.approx(sum(gaps)), len(gaps))


def test_points_are_summed_without_a_sort(spark):
    rows = spark.range(100).selectExpr("cast(id % 3 as int) label", "array(cast(id as double)) x")
    spread = quality.cluster_spread(as_points(rows, "x", "label"), 3)
    spread.collect()
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_silhouette_to_centres(spark, monkeypatch):
    data = [(1, [0.0]), (1, [2.0]), (2, [10.0]), (3, [20.0]), (3, [20.0])]
    points = as_points(spark.createDataFrame(data, "label int, x array<double>"), "x", "label")
    expected = ((10 - 1) / 10 + (8 - 1) / 8 + 1 + 1 + 1) / 5
    for few in (1_000, 2):
        monkeypatch.setattr(quality, "CENTRE_ROWS", few)
        got = quality.silhouette_to_centres(points).first()[0]
        assert got == pytest.approx(expected)


def test_more_starts_never_cost_more(players):
    vectors = with_vector(players, FEATURES)
    costs = [fit_kmeans(vectors, POINT, 7, n_init=n).summary.trainingCost for n in (1, 4)]
    assert costs[1] <= costs[0]
    assert ClusterParams().n_init == 10


def test_grid_survives_empty_and_one_cluster_folds(spark):
    rows = spark.createDataFrame(
        [(f"p{i}", float(i % 2), 0.0) for i in range(6)], "player_id string, a double, b double"
    )
    params = ClusterParams(max_n_cluster=3, cross_validations=5, metric="silhouette", n_init=1)
    grid = kmeans_grid(rows, ["a", "b"], params)
    assert 0 < grid.scores.count() <= 5
    assert all(-1 <= r["silhouette"] <= 1 for r in grid.scores.collect())
    params = ClusterParams(max_n_cluster=3, cross_validations=5, n_init=1)
    found = kmeans_grid(rows, ["a", "b"], params).scores
    folds = with_fold(rows, "player_id", 5).select("fold").distinct().count()
    assert found.count() == folds


def test_centres_are_broadcast_in_bounded_parts(players, model, monkeypatch):
    from tidemark.operators import clusters

    folded = with_fold(with_vector(players, FEATURES), "player_id", 2)
    fits = [(p, f, centre_lists(model)) for p in (0, 1) for f in (0, 1)]
    whole = sorted(map(tuple, held_out_inertia(folded, fits).collect()))
    monkeypatch.setattr(clusters, "BROADCAST_VALUES", 10)
    assert sorted(map(tuple, held_out_inertia(folded, fits).collect())) == whole
    assert len(whole) == 4


def test_vector_column(players):
    assert VECTOR in with_vector(players, FEATURES).columns


def test_grid_query_takes_the_default_starts(monkeypatch):
    from tidemark.workload import clusters

    class Seen(Exception):
        pass

    def grid(rows, names, params):
        raise Seen(params.n_init)

    monkeypatch.setattr(clusters, "_reduced", lambda spark, d: (None, None))
    monkeypatch.setattr(clusters, "kmeans_grid", grid)
    with pytest.raises(Seen) as seen:
        clusters._kmeans_grid(None, "")
    assert seen.value.args == (ClusterParams().n_init,)
