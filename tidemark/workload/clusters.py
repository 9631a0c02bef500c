"""Profile features, k-means and cluster quality."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions.numbers import squared_distance
from tidemark.operators.clusters import (
    VECTOR,
    GridPoint,
    assign_clusters,
    assign_to_centres,
    best_point,
    centre_lists,
    centroid_pairs,
    fit_kmeans,
    held_out_inertia,
    kmeans_grid,
    score_curve,
    with_vector,
)
from tidemark.operators.features import (
    anova_table,
    prepare_profiles,
    scale_max_abs,
    select_features,
    top_features,
)
from tidemark.operators.lloyd import EVERYTHING, as_rows, step_sums
from tidemark.operators.ordering import contiguous_parts
from tidemark.operators.quality import (
    as_points,
    cluster_count,
    cluster_metrics,
    cluster_spread,
    separation,
    silhouette,
    silhouette_to_centres,
    silhouette_values,
)
from tidemark.operators.sampled import silhouette_of_sample
from tidemark.operators.shape import count_parity, null_profile, union_by_position
from tidemark.params import ClusterParams
from tidemark.sources.layout import shared_folder
from tidemark.sources.readers import read_parquet
from tidemark.sources.writers import write_parquet
from tidemark.workload.views import FEATURES, profiles, table

POINT = GridPoint(4, "k-means++", 200, 1e-4)
SEED = 42


def _profile_prepare(spark, d):
    # Customers in the raw profile schema, as text where the schema will cast.
    customers = table(spark, d, "customer")
    number = F.col("c_custkey").cast("string")
    cents = F.floor(F.col("c_acctbal") * 100).cast("string")
    nothing = F.lit(None)
    raw = customers.select(
        number.alias("player_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("nameColor"),
        cents.alias("trophies"),
        F.col("c_nationkey").alias("highestTrophies"),
        F.col("c_acctbal").alias("highestPowerPlayPoints"),
        F.col("c_nationkey").cast("string").alias("expLevel"),
        number.alias("expPoints"),
        (F.col("c_acctbal") > 0).alias("isQualifiedFromChampionshipChallenge"),
        F.length("c_name").alias("3vs3Victories"),
        F.length("c_mktsegment").alias("soloVictories"),
        nothing.alias("duoVictories"),
        nothing.alias("bestRoboRumbleTime"),
        nothing.alias("bestTimeAsBigBrawler"),
        nothing.alias("brawlers"),
        F.col("c_nationkey").alias("icon_id"),
        nothing.alias("club_tag"),
        nothing.alias("club_name"),
    )
    return prepare_profiles(raw)


def _null_profile(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    documents = table(spark, d, "labels").select(
        F.col("doc_id").alias("c_custkey"), "quality", "toxic"
    )
    customers = table(spark, d, "customer")
    joined = customers.join(orders, "c_custkey", "left").join(
        documents, "c_custkey", "left"
    )
    return null_profile(joined)


def _scaled(spark, d):
    return scale_max_abs(profiles(spark, d), ["player_id", "segment"], FEATURES)


def _scale_max_abs(spark, d):
    rows = _scaled(spark, d)
    return rows.select(
        "player_id", "segment", *[F.round(c, 6).alias(c) for c in FEATURES]
    )


def _anova_f(spark, d):
    rows = anova_table(_scaled(spark, d), FEATURES, "segment")
    return rows.select("position", "feature", F.round("f_score", 6).alias("f_score"))


def _top_k_features(spark, d):
    rows = top_features(anova_table(_scaled(spark, d), FEATURES, "segment"), 4)
    return rows.select("rank", "feature", F.round("f_score", 6).alias("f_score"))


def _feature_count_parity(spark, d):
    return count_parity(table(spark, d, "customer"), _scaled(spark, d))


def _points(spark, d):
    return as_points(table(spark, d, "embeddings"), "embedding", "label", key="vec_id")


def _cluster_spread(spark, d):
    points = _points(spark, d).drop("key")
    rows = cluster_spread(points, cluster_count(points))
    return rows.select(
        "label",
        "n",
        F.round("sse", 6).alias("sse"),
        F.round("mean_distance", 6).alias("mean_distance"),
    )


def _separation(name):
    def query(spark, d):
        rows = separation(_points(spark, d).drop("key"))
        return rows.select(F.round(name, 6).alias(name))

    return query


def _silhouette_squared(spark, d):
    value = silhouette(_points(spark, d))
    return table(spark, d, "embeddings").agg(
        F.count("*").alias("n"),
        F.round(F.lit(value), 6).alias("silhouette"),
    )


def _silhouette_exact(spark, d):
    rows = silhouette_values(_points(spark, d), block_rows=256)
    return rows.select("key", "label", F.round("silhouette", 6).alias("silhouette"))


def _silhouette_sampled(spark, d):
    """From samples of about 32 points a cluster: every point is scored, and the exact mean
    is within the bound. With squared distances the exact one takes linear time."""
    points = _points(spark, d)
    row = silhouette_of_sample(points, 32, squared=True)
    off = F.abs(F.col("silhouette") - F.lit(silhouette(points)))
    return row.select(
        "n",
        (F.col("standard_error") > 0).alias("is_sampled"),
        (off <= F.col("bound")).alias("is_within"),
        (F.col("bound") < 0.05).alias("is_narrow"),
    )


def _stored_scaled(spark, d):
    """Scaled features as a stored table: model fits and scores read it many times."""
    path = shared_folder(spark)
    write_parquet(_scaled(spark, d), path)
    return read_parquet(spark, path)


def _reduced(spark, d):
    return select_features(_stored_scaled(spark, d), "segment", 4, features=FEATURES)


def fitted(spark, d):
    rows, names = _reduced(spark, d)
    vectors = with_vector(rows, names).select(VECTOR)
    model = fit_kmeans(vectors, POINT, SEED)
    return rows, names, model


def _kmeans_assign(spark, d):
    rows = assign_to_centres(_scaled(spark, d), CENTRES[1], FEATURES)
    return rows.select("player_id", "cluster_labels")


def _kmeans_grid(spark, d):
    """What holds for any right grid search, over the whole default grid."""
    rows, names = _reduced(spark, d)
    grid = kmeans_grid(rows, names, ClusterParams())
    keys = ["n_clusters", "init", "max_iter", "tol"]
    means = grid.scores.groupBy(*keys).agg(F.avg("inertia").alias("mean"))
    off = F.abs(F.col("mean") - F.col("mean_inertia")) > 1e-9
    curve = grid.curve.join(means, keys, "full").agg(
        F.count("*").alias("settings"),
        F.count_if(off | off.isNull()).alias("wrong_means"),
        F.min_by("n_clusters", F.struct("mean_inertia", "n_clusters")).alias("best_k"),
    )
    chosen = grid.best_params.select(F.col("n_clusters").cast("int").alias("chosen_k"))
    facts = F.struct(
        F.lit(grid.scores.count()).alias("n_scores"),
        F.lit(grid.model.getK()).alias("refit_k"),
        F.lit(grid.eval_params.first()["n_clusters"]).alias("exported"),
    )
    return curve.select(
        "settings",
        facts["n_scores"].alias("scores"),
        "wrong_means",
        (F.col("best_k") == chosen.scalar()).alias("best_is_least"),
        (F.col("best_k") == facts["refit_k"]).alias("refit_is_best"),
        facts["exported"].alias("exported_k"),
    )


def _kmeans_step(spark, d):
    """One step of several models over all customers: two sets of centres, each without each
    of the folds and on all rows."""
    fold = F.pmod("player_id", F.lit(FOLDS))
    rows = as_rows(_scaled(spark, d), FEATURES, fold, "player_id")
    models = [(np.array(c), f) for c in CENTRES for f in (*range(FOLDS), EVERYTHING)]
    sums = step_sums(rows, *zip(*models))
    named = {c: F.round(F.get("sums", F.lit(i)), 5).alias(c) for i, c in enumerate(FEATURES)}
    own = F.col("cluster") >= 0
    return sums.select(
        "model",
        "cluster",
        "n",
        F.round("cost", 5).alias("cost"),
        *[F.when(own, v).alias(c) for c, v in named.items()],
    )


def _contiguous_folds(spark, d):
    rows = contiguous_parts(table(spark, d, "customer"), "c_custkey", 7)
    return rows.select("c_custkey", "fold")


def _contiguous_folds_of_texts(spark, d):
    """Sizes and bounds of the parts by a date that many rows share, and by a text."""
    lines = table(spark, d, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    parts = [
        contiguous_parts(lines, key, 9).groupBy("fold").agg(
            F.lit(key).alias("key"),
            F.count("*").alias("n"),
            F.min(key).cast("string").alias("first"),
            F.max(key).cast("string").alias("last"),
        )
        for key in ("l_shipdate", "l_returnflag")
    ]
    return union_by_position(parts)


def _kmeans_starts(spark, d):
    """Ten starts cost no more than one."""
    rows, names = _reduced(spark, d)
    vectors = with_vector(rows, names).select(VECTOR)
    costs = [
        fit_kmeans(vectors, POINT, SEED, n_init=n).summary.trainingCost for n in (1, 10)
    ]
    return rows.agg(
        F.count("*").alias("n_players"),
        F.lit(costs[1] <= costs[0]).alias("ten_not_above_one"),
    )


def _kmeans_best(spark, d):
    """The best setting of a curve of made-up scores of the customers."""
    scores = table(spark, d, "customer").groupBy(
        (F.col("c_nationkey") % 11 + 2).cast("int").alias("n_clusters"),
        F.lit("k-means++").alias("init"),
        F.lit(200).alias("max_iter"),
        F.lit(1e-4).alias("tol"),
        (F.col("c_custkey") % 5).cast("int").alias("fold"),
    )
    scores = scores.agg(F.sum(F.abs("c_acctbal")).alias("inertia"))
    best = best_point(score_curve(scores))
    return best.withColumn("mean_inertia", F.round("mean_inertia", 6))


def _kmeans_metrics(spark, d):
    row = cluster_metrics(_points(spark, d).drop("key"))
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


def _centroid_pairs(spark, d):
    """Rows per pair of features and kind, and centroids that are not the model's."""
    rows, names, model = fitted(spark, d)
    found = centroid_pairs(rows, model, names)
    own = spark.createDataFrame(
        [
            (names[i], names[j], label, centre[i], centre[j])
            for i, j in combinations(range(len(names)), 2)
            for label, centre in enumerate(centre_lists(model))
        ],
        "feature_x string, feature_y string, cluster_labels int, x double, y double",
    )
    shared = ["feature_x", "feature_y", "cluster_labels", "x", "y"]
    wrong = found.filter("kind = 'centroid'").join(own, shared, "left_anti").count()
    place = {name: i for i, name in enumerate(names)}
    numbers = F.create_map(*[F.lit(v) for item in place.items() for v in item])
    counted = found.groupBy(
        numbers[F.col("feature_x")].alias("first"),
        numbers[F.col("feature_y")].alias("second"),
        "kind",
    )
    return counted.agg(F.count("*").alias("n")).withColumn("wrong", F.lit(wrong))


def _davies_bouldin_many(spark, d):
    """More clusters than one array of centres holds, from a key of a table."""
    features = (F.col("l_quantity"), F.col("l_orderkey") % 1009, F.col("l_suppkey") % 97)
    parts = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("label"), F.array(*[c.cast("double") for c in features]).alias("x")
    )
    row = separation(as_points(parts, "x", "label"))
    return row.select(F.round("davies_bouldin_score", 6).alias("davies_bouldin_score"))


def _silhouette_to_centres(spark, d):
    row = silhouette_to_centres(_points(spark, d).drop("key"))
    return row.select(F.round("silhouette_to_centres", 6).alias("silhouette_to_centres"))


def _kmeans_properties(spark, d):
    """What holds for any k-means assignment: all rows labelled, every label used, no row
    nearer to another centre."""
    rows, names, model = fitted(spark, d)
    x = F.array(*[F.col(c) for c in names])
    centres = [F.array(*[F.lit(v) for v in c]) for c in centre_lists(model)]
    gaps = F.array(*[squared_distance(x, c) for c in centres])
    labelled = assign_clusters(rows, model, names)
    own = F.get(gaps, F.col("cluster_labels"))
    return labelled.agg(
        F.count("cluster_labels").alias("n_players"),
        F.count_distinct("cluster_labels").alias("n_clusters"),
        F.count_if(own > F.array_min(gaps) + 1e-9).alias("n_misplaced"),
    )


# Fixed centres, one list per grid point, to score without a fitted model.
CENTRES = (
    [[0.0] * len(FEATURES), [0.5] * len(FEATURES)],
    [[0.1] * len(FEATURES), [0.4] * len(FEATURES), [0.9] * len(FEATURES)],
)
FOLDS = 3


def _held_out_inertia(spark, d):
    fold = F.pmod("player_id", F.lit(FOLDS)).cast("int")
    folded = with_vector(_scaled(spark, d), FEATURES).withColumn("fold", fold)
    fitted = [(p, f, c) for p, c in enumerate(CENTRES) for f in range(FOLDS)]
    rows = held_out_inertia(folded, fitted)
    return rows.withColumn("inertia", F.round("inertia", 6))


def _centroid_pair_points(spark, d):
    rows = _stored_scaled(spark, d)
    model = fit_kmeans(with_vector(rows, FEATURES).select(VECTOR), POINT, SEED)
    points = centroid_pairs(rows, model, FEATURES).filter("kind = 'point'")
    return points.select(
        "feature_x", "feature_y", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")
    )


# ------------------------------------------------------------------------------- SQL

_PROFILES = """orders_of AS (
    SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend,
           max(o_totalprice) AS top_order, avg(o_totalprice) AS mean_order,
           count(DISTINCT date_trunc('month', o_orderdate)) AS active_months
    FROM orders GROUP BY o_custkey
),
profiles AS (
    SELECT c_custkey AS player_id, c_mktsegment AS segment, c_acctbal AS balance,
           coalesce(n_orders, 0) AS n_orders, coalesce(spend, 0) AS spend,
           coalesce(top_order, 0) AS top_order, coalesce(mean_order, 0) AS mean_order,
           coalesce(active_months, 0) AS active_months
    FROM customer LEFT JOIN orders_of ON c_custkey = o_custkey
),
scaled AS (
    SELECT player_id, segment, """ + ", ".join(
    f"{c} / max(abs({c})) OVER () AS {c}" for c in FEATURES
) + """
    FROM profiles
)"""

_ANOVA = f"""WITH {_PROFILES},
long AS (
    {" UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS feature, segment, {c} AS x FROM scaled"
        for i, c in enumerate(FEATURES)
    )}
),
means AS (
    SELECT *, avg(x) OVER (PARTITION BY position) AS grand,
           avg(x) OVER (PARTITION BY position, segment) AS mean
    FROM long
),
scores AS (
    SELECT position, feature,
           (sum((mean - grand) * (mean - grand)) / (count(DISTINCT segment) - 1))
           / (sum((x - mean) * (x - mean)) / (count(*) - count(DISTINCT segment)))
               AS f_score
    FROM means GROUP BY position, feature
)"""

_CENTRES = """points AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
),
dims AS (
    SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM points
),
centre_dims AS (
    SELECT label, i, avg(v) AS c, count(*) AS n FROM dims GROUP BY label, i
),
grand_dims AS (SELECT i, avg(v) AS g FROM dims GROUP BY i),
own AS (
    SELECT vec_id, label, sum((v - c) * (v - c)) AS d2
    FROM dims JOIN centre_dims USING (label, i) GROUP BY vec_id, label
),
spread AS (
    SELECT label, count(*) AS n, sum(d2) AS sse, avg(sqrt(d2)) AS mean_distance
    FROM own GROUP BY label
)"""

_PAIRS = """points AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
),
sums AS (
    SELECT a.vec_id, a.label, b.label AS other, count(*) AS n,
           avg({distance}) AS mean
    FROM points a JOIN points b ON a.vec_id <> b.vec_id
    GROUP BY a.vec_id, a.label, b.label
),
sides AS (
    SELECT vec_id, label, max(mean) FILTER (label = other) AS a,
           min(mean) FILTER (label <> other) AS b
    FROM sums GROUP BY vec_id, label
)"""

QUERIES = {
    "profile_prepare": _profile_prepare,
    "null_profile": _null_profile,
    "scale_max_abs": _scale_max_abs,
    "feature_count_parity": _feature_count_parity,
    "anova_f": _anova_f,
    "top_k_features": _top_k_features,
    "cluster_spread": _cluster_spread,
    "cluster_inertia": _separation("total_inertia"),
    "calinski_harabasz": _separation("calinski_harabasz_score"),
    "davies_bouldin": _separation("davies_bouldin_score"),
    "silhouette_squared": _silhouette_squared,
    "silhouette_exact": _silhouette_exact,
    "silhouette_sampled": _silhouette_sampled,
    "kmeans_assign": _kmeans_assign,
    "kmeans_grid": _kmeans_grid,
    "kmeans_best": _kmeans_best,
    "kmeans_starts": _kmeans_starts,
    "kmeans_step": _kmeans_step,
    "contiguous_folds": _contiguous_folds,
    "contiguous_folds_ties": _contiguous_folds_of_texts,
    "davies_bouldin_many": _davies_bouldin_many,
    "silhouette_to_centres": _silhouette_to_centres,
    "kmeans_metrics": _kmeans_metrics,
    "kmeans_properties": _kmeans_properties,
    "held_out_inertia": _held_out_inertia,
    "centroid_pairs": _centroid_pairs,
    "centroid_pair_points": _centroid_pair_points,
}

ORACLES = {
    "profile_prepare": """SELECT CAST(c_custkey AS VARCHAR) AS player_id,
        CAST(floor(c_acctbal * 100) AS BIGINT) AS trophies,
        CAST(c_nationkey AS BIGINT) AS "highestTrophies",
        CAST(c_nationkey AS BIGINT) AS "expLevel",
        c_custkey AS "expPoints",
        CAST(length(c_name) AS BIGINT) AS "3vs3Victories",
        CAST(length(c_mktsegment) AS BIGINT) AS "soloVictories",
        CAST(NULL AS BIGINT) AS "duoVictories",
        CAST(NULL AS BIGINT) AS "bestRoboRumbleTime"
        FROM customer""",
    "null_profile": """WITH joined AS (
            SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, o_orderkey,
                   o_totalprice, quality, toxic
            FROM customer LEFT JOIN orders ON c_custkey = o_custkey
            LEFT JOIN labels ON c_custkey = doc_id
        ) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM joined"
        for c in (
            "c_custkey",
            "c_name",
            "c_nationkey",
            "c_acctbal",
            "c_mktsegment",
            "o_orderkey",
            "o_totalprice",
            "quality",
            "toxic",
        )
    ),
    "scale_max_abs": f"WITH {_PROFILES} SELECT player_id, segment, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)
    + " FROM scaled",
    "feature_count_parity": """SELECT count(*) AS rows_before, count(*) AS rows_after,
        TRUE AS equal FROM customer""",
    "anova_f": f"""{_ANOVA}
        SELECT CAST(position AS INT) AS position, feature, round(f_score, 6) AS f_score
        FROM scores""",
    "top_k_features": f"""{_ANOVA}
        SELECT CAST(row_number() OVER (ORDER BY f_score DESC, position DESC) AS INT)
                   AS rank, feature, round(f_score, 6) AS f_score
        FROM scores QUALIFY rank <= 4""",
    "cluster_spread": f"""WITH {_CENTRES}
        SELECT label, n, round(sse, 6) AS sse, round(mean_distance, 6) AS mean_distance
        FROM spread""",
    "cluster_inertia": f"""WITH {_CENTRES}
        SELECT round(sum(sse), 6) AS total_inertia FROM spread""",
    "calinski_harabasz": f"""WITH {_CENTRES},
        between_part AS (
            SELECT sum(n * (c - g) * (c - g)) AS b
            FROM centre_dims JOIN grand_dims USING (i)
        ),
        within_part AS (SELECT sum(sse) AS w, sum(n) AS n, count(*) AS k FROM spread)
        SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz_score
        FROM between_part, within_part""",
    "davies_bouldin": f"""WITH {_CENTRES},
        gaps AS (
            SELECT a.label AS la, b.label AS lb, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS d
            FROM centre_dims a JOIN centre_dims b ON a.i = b.i AND a.label <> b.label
            GROUP BY a.label, b.label
        ),
        worst AS (
            SELECT la, max((s.mean_distance + t.mean_distance) / d) AS r
            FROM gaps JOIN spread s ON s.label = la JOIN spread t ON t.label = lb
            GROUP BY la
        )
        SELECT round(avg(r), 6) AS davies_bouldin_score FROM worst""",
    "kmeans_assign": f"""WITH {_PROFILES},
        gaps AS (
            SELECT player_id, [{
        ", ".join(f"list_distance([{', '.join(FEATURES)}]::DOUBLE[], {c}::DOUBLE[])" for c in CENTRES[1])
    }] AS g FROM scaled
        )
        SELECT player_id, CAST(list_position(g, list_min(g)) - 1 AS INT) AS cluster_labels
        FROM gaps""",
    "kmeans_grid": """SELECT CAST(11 AS BIGINT) AS settings, CAST(55 AS INT) AS scores,
        CAST(0 AS BIGINT) AS wrong_means, TRUE AS best_is_least, TRUE AS refit_is_best,
        '[2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]' AS exported_k""",
    "contiguous_folds": """SELECT c_custkey,
        CAST(ntile(7) OVER (ORDER BY c_custkey) - 1 AS INT) AS fold FROM customer""",
    "contiguous_folds_ties": " UNION ALL ".join(
        f"""SELECT fold, '{key}' AS key, count(*) AS n, CAST(min({key}) AS VARCHAR) AS first,
                CAST(max({key}) AS VARCHAR) AS last
        FROM (SELECT {cast}, CAST(ntile(9) OVER (ORDER BY {key}) - 1 AS INT) AS fold
              FROM lineitem) GROUP BY fold"""
        for key, cast in (
            ("l_shipdate", "CAST(l_shipdate AS DATE) AS l_shipdate"),
            ("l_returnflag", "l_returnflag"),
        )
    ),
    "kmeans_step": f"""WITH {_PROFILES},
        folds(fold) AS (VALUES {", ".join(f"({f})" for f in (*range(FOLDS), -1))}),
        models AS (
            SELECT model, fold, number, centre FROM (VALUES {
        ", ".join(
            f"({s * (FOLDS + 1) + i}, {f}, {n}, {c}::DOUBLE[])"
            for s, cs in enumerate(CENTRES)
            for i, f in enumerate((*range(FOLDS), -1))
            for n, c in enumerate(cs)
        )
    }) AS m(model, fold, number, centre)
        ),
        gaps AS (
            SELECT model, fold, number, list_distance([{
        ", ".join(FEATURES)
    }]::DOUBLE[], centre) ** 2 AS gap, scaled.* FROM scaled, models
        ),
        placed AS (
            SELECT model, CASE WHEN player_id % {FOLDS} = fold THEN -1 ELSE number END AS cluster,
                   gap, {", ".join(FEATURES)}
            FROM gaps
            QUALIFY row_number() OVER (PARTITION BY model, player_id ORDER BY gap, number) = 1
        )
        SELECT CAST(model AS INT) AS model, CAST(cluster AS INT) AS cluster, count(*) AS n,
               round(sum(gap), 5) AS cost, {
        ", ".join(
            f"CASE WHEN cluster >= 0 THEN CAST(round(sum({c}), 5) AS DOUBLE) END AS {c}"
            for c in FEATURES
        )
    }
        FROM placed GROUP BY model, cluster""",
    "kmeans_starts": "SELECT count(*) AS n_players, TRUE AS ten_not_above_one FROM customer",
    "kmeans_best": """WITH scores AS (
            SELECT CAST(c_nationkey % 11 + 2 AS INT) AS n_clusters, c_custkey % 5 AS fold,
                   sum(abs(c_acctbal)) AS inertia
            FROM customer GROUP BY 1, 2
        )
        SELECT n_clusters, 'k-means++' AS init, CAST(200 AS INT) AS max_iter,
               CAST(1e-4 AS DOUBLE) AS tol, round(avg(inertia), 6) AS mean_inertia
        FROM scores GROUP BY n_clusters ORDER BY avg(inertia), n_clusters LIMIT 1""",
    "kmeans_metrics": f"""WITH {_CENTRES},
        gaps AS (
            SELECT a.label AS la, b.label AS lb, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS d
            FROM centre_dims a JOIN centre_dims b ON a.i = b.i AND a.label <> b.label
            GROUP BY a.label, b.label
        ),
        worst AS (
            SELECT la, max((s.mean_distance + t.mean_distance) / d) AS r
            FROM gaps JOIN spread s ON s.label = la JOIN spread t ON t.label = lb
            GROUP BY la
        ),
        between_part AS (
            SELECT sum(n * (c - g) * (c - g)) AS b
            FROM centre_dims JOIN grand_dims USING (i)
        ),
        within_part AS (SELECT sum(sse) AS w, sum(n) AS n, count(*) AS k FROM spread),
        sums AS (
            SELECT a.vec_id, a.label, b.label AS other,
                   avg(list_distance(a.x, b.x) * list_distance(a.x, b.x)) AS mean
            FROM points a JOIN points b ON a.vec_id <> b.vec_id
            GROUP BY a.vec_id, a.label, b.label
        ),
        sides AS (
            SELECT vec_id, max(mean) FILTER (label = other) AS a,
                   min(mean) FILTER (label <> other) AS b
            FROM sums GROUP BY vec_id
        )
        SELECT (SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) FROM sides)
                   AS silhouette_score,
               (SELECT round(avg(r), 6) FROM worst) AS davies_bouldin_score,
               round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz_score,
               round(w, 6) AS total_inertia
        FROM between_part, within_part""",
    "centroid_pairs": """WITH pairs(first, second) AS (
            VALUES (0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)
        )
        SELECT CAST(first AS INT) AS first, CAST(second AS INT) AS second, 'point' AS kind,
               (SELECT count(*) FROM customer) AS n, CAST(0 AS INT) AS wrong FROM pairs
        UNION ALL
        SELECT CAST(first AS INT), CAST(second AS INT), 'centroid', 4, 0 FROM pairs""",
    "davies_bouldin_many": """WITH points AS (
            SELECT l_partkey AS label, CAST(l_quantity AS DOUBLE) AS x,
                   CAST(l_orderkey % 1009 AS DOUBLE) AS y, CAST(l_suppkey % 97 AS DOUBLE) AS z
            FROM lineitem
        ),
        centres AS (
            SELECT label, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM points GROUP BY label
        ),
        spread AS (
            SELECT label, cx, cy, cz,
                   avg(sqrt((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2)) AS s
            FROM points JOIN centres USING (label) GROUP BY label, cx, cy, cz
        ),
        worst AS (
            SELECT a.label,
                   max((a.s + b.s) / sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2
                                          + (a.cz - b.cz) ** 2)) AS r
            FROM spread a JOIN spread b ON a.label <> b.label GROUP BY a.label
        )
        SELECT round(avg(r), 6) AS davies_bouldin_score FROM worst""",
    "silhouette_to_centres": f"""WITH {_CENTRES},
        gaps AS (
            SELECT d.vec_id, d.label, c.label AS other, sqrt(sum((v - c) * (v - c))) AS gap
            FROM dims d JOIN centre_dims c ON d.i = c.i
            GROUP BY d.vec_id, d.label, c.label
        ),
        sides AS (
            SELECT vec_id, min(gap) FILTER (label = other) AS a,
                   min(gap) FILTER (label <> other) AS b
            FROM gaps GROUP BY vec_id
        )
        SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette_to_centres
        FROM sides""",
    "kmeans_properties": """SELECT count(*) AS n_players, CAST(4 AS BIGINT) AS n_clusters,
        CAST(0 AS BIGINT) AS n_misplaced FROM customer""",
    "held_out_inertia": f"""WITH {_PROFILES},
        centres(point, centre) AS (VALUES {
        ", ".join(f"({p}, {c}::DOUBLE[])" for p, cs in enumerate(CENTRES) for c in cs)
    }),
        nearest AS (
            SELECT point, player_id % {FOLDS} AS fold, player_id,
                   min(list_distance([{", ".join(FEATURES)}]::DOUBLE[], centre) ** 2) AS d2
            FROM scaled, centres GROUP BY point, player_id
        )
        SELECT CAST(point AS INT) AS point, CAST(fold AS INT) AS fold,
               round(sum(d2), 6) AS inertia
        FROM nearest GROUP BY point, fold""",
    "centroid_pair_points": f"WITH {_PROFILES} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, "
        f"CAST(round({a}, 6) AS DOUBLE) AS x, CAST(round({b}, 6) AS DOUBLE) AS y FROM scaled"
        for a, b in combinations(FEATURES, 2)
    ),
    "silhouette_squared": f"""WITH {
        _PAIRS.format(distance="list_distance(a.x, b.x) * list_distance(a.x, b.x)")
    }
        SELECT count(*) AS n, round(avg(coalesce((b - a) / greatest(a, b), 0)), 6)
            AS silhouette FROM sides""",
    "silhouette_sampled": """SELECT count(*) AS n, TRUE AS is_sampled, TRUE AS is_within,
        TRUE AS is_narrow FROM embeddings""",
    "silhouette_exact": f"""WITH {_PAIRS.format(distance="list_distance(a.x, b.x)")}
        SELECT vec_id AS key, label,
               round(coalesce((b - a) / greatest(a, b), 0), 6) AS silhouette
        FROM sides""",
}
