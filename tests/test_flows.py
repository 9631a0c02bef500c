import json
import os
import random

import pytest
from pyspark.sql import types as T

from tests.test_cohorts import raw_logs
from tidemark.plans.flows import RunParams, run
from tidemark.params import (
    PROFILE_DDL,
    ActivityParams,
    ClusterParams,
    CohortParams,
    RatioParams,
)
from tidemark.sources.layout import table_path
from tidemark.sources.readers import read_model
from tidemark.sources.writers import read_version

MODES = ["soloShowdown", "duoShowdown", "heist", "bigGame"]


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(11)
    roster = json.dumps([{"tag": "#0", "brawler": {"name": "x"}}])
    logs = [
        {
            "player_id": f"#{rng.randint(0, 29)}",
            "battleTime": f"202301{rng.randint(1, 28):02d}T101112.000Z",
            "event_id": rng.randint(0, 3),
            "event_mode": rng.choice(MODES),
            "battle_players": roster,
            "battle_teams": f"[{roster}]",
        }
        for _ in range(400)
    ]
    schema = T.StructType.fromDDL(PROFILE_DDL)
    profiles = []
    for i in range(30):
        row = {
            "player_id": f"#{i}",
            "club_tag": f"club {i % 3}",
            **{
                f.name: rng.randint(1, 90) + 50 * (i % 3)
                for f in schema.fields
                if f.dataType == T.LongType()
            },
        }
        profiles.append(tuple(row.get(c) for c in schema.names))
    return raw_logs(spark, logs), spark.createDataFrame(profiles, schema)


def test_whole_run(spark, inputs, tmp_path):
    base = str(tmp_path)
    params = RunParams(
        label="club_tag",
        cohorts=CohortParams(
            ranges=(("2023-01-01", "2023-01-16"), ("2023-01-15", "2023-02-01"))
        ),
        activity=ActivityParams(days=(0, 1, 3, 7)),
        ratios=RatioParams(ratios=((1, 0), (3, 0), (7, 0)), analytical_ratios=((3, 1),)),
        clusters=ClusterParams(max_n_cluster=4, cross_validations=2),
    )
    tables = run(*inputs, base, params, version="v1")

    assert os.path.isdir(table_path(base, "cohort_logs") + "/cohort=2")
    logs = tables["cohort_logs"]
    assert logs.filter("event_id = 0").isEmpty()
    parts = ["event_solo", "event_duo", "event_trio", "event_special"]
    assert sum(tables[p].count() for p in parts) == logs.count()
    players = logs.select("player_id").distinct().count()
    report = tables["cohort_activity"].agg({"D0R": "sum"}).first()[0]
    assert report == players
    names = spark.read.json(table_path(base, "features_selected")).first()[0]
    assert len(names) == 4
    assert tables["profiles_clustered"].columns == ["player_id", "cluster_labels", *names]
    k = read_model(table_path(base, "kmeans_model")).getK()
    assert spark.read.json(table_path(base, "best_params")).first()["n_clusters"] == str(k)
    assert tables["metrics"].first()["total_inertia"] > 0
    assert read_version(spark, table_path(base, "inertia_curve")).count() == 2
    assert read_version(spark, table_path(base, "centroid_pairs")).count() == 6 * (30 + k)
    clusters = tables["cluster_activity"]
    assert clusters.filter("cluster_labels IS NULL OR D0R <> 1.0").isEmpty()
    chart = read_version(spark, table_path(base, "retention_chart"))
    assert chart.count() == 4 * clusters.count()


def test_no_logs_is_an_error(spark, inputs, tmp_path):
    logs, profiles = inputs
    with pytest.raises(ValueError, match="no rows in battle logs"):
        run(logs.limit(0), profiles, str(tmp_path), RunParams(label="club_tag"))
