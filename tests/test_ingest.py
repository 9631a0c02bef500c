import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.functions.names import names_except, names_like, quoted, underscored
from tidemark.operators.ingest import battle_rows, profile_rows
from tidemark.operators.shape import (
    empty_like,
    flatten,
    head_of_list,
    require_rows,
    union_by_name,
    union_by_position,
    with_key,
)
from tidemark.params import BATTLE_LOG_DDL, require_columns
from tidemark.sources.layout import shared_folder, table_path
from tidemark.sources.readers import (
    BATTLE_PAYLOAD_DDL,
    PROFILE_PAYLOAD_DDL,
    read_csv,
    read_id_list,
    read_payloads,
)
from tidemark.sources.writers import (
    append_version,
    read_version,
    write_csv,
    write_parquet,
)


def test_id_list(spark, tmp_path):
    path = tmp_path / "tags.txt"
    path.write_text("#AAA, #BBB,#CCC")
    tags = read_id_list(spark, str(path))
    assert [r["tag"] for r in tags.orderBy("pos").collect()] == ["#AAA", " #BBB", "#CCC"]
    assert [r["tag"] for r in head_of_list(tags, 2).collect()] == ["#AAA", " #BBB"]
    assert head_of_list(tags, None).count() == 3


def test_id_list_in_splits_keeps_its_order(spark, tmp_path):
    path = tmp_path / "tags.txt"
    path.write_text(",".join(f"#{i}" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        tags = read_id_list(spark, str(path))
        assert tags.rdd.getNumPartitions() > 4
        got = [r["tag"] for r in tags.orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [f"#{i}" for i in range(5000)]


def test_csv(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'a "b", c\nd'), (None, "x")], "n bigint, t string"
    )
    write_csv(df, str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"), "n BIGINT, t STRING", multi_line=True)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    inferred = read_csv(spark, str(tmp_path / "t"), multi_line=True).schema
    assert inferred["n"].dataType.typeName() in ("integer", "long")
    # A line end inside a value is never read as two rows unnoticed.
    for ddl in ("n BIGINT, t STRING", "n BIGINT, t DATE"):
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
            read_csv(spark, str(tmp_path / "t"), ddl).collect()


BATTLE = {
    "battleTime": "20230204T161026.000Z",
    "event": {"id": 15, "mode": "gemGrab", "map": "Mine"},
    "battle": {
        "mode": "gemGrab",
        "trophyChange": 8,
        "starPlayer": {"tag": "#A", "name": "n", "brawler": {"id": 1, "name": "x"}},
        "teams": [[{"tag": "#A", "brawler": {"name": "x"}}]],
        "level": {"name": "L", "id": 3},
    },
}


def test_battle_payloads(spark, tmp_path):
    lines = [
        json.dumps({"player_id": "#A", "items": [BATTLE, BATTLE]}),
        json.dumps({"player_id": "#B", "items": []}),
        "",
        '{"player_id": "#C", "items": [',
        json.dumps({"player_id": "#D", "items": "none"}),
    ]
    (tmp_path / "logs.json").write_text("\n".join(lines))
    good, bad = read_payloads(spark, str(tmp_path), BATTLE_PAYLOAD_DDL)
    assert sorted(r["player_id"] for r in good.collect()) == ["#A", "#B"]
    assert good.count() == 2 and bad.count() == 2
    rows = battle_rows(good)
    assert rows.columns == [f.name for f in spark.createDataFrame([], BATTLE_LOG_DDL).schema]
    row = rows.first()
    assert rows.count() == 2
    assert (row["event_id"], row["battle_level_id"]) == (15, 3)
    assert row["battle_starPlayer_brawler_name"] == "x"
    assert row["battle_starPlayer"] is None and row["battle_players"] is None
    assert json.loads(row["battle_teams"])[0][0]["tag"] == "#A"


def test_profile_payloads(spark, tmp_path):
    document = {
        "tag": "#A",
        "name": "n",
        "3vs3Victories": 4,
        "icon": {"id": 9},
        "club": {"tag": "#C", "name": "club"},
        "brawlers": [{"id": 1, "name": "x"}],
    }
    (tmp_path / "p.json").write_text(json.dumps(document))
    good, _ = read_payloads(spark, str(tmp_path), PROFILE_PAYLOAD_DDL)
    row = profile_rows(good).first()
    assert (row["player_id"], row["3vs3Victories"], row["icon_id"]) == ("#A", 4, 9)
    assert json.loads(row["brawlers"]) == [{"id": 1, "name": "x"}]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    append_version(spark.range(2), path, "2024-01-02T10:00:00.000Z")
    append_version(spark.range(5), path, "2024-01-01T10:00:00.000Z")
    assert read_version(spark, path).count() == 2
    assert read_version(spark, path, "2024-01-01T10:00:00.000Z").count() == 5
    append_version(spark.range(7), path, "2024-01-02T10:00:00.000Z")
    assert read_version(spark, path).count() == 7
    assert read_version(spark, path, "2024-01-01T10:00:00.000Z").count() == 5
    append_version(spark.range(3), str(tmp_path / "n"), "007")
    assert read_version(spark, str(tmp_path / "n")).first()["version"] == "007"


def test_partitioned_table_is_pruned(spark, tmp_path):
    path = str(tmp_path / "p")
    write_parquet(spark.range(10).withColumn("cohort", F.col("id") % 2), path, ["cohort"])
    rows = spark.read.parquet(path).filter("cohort = 1")
    assert rows.count() == 5 and len(rows.inputFiles()) >= 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cohort" in plan


def test_flatten(spark):
    df = spark.sql(
        "select named_struct('b', 1, 'c', named_struct('d', 2)) as a, "
        "array(1, 2) as `x.y`, map('k', 1) as m"
    )
    flat = flatten(df)
    assert flat.columns == ["a_b", "a_c_d", "x_y", "m"]
    assert tuple(flat.first()) == (1, 2, "[1,2]", '{"k":1}')
    with pytest.raises(ValueError, match="a_b"):
        flatten(spark.sql("select named_struct('b', 1) as a, 2 as a_b"))


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2.0)], "t string, v double")
    assert {tuple(r) for r in union_by_name([a, b]).collect()} == {
        (1, "x", None),
        (None, "y", 2.0),
    }
    assert union_by_position([a, a, a]).count() == 3


def test_small_checks(spark):
    df = spark.range(3)
    assert require_rows(df, "x") is df
    with pytest.raises(ValueError, match="no rows in x"):
        require_rows(df.limit(0), "x")
    with pytest.raises(ValueError, match="missing column"):
        require_columns(df.columns, ["id", "day"])
    assert with_key(df, "#A").first()["player_id"] == "#A"
    assert empty_like(df).schema == df.schema and empty_like(df).count() == 0
    named = df.select(F.lit(1).alias("D3/D1"), F.lit(2).alias("D1R"), F.lit(3).alias("D10R"))
    assert names_like(named, r"D\d+R") == ["D1R", "D10R"]
    assert names_except(named, ["D1R"]) == ["D3/D1", "D10R"]
    assert named.select(quoted("D3/D1")).first()[0] == 1
    assert underscored("a.b") == "a_b"


def test_layout():
    assert table_path("s3a://b/x/", "user_activity") == "s3a://b/x/primary/user_activity"
    def session(master, settings):
        return SimpleNamespace(
            conf=settings, sparkContext=SimpleNamespace(master=master)
        )

    cluster = session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/"})
    first, second = shared_folder(cluster), shared_folder(cluster)
    assert first.startswith("hdfs://nn/shared/tidemark-") and first != second
    assert os.path.isdir(shared_folder(session("local[8]", {})))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", {}))
