import math

import pytest

from tidemark.operators.features import (
    anova_table,
    numeric_features,
    prepare_profiles,
    scale_max_abs,
    select_features,
    top_features,
)
from tidemark.operators.shape import count_parity, null_profile
from tidemark.params import PROFILE_DDL, PROFILE_DROPPED


def test_prepared_columns(spark):
    raw = spark.createDataFrame([], PROFILE_DDL)
    prepared = prepare_profiles(raw)
    assert prepared.columns == [
        "player_id",
        "trophies",
        "highestTrophies",
        "expLevel",
        "expPoints",
        "3vs3Victories",
        "soloVictories",
        "duoVictories",
        "bestRoboRumbleTime",
    ]
    assert "club_tag" in PROFILE_DROPPED
    assert "club_tag" in prepare_profiles(raw, keep=["club_tag"]).columns
    assert numeric_features(prepared, ["player_id", "trophies"])[0] == "highestTrophies"


def test_scaling(spark):
    df = spark.createDataFrame(
        [("a", 0, -4.0, 1), ("b", 0, 2.0, None)],
        "player_id string, zero int, neg double, gap bigint",
    )
    rows = {r[0]: tuple(r)[1:] for r in scale_max_abs(df).collect()}
    assert rows == {"a": (0.0, -1.0, 1.0), "b": (0.0, 0.5, None)}
    parity = count_parity(df, scale_max_abs(df)).first()
    assert tuple(parity) == (2, 2, True)


def f_by_hand(groups):
    values = [x for g in groups for x in g]
    grand = sum(values) / len(values)
    between = sum(len(g) * (sum(g) / len(g) - grand) ** 2 for g in groups)
    within = sum((x - sum(g) / len(g)) ** 2 for g in groups for x in g)
    k, n = len(groups), len(values)
    return (between / (k - 1)) / (within / (n - k))


ROWS = [
    ("p1", "x", 1.0, 5.0, 2.0, 1.0),
    ("p2", "x", 2.0, 5.0, 2.0, 7.0),
    ("p3", "y", 4.0, 6.0, 2.0, 2.0),
    ("p4", "y", 6.0, 6.0, 2.0, 6.5),
]
DDL = "player_id string, kind string, a double, b double, c double, d double"


def test_anova(spark):
    df = spark.createDataFrame(ROWS, DDL)
    table = {r["feature"]: r["f_score"] for r in anova_table(df, "abcd", "kind").collect()}
    assert table["a"] == pytest.approx(f_by_hand([[1, 2], [4, 6]]))
    assert table["d"] == pytest.approx(f_by_hand([[1, 7], [2, 6.5]]))
    assert table["b"] == math.inf and math.isnan(table["c"])


def test_top_features(spark):
    df = spark.createDataFrame(ROWS, DDL)
    best = top_features(anova_table(df, "abcd", "kind"), 3).orderBy("rank").collect()
    assert [r["feature"] for r in best] == ["b", "a", "d"]
    reduced, names = select_features(df, "kind", 2)
    assert names == ["a", "b"] and reduced.columns == ["player_id", "a", "b"]
    assert reduced.count() == 4


def test_selection_without_a_label(spark):
    df = spark.createDataFrame(ROWS, DDL)
    reduced, names = select_features(df, None, 2)
    assert names == ["a", "d"] and reduced.columns == ["player_id", "a", "d"]
    assert select_features(df, None, 4)[1] == ["a", "b", "d"]


def test_anova_needs_repeated_classes(spark):
    df = spark.createDataFrame(ROWS, DDL)
    with pytest.raises(Exception, match="fewer classes than rows"):
        anova_table(df, ["a"], "player_id").collect()
    with pytest.raises(ValueError, match="missing column"):
        anova_table(df, ["a"], "nothing")


def test_null_profile(spark):
    df = spark.createDataFrame(
        [(None, float("nan")), ("x", None), ("y", 1.0)], "a string, `b.c` double"
    )
    assert {tuple(r) for r in null_profile(df).collect()} == {("a", 1), ("b.c", 2)}
    assert null_profile(df, ["a"]).count() == 1
