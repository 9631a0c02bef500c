import json

import pytest
from pyspark.sql import functions as F

from tests.test_cohorts import raw_logs, stamp
from tidemark.functions.nested import json_fragments
from tidemark.operators.cohorts import cohort_filter
from tidemark.operators.rosters import (
    duo_roster,
    event_rosters,
    solo_roster,
    special_roster,
    split_event_families,
    trio_roster,
)
from tidemark.params import STANDARD_COLUMNS, CohortParams, FamilyParams
from tidemark.workload.rosters import QUERIES

KEYS = ("player_id",)


def player(tag, name):
    return {"tag": tag, "brawler": {"name": name, "power": 9}}


def logs_with(spark, column, values):
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    return raw_logs(
        spark, [{"player_id": f"#{i}", column: t} for i, t in enumerate(texts)]
    )


def collections(df):
    return {
        r["player_id"]: (r["players_collection"], r["brawlers_collection"])
        for r in df.collect()
    }


PLAYERS = [
    [player("#A", "x"), player("#B", None), {"tag": None, "brawler": None}],
    "[{'tag': '#Q', 'brawler': {'name': \"o'b\"}}]",
    None,
    [],
]


@pytest.mark.parametrize("fragments", [False, True])
def test_solo(spark, fragments):
    df = logs_with(spark, "battle_players", PLAYERS)
    if fragments:
        df = df.withColumn("battle_players", json_fragments("battle_players"))
    assert collections(solo_roster(df, KEYS)) == {
        "#0": (["#A", "#B"], ["x"]),
        "#1": (["#Q"], ["o'b"]),
    }


def test_empty_rosters_can_be_kept(spark):
    df = logs_with(spark, "battle_players", PLAYERS)
    kept = collections(solo_roster(df, KEYS, keep_empty=True))
    assert kept["#2"] == (None, None) and kept["#3"] == ([], [])


TEAMS = [
    [[player("#A", "x"), player("#B", "y"), player("#C", "z"), player("#D", "w")]],
    [[player("#A", "x")], [player("#B", None), player("#C", "z")]],
    [None, []],
    [],
]


@pytest.mark.parametrize("fragments", [False, True])
def test_teams_are_cut_and_filled(spark, fragments):
    df = logs_with(spark, "battle_teams", TEAMS)
    if fragments:
        df = df.withColumn("battle_teams", json_fragments("battle_teams"))
    duo, trio = collections(duo_roster(df, KEYS)), collections(trio_roster(df, KEYS))
    assert duo == {
        "#0": ([["#A", "#B"]], [["x", "y"]]),
        "#1": ([["#A", None], ["#B", "#C"]], [["x", None], [None, "z"]]),
        "#2": ([[None, None]] * 2, [[None, None]] * 2),
    }
    assert trio["#0"] == ([["#A", "#B", "#C"]], [["x", "y", "z"]])
    assert trio["#1"][0] == [["#A", None, None], ["#B", "#C", None]]


def test_special_has_the_boss(spark):
    df = raw_logs(
        spark,
        [
            {
                "player_id": "#0",
                "battle_players": json.dumps([player("#A", "x")]),
                "battle_bigBrawler_tag": "#Z",
                "battle_bigBrawler_brawler_name": "boss",
            }
        ],
    )
    row = special_roster(df, KEYS).first()
    assert row["battle_bigBrawler_tag"] == "#Z"
    assert row["battle_bigBrawler_brawler_name"] == "boss"
    assert row["players_collection"] == ["#A"]


def test_missing_roster_column_is_null(spark):
    df = logs_with(spark, "battle_players", PLAYERS).drop("battle_players")
    assert solo_roster(df, KEYS).count() == 0
    row = solo_roster(df, KEYS, keep_empty=True).first()
    assert row["players_collection"] is None


@pytest.mark.parametrize("typed", [False, True])
def test_families(spark, typed):
    players = json.dumps([player("#A", "x")])
    teams = json.dumps([[player("#A", "x"), player("#B", "y")]])
    modes = ["soloShowdown", "duoShowdown", "heist", "bigGame", "unknown"]
    logs = raw_logs(
        spark,
        [
            {
                "player_id": "#0",
                "battleTime": stamp("2023-01-05"),
                "event_id": 5,
                "event_mode": m,
                "battle_players": players,
                "battle_teams": teams,
            }
            for m in modes
        ],
    )
    params = CohortParams(ranges=[("2023-01-01", "2024-01-01")], typed_rosters=typed)
    cohort_logs = cohort_filter(logs, params)
    tables = split_event_families(cohort_logs)
    assert {n: [r["event_mode"] for r in t.collect()] for n, t in tables.items()} == {
        "solo": ["soloShowdown"],
        "duo": ["duoShowdown"],
        "trio": ["heist"],
        "special": ["bigGame"],
    }
    collected = ["players_collection", "brawlers_collection"]
    assert tables["duo"].columns == [*STANDARD_COLUMNS, *collected]
    row = tables["duo"].first()
    assert [row[c] for c in collected] == [[["#A", "#B"]], [["x", "y"]]]
    assert tables["solo"].first()["players_collection"] == ["#A"]

    off = split_event_families(cohort_logs, FamilyParams(duo=()))["duo"]
    assert off.schema == tables["duo"].schema and off.count() == 0


@pytest.mark.parametrize("keep_empty", [False, True])
def test_one_pass_gives_what_the_roster_functions_give(spark, keep_empty):
    """All kinds of rosters under all modes, one of which is in two families."""
    rows = [
        {
            "player_id": f"#{mode}{i}",
            "event_mode": mode,
            "battle_players": p if p is None or isinstance(p, str) else json.dumps(p),
            "battle_teams": t if t is None else json.dumps(t),
            "battle_bigBrawler_tag": "#Z",
        }
        for mode in ("a", "b", "c", "d", "none", None)
        for i, (p, t) in enumerate(zip([*PLAYERS, None], [*TEAMS, None]))
    ]
    logs = raw_logs(spark, rows)
    modes = {"solo": ("a",), "duo": ("b", "d"), "trio": ("c",), "special": ("d",)}
    keys = ("player_id", "event_mode")
    params = FamilyParams(**modes, standard_columns=keys, keep_empty=keep_empty)
    tables = split_event_families(logs, params)
    single = {"solo": solo_roster, "duo": duo_roster, "trio": trio_roster, "special": special_roster}
    for name, roster in single.items():
        expected = roster(logs.filter(F.col("event_mode").isin(list(modes[name]))), keys, keep_empty)
        assert tables[name].columns == expected.columns
        assert sorted(map(repr, tables[name].collect())) == sorted(map(repr, expected.collect()))
    assert event_rosters(logs, FamilyParams((), (), (), (), keys)).count() == 0


def test_a_family_reads_its_own_folder(spark):
    logs = raw_logs(spark, [{"player_id": "#0", "event_mode": m, "battle_players": json.dumps([player("#A", "x")])}
                            for m in ("soloShowdown", "bigGame")])
    tables = split_event_families(logs, FamilyParams(standard_columns=KEYS))
    for name, files in (("solo", 1), ("special", 1), ("duo", 0)):
        table = tables[name]
        table.collect()
        plan = table._jdf.queryExecution().executedPlan()
        assert "PartitionFilters: [isnotnull(family" in plan.toString()
        assert table.count() == files


@pytest.mark.parametrize("query", ["event_families", "event_families_typed", "disabled_family"])
def test_event_queries_scan_events_once(spark, query):
    df = QUERIES[query](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("events.parquet") == 1


def test_rosters_do_not_shuffle(spark):
    df = logs_with(spark, "battle_players", PLAYERS)
    plan = solo_roster(df.filter(F.col("player_id") != "#9"), KEYS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
