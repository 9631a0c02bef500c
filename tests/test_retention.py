import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.activity import activity_pivot, observed_positions, player_days
from tidemark.operators.retention import ratio_register, user_activity, with_ratios
from tidemark.params import (
    ActivityParams,
    RatioParams,
    check_ratio_days,
    retention_days_of,
)
from tidemark.workload.views import EVENT_DAYS, event_cohorts, table

SF_DIR = "/root/testdata/sf0.01"
START = dt.date(2024, 1, 1)


def logs_of(spark, rows):
    """Cohort logs from (cohort, player, day number)."""
    return spark.createDataFrame(
        [(c, p, START + dt.timedelta(days=d)) for c, p, d in rows],
        "cohort int, player_id string, battleTime date",
    )


def activity(spark, rows, n_cohorts=None, **params):
    result = user_activity(logs_of(spark, rows), ActivityParams(**params), n_cohorts)
    return {
        (r["cohort"], r["player_id"]): r.asDict() for r in result.collect()
    }


def flags(row):
    return [v for k, v in row.items() if k.endswith("R")]


SPARSE = [(1, "a", 0), (1, "a", 2), (1, "b", 0), (1, "b", 10), (1, "c", 0)]


def test_calendar_and_observed_days(spark):
    calendar = activity(spark, SPARSE, days=(0, 1, 2, 3, 10))
    assert flags(calendar[1, "a"]) == [1, 1, 1, 0, 0]
    assert flags(calendar[1, "b"]) == [1, 1, 1, 1, 1]
    assert flags(calendar[1, "c"]) == [1, 0, 0, 0, 0]
    # Days 0, 2, 10 were seen: positions 0, 1, 2; day 3 is the first past the list.
    observed = activity(spark, SPARSE, days=(0, 1, 2, 3, 10), day_index="observed")
    assert flags(observed[1, "a"]) == [1, 1, 0, 0, 0]
    assert flags(observed[1, "b"]) == [1, 1, 1, 1, 0]


def test_list_end(spark):
    rows = [(1, "a", d) for d in (0, 1, 2)]
    assert flags(activity(spark, rows, days=(3,), day_index="observed")[1, "a"]) == [1]
    assert flags(activity(spark, rows, days=(3,))[1, "a"]) == [0]


def test_exact_mode(spark):
    rows = [(1, "a", d) for d in (0, 2, 5)]
    assert flags(activity(spark, rows, days=(0, 1, 2, 5), mode="exact")[1, "a"]) == [
        1,
        0,
        1,
        1,
    ]


def test_one_day_player(spark):
    assert flags(activity(spark, [(1, "a", 0)], days=(0, 1))[1, "a"]) == [1, 0]


def test_sessions(spark):
    rows = [(1, "a", 0)] * 3 + [(1, "a", 2)] * 2 + [(1, "b", 0)]
    got = activity(spark, rows, days=(0, 1, 2, 3))
    assert [got[1, "a"][f"D{d}_Sessions"] for d in (0, 1, 2, 3)] == [3, 3, 5, 0]
    assert [got[1, "b"][f"D{d}_Sessions"] for d in (0, 1, 2, 3)] == [1, 0, 0, 0]


def test_late_returner(spark):
    rows = [(1, "a", 0), (2, "a", 20), (2, "b", 20)]
    got = activity(spark, rows, days=(0, 1))
    assert flags(got[1, "a"]) == [1, 0]
    assert flags(got[2, "a"]) == [0, 0] and got[2, "a"]["first_log"] == START
    assert flags(got[2, "b"]) == [1, 0]
    own = activity(spark, rows, days=(0, 1), first_log_scope="cohort")
    assert flags(own[2, "a"]) == [1, 0]


def test_busy_week(spark):
    rows = [(1, "a", 0), (1, "a", 2), (1, "b", 0)]
    assert flags(activity(spark, rows, days=(0,), frequency="weekly")[1, "a"]) == [1]
    observed = activity(
        spark, rows, days=(0,), frequency="weekly", day_index="observed"
    )
    assert flags(observed[1, "a"]) == [0] and flags(observed[1, "b"]) == [1]


def test_calendar_weeks_are_counted_as_one_row(spark):
    rows = [(1, "a", 0), (1, "a", 2), (1, "a", 2), (1, "a", 8)]
    logs = logs_of(spark, rows)
    assert sorted(
        (r["days_to_return"], r["daily_sessions"])
        for r in player_days(logs, "weekly", per_day=False).collect()
    ) == [(0, 3), (7, 1)]
    assert player_days(logs, "weekly").count() == 3
    got = activity(spark, rows, days=(0, 7), frequency="weekly")[1, "a"]
    assert (got["D0_Sessions"], got["D7_Sessions"]) == (3, 4)


def test_weeks_start_on_monday(spark):
    got = activity(spark, [(1, "a", 6), (1, "b", -1)], days=(0,), frequency="weekly")
    assert got[1, "a"]["first_log"] == dt.date(2024, 1, 1)
    assert got[1, "b"]["first_log"] == dt.date(2023, 12, 25)


def test_unknown_frequency_is_daily(spark):
    rows = [(1, "a", 1)]
    assert activity(spark, rows, frequency="hourly") == activity(spark, rows)


def test_bad_parameters():
    for bad in ({"day_index": "x"}, {"mode": "x"}, {"first_log_scope": "x"}):
        with pytest.raises(ValueError):
            ActivityParams(**bad)


def listwise(pivoted_days, seen, d):
    """(flag, sessions) of one player from explicit lists over the seen days."""
    marks = [pivoted_days.get(day, (None, None))[0] for day in seen]
    sessions = [pivoted_days.get(day, (None, 0))[1] for day in seen]
    ones = [i for i, v in enumerate(marks) if v == 1]
    last = len(seen) - 1
    kept = marks[0] == 1 and (
        d <= max(ones) or (d == len(seen) and max(ones) == last)
    )
    return (1, sum(sessions[: d + 1])) if kept else (0, 0)


@pytest.mark.parametrize("frequency", ["daily", "weekly"])
@pytest.mark.parametrize("n_cohorts", [3, None])
def test_observed_equals_lists(spark, frequency, n_cohorts):
    rng = random.Random(7)
    rows = [
        (rng.randint(1, 3), f"p{rng.randint(0, 40)}", rng.choice((0, 1, 2, 5, 9, 16, 40)))
        for _ in range(400)
    ]
    days = (0, 1, 2, 3, 4, 5, 6, 7, 8)
    got = activity(
        spark, rows, n_cohorts, days=days, frequency=frequency, day_index="observed"
    )
    by_player = {}
    for r in player_days(logs_of(spark, rows), frequency).collect():
        lists = by_player.setdefault((r["cohort"], r["player_id"]), {})
        mark, total = lists.get(r["days_to_return"], (0, 0))
        lists[r["days_to_return"]] = (mark + 1, total + r["daily_sessions"])
    assert set(got) == set(by_player)
    for (cohort, player), lists in by_player.items():
        seen = sorted({d for (c, _), ls in by_player.items() if c == cohort for d in ls})
        row = got[cohort, player]
        for d in days:
            assert (row[f"D{d}R"], row[f"D{d}_Sessions"]) == listwise(lists, seen, d)


def test_positions(spark):
    rows = observed_positions(player_days(logs_of(spark, SPARSE))).collect()
    assert sorted((r["days_to_return"], r["position"], r["width"]) for r in rows) == [
        (0, 0, 3),
        (2, 1, 3),
        (10, 2, 3),
    ]


def test_pivot_finds_its_days(spark):
    wide = activity_pivot(player_days(logs_of(spark, SPARSE)))
    assert wide.columns == [
        "player_id",
        "first_log",
        "0_day",
        "0_day_sessions",
        "2_day",
        "2_day_sessions",
        "10_day",
        "10_day_sessions",
    ]
    a = wide.filter("player_id = 'a'").first()
    assert (a["0_day"], a["2_day"], a["10_day"]) == (1, 1, None)


def flag_sums(df, days):
    return df.agg(*[F.sum(f"D{d}R") for d in days]).first()


def test_golden_event_totals(spark):
    purchases = event_cohorts(spark, SF_DIR, "purchase")
    for day_index, totals in (
        ("observed", (151, 150, 148, 136, 27, 0)),
        ("calendar", (150, 149, 147, 135, 27, 0)),
    ):
        rows = user_activity(
            purchases, ActivityParams(days=EVENT_DAYS, day_index=day_index), 2
        )
        assert tuple(flag_sums(rows, EVENT_DAYS)) == totals


def test_golden_first_day_counts(spark):
    logs = table(spark, SF_DIR, "events").select(
        F.lit(1).alias("cohort"),
        F.col("user_id").alias("player_id"),
        F.col("ts").cast("date").alias("battleTime"),
    )
    days = (0, 1, 3, 7, 14, 28, 56)
    for mode, first, second in (
        ("rolling", (134, 134, 134, 134, 134, 134, 0), (16, 16, 16, 16, 16, 15, 0)),
        ("exact", (134, 122, 123, 120, 114, 122, 0), (16, 14, 14, 15, 14, 15, 0)),
    ):
        sums = (
            user_activity(logs, ActivityParams(days=days, mode=mode))
            .groupBy("first_log")
            .agg(*[F.sum(f"D{d}R") for d in days])
            .orderBy("first_log")
            .collect()
        )
        assert [tuple(r)[1:] for r in sums] == [first, second]


def test_ratios(spark):
    rows = [(1, p, 0) for p in "abcd"] + [(1, "a", 1), (1, "b", 1), (1, "a", 3)]
    rows += [(1, "z", 10)]
    params = RatioParams(ratios=((1, 0), (3, 0)), analytical_ratios=((3, 1),))
    report = ratio_register(
        user_activity(logs_of(spark, rows), ActivityParams(days=(0, 1, 3))), params
    )
    assert report.columns == [
        "first_log",
        "D0R",
        "D0_Sessions",
        "D1R",
        "D1_Sessions",
        "D3R",
        "D3_Sessions",
        "D3/D1",
    ]
    got = [tuple(r)[1:] for r in report.collect()]
    assert got == [(4, 4, 0.5, 4, 0.25, 3, 0.5), (1, 1, 0.0, 0, 0.0, 0, 0.0)]


def test_null_denominator_gives_zero(spark):
    sums = spark.createDataFrame([(None, 5)], "D0R bigint, D1R bigint")
    params = RatioParams(ratios=((1, 0),), analytical_ratios=None)
    assert with_ratios(sums, params).first()["D1R"] == 0.0


def test_ratio_days_are_checked(spark):
    assert retention_days_of(["D0R", "D14R", "D1_Sessions", "xD3R"]) == [0, 14]
    check_ratio_days([(1, 0)], [0, 1])
    with pytest.raises(ValueError, match=r"needs retention day\(s\) \[7\]"):
        check_ratio_days([(7, 0)], [0, 1])
    rows = user_activity(logs_of(spark, SPARSE), ActivityParams(days=(0, 1)))
    with pytest.raises(ValueError, match="extracted days"):
        ratio_register(rows, RatioParams(ratios=((1, 0),), analytical_ratios=((3, 1),)))


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("day_index", ["calendar", "observed"])
def test_plan_stays_in_the_jvm(spark, day_index):
    rows = user_activity(
        event_cohorts(spark, SF_DIR), ActivityParams(day_index=day_index), 2
    )
    text = executed(rows).split("Initial Plan")[0]
    assert "Python" not in text and "CartesianProduct" not in text
    # One shuffle per player-day, one per player, and a tiny one for the day lists.
    assert text.count("- Exchange hashpartitioning") <= 3
    if day_index == "observed":
        assert "ReusedExchange" in text
