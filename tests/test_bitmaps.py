"""Activity bitmaps and states that merge, against the activity table and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.activity import player_days
from tidemark.operators.bitmaps import (
    active_days,
    activity_bitmaps,
    activity_state,
    advance_state,
    merge_states,
    retention_of_bitmaps,
    shifted,
    user_activity_of_state,
    word_count,
)
from tidemark.operators.retention import user_activity
from tidemark.params import ActivityParams
from tidemark.workload.retention import ORDER_SPAN, WEEK_DAYS, order_bitmaps
from tidemark.workload.views import order_cohorts

START = dt.date(2024, 1, 1)
SF_DIR = "/root/testdata/sf0.001"


def logs_of(spark, rows):
    """Cohort logs from (cohort, player, day number)."""
    return spark.createDataFrame(
        [(c, p, START + dt.timedelta(days=d)) for c, p, d in rows],
        "cohort int, player_id string, battleTime date",
    )


def some_logs(seed, n=400):
    rng = random.Random(seed)
    return [(rng.randrange(1, 4), f"p{rng.randrange(40)}", rng.randrange(200)) for _ in range(n)]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("mode", ["rolling", "exact"])
@pytest.mark.parametrize("scope", ["global", "cohort"])
def test_any_list_of_days(spark, mode, scope):
    logs = logs_of(spark, some_logs(1))
    maps = activity_bitmaps(player_days(logs, scope=scope), 200).cache()
    assert {len(r["words"]) for r in maps.collect()} == {4}
    for days in ((0, 1, 7), (0, 63, 64, 65, 127, 128, 199), (300, 5)):
        params = ActivityParams(days=days, mode=mode, first_log_scope=scope)
        assert rows_of(retention_of_bitmaps(maps, days, mode)) == rows_of(user_activity(logs, params))


def test_a_second_list_takes_no_shuffle(spark):
    maps = order_bitmaps(spark, SF_DIR)
    df = retention_of_bitmaps(maps, WEEK_DAYS, "exact")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "orders" not in plan


def test_bitmaps_use_the_shuffle_of_the_player_days(spark):
    days = player_days(order_cohorts(spark, SF_DIR))
    before, after = (
        df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")
        for df in (days, activity_bitmaps(days, ORDER_SPAN))
    )
    assert after == before > 0


def test_days_beyond_the_span_are_an_error(spark):
    logs = logs_of(spark, [(1, "a", 0), (1, "a", 64)])
    with pytest.raises(Exception, match="beyond the span"):
        activity_bitmaps(player_days(logs), 64).collect()
    assert activity_bitmaps(player_days(logs), 65).count() == 1
    with pytest.raises(ValueError):
        word_count(0)


@pytest.mark.parametrize("by", [0, 1, 63, 64, 65, 130])
def test_shift(spark, by):
    rng = random.Random(by)
    lists = [sorted(rng.sample(range(150), rng.randrange(1, 30))) for _ in range(30)] + [[0], [63], [64], [149]]
    days = [(str(i), d) for i, own in enumerate(lists) for d in own]
    rows = spark.createDataFrame(days, "player_id string, days_to_return int").selectExpr(
        "1 AS cohort", "player_id", "DATE '2024-01-01' AS first_log", "days_to_return", "1L AS daily_sessions"
    )
    maps = activity_bitmaps(rows, 150).withColumn("moved", shifted(F.col("words"), F.lit(by)))
    got = {r["player_id"]: (r["a"], r["b"]) for r in maps.select(
        "player_id", active_days(F.col("words")).alias("a"), active_days(F.col("moved")).alias("b")
    ).collect()}
    assert got == {str(i): (own, [d + by for d in own]) for i, own in enumerate(lists)}


@pytest.mark.parametrize(("frequency", "scope"), [("daily", "global"), ("daily", "cohort"), ("weekly", "global")])
def test_states_merge_to_the_state_of_all_logs(spark, frequency, scope):
    rows = some_logs(2, 600)
    parts = [rows[:250], rows[250:251], rows[251:400], rows[400:]]
    whole = activity_state(logs_of(spark, rows), 256, frequency, scope)
    params = ActivityParams(frequency, days=(0, 7, 63, 64, 70, 140, 199), first_log_scope=scope)
    expected = rows_of(user_activity(logs_of(spark, rows), params))
    # One after the other, and all at once, in another order.
    state = activity_state(logs_of(spark, parts[0]), 256, frequency, scope)
    for part in parts[1:]:
        state = advance_state(state, logs_of(spark, part), 256, frequency, scope)
    states = [activity_state(logs_of(spark, p), 256, frequency, scope) for p in reversed(parts)]
    for merged in (whole, state, merge_states(states, scope), merge_states([whole], scope)):
        assert rows_of(user_activity_of_state(merged, params)) == expected
    empty = activity_state(logs_of(spark, []), 256, frequency, scope)
    assert rows_of(user_activity_of_state(merge_states([empty, whole, empty], scope), params)) == expected


def test_an_untouched_player_stays_as_stored(spark):
    state = activity_state(logs_of(spark, [(1, "a", 5), (1, "b", 9)]), 64)
    after = advance_state(state, logs_of(spark, [(2, "b", 3)]), 64)
    assert after.where("player_id = 'a'").collect() == state.where("player_id = 'a'").collect()
    b = {r["cohort"]: r for r in after.where("player_id = 'b'").collect()}
    assert {r["first_log"] for r in b.values()} == {START + dt.timedelta(days=3)}
    assert b[1]["words"][0] == 1 << 6 and b[2]["words"] == [1]


def test_advancing_reads_the_state_and_new_logs_only(spark, tmp_path):
    activity_state(logs_of(spark, some_logs(3)), 256).write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    logs_of(spark, some_logs(4)).write.parquet(str(tmp_path / "new"))
    after = advance_state(state, spark.read.parquet(str(tmp_path / "new")), 256)
    read = {f.split(str(tmp_path))[1].split("/")[1] for f in after.inputFiles()}
    assert read == {"state", "new"}
    with pytest.raises(ValueError):
        user_activity_of_state(after, ActivityParams(day_index="observed"))
