import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import (
    bucket_start,
    days_before,
    log_time_text,
    parse_log_day,
)
from tidemark.operators import cohorts as cohort_operators
from tidemark.operators.cohorts import (
    assign_cohorts,
    cohort_filter,
    drop_missing_events,
    star_flag,
    with_row_id,
    within_ranges,
)
from tidemark.operators.shape import apply_ddl
from tidemark.params import BATTLE_LOG_DDL, CohortParams

RANGES = (("2023-01-01", "2023-02-01"), ("2023-01-20", "2024-01-01"))


def raw_logs(spark, rows):
    """Raw logs from dicts; columns left out are NULL."""
    schema = T.StructType.fromDDL(BATTLE_LOG_DDL)
    return spark.createDataFrame(
        [tuple(r.get(c) for c in schema.names) for r in rows], schema
    )


def stamp(day):
    return f"{day.replace('-', '')}T161026.000Z"


def days_frame(spark, days):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "day date")


def test_missing_events_are_dropped(spark):
    df = spark.createDataFrame([(0,), (None,), (7,)], "event_id bigint")
    assert [r[0] for r in drop_missing_events(df).collect()] == [7]


def test_star_flag(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("b", "a"), (None, "a")], "star string, player string"
    )
    assert [r[0] for r in df.select(star_flag("star", "player")).collect()] == [1, 0, 0]


@pytest.mark.parametrize(
    ("closed", "kept"),
    [
        ("neither", ["2023-01-02", "2023-01-31"]),
        ("left", ["2023-01-01", "2023-01-02", "2023-01-31"]),
        ("right", ["2023-01-02", "2023-01-31", "2023-02-01"]),
        ("both", ["2023-01-01", "2023-01-02", "2023-01-31", "2023-02-01"]),
    ],
)
def test_range_ends(spark, closed, kept):
    days = ["2022-12-31", "2023-01-01", "2023-01-02", "2023-01-31", "2023-02-01"]
    rows = assign_cohorts(days_frame(spark, days), "day", RANGES[:1], closed)
    assert sorted(r["day"].isoformat() for r in rows.collect()) == kept


def test_overlapping_ranges_repeat_the_row(spark):
    rows = assign_cohorts(days_frame(spark, ["2023-01-25", "2023-01-05"]), "day", RANGES)
    assert sorted((r["day"].day, r["cohort"]) for r in rows.collect()) == [
        (5, 1),
        (25, 1),
        (25, 2),
    ]


def test_a_long_range_list_gives_the_same(spark, monkeypatch):
    days = days_frame(
        spark, ["2022-12-31", "2023-01-02", "2023-01-25", "2023-12-31", "2024-01-01"]
    )
    short = sorted(map(tuple, assign_cohorts(days, "day", RANGES).collect()))
    assert len(short) == 4
    monkeypatch.setattr(cohort_operators, "RANGE_JOIN_ROWS", 1)
    for limit in (1_000_000, 10):
        monkeypatch.setattr(cohort_operators, "BROADCAST_DAYS", limit)
        rows = assign_cohorts(days, "day", RANGES)
        assert sorted(map(tuple, rows.collect())) == short


def test_times_count_with_their_day_for_any_number_of_ranges(spark):
    times = [dt.datetime(2023, 1, 31, 23, 59), dt.datetime(2023, 1, 2, 0, 0)]
    rows = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    empty = [(f"19{10 + i}-01-01", f"19{10 + i}-02-01") for i in range(70)]
    few = assign_cohorts(rows, "t", RANGES[:1])
    many = assign_cohorts(rows, "t", [*RANGES[:1], *empty])
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert few.count() == 2


def test_malformed_times_raise_wherever_they_sort(spark):
    good = {"player_id": "#A", "battleTime": stamp("2023-01-05"), "event_id": 5}
    for text in ("garbage", "2023-01-05 10:00", "0 1"):
        bad = {"player_id": "#B", "battleTime": text, "event_id": 5}
        logs = raw_logs(spark, [good, bad])
        with pytest.raises(Exception, match="CANNOT_PARSE|cannot be parsed|could not be parsed"):
            cohort_filter(logs, CohortParams(ranges=RANGES)).collect()
        kept = cohort_filter(logs, CohortParams(ranges=RANGES, bad_time="null"))
        assert [r["player_id"] for r in kept.collect()] == ["#A"]
    logs = raw_logs(spark, [good, {"player_id": "#C", "battleTime": None, "event_id": 5}])
    assert cohort_filter(logs, CohortParams(ranges=RANGES)).count() == 1


def test_no_ranges_is_an_error(spark):
    with pytest.raises(ValueError, match="at least one cohort range"):
        assign_cohorts(days_frame(spark, ["2023-01-02"]), "day", [])


def test_month_ends_and_january_survive(spark):
    days = ["2023-01-15", "2023-03-31", "2023-12-31", "2023-02-04"]
    df = spark.createDataFrame([(stamp(d),) for d in days], "t string")
    got = [r[0].isoformat() for r in df.select(parse_log_day("t")).collect()]
    assert got == days


def test_log_time_fractions_and_bad_texts(spark):
    df = spark.createDataFrame(
        [("20230204T161026.5Z",), ("20230204T161026.123456Z",), ("yesterday",)], "t string"
    )
    good = dt.date(2023, 2, 4)
    rows = df.select(parse_log_day("t", "null"), log_time_text("t")).collect()
    assert [r[0] for r in rows] == [good, good, None]
    assert [r[1] for r in rows] == ["2023-02-04 16:10:26"] * 2 + ["yesterday"]
    with pytest.raises(Exception, match="yesterday"):
        df.select(parse_log_day("t")).collect()


def test_buckets(spark):
    # 2024-01-01 is a Monday, 2023-12-31 a Sunday.
    df = days_frame(spark, ["2024-01-01", "2023-12-31"])
    rows = df.select(
        bucket_start("day", "weekly"),
        bucket_start("day", "monthly"),
        bucket_start("day", "hourly"),
        days_before(F.col("day"), 30),
    ).collect()
    assert [[v.isoformat() for v in r] for r in rows] == [
        ["2024-01-01", "2024-01-01", "2024-01-01", "2023-12-02"],
        ["2023-12-25", "2023-12-01", "2023-12-31", "2023-12-01"],
    ]


@pytest.mark.parametrize("dtype", ["string", "date", "timestamp", "timestamp_ntz"])
def test_span_filter_keeps_the_ranges(spark, dtype):
    days = ["2022-12-31", "2023-01-01", "2023-01-02", "2023-12-31", "2024-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    if dtype == "string":
        df = df.select(
            "d", F.concat(F.translate("d", "-", ""), F.lit("T235959.999Z")).alias("t")
        )
    else:
        df = df.select("d", F.col("d").cast("date").cast(dtype).alias("t"))
    kept = [r["d"] for r in within_ranges(df, "t", RANGES).collect()]
    assert kept == ["2023-01-02", "2023-12-31"]


def test_row_ids_are_unique(spark):
    df = with_row_id(spark.range(1000).repartition(7))
    assert df.select("battlelog_id").distinct().count() == 1000


def test_cohort_filter(spark):
    logs = raw_logs(
        spark,
        [
            {
                "player_id": "#A",
                "battleTime": stamp("2023-01-25"),
                "event_id": 5,
                "battle_starPlayer_tag": "#A",
                "battle_players": "[{'tag': '#A', 'brawler': {'name': \"o'b\"}}]",
            },
            {"player_id": "#B", "battleTime": stamp("2023-01-25"), "event_id": 0},
            {"player_id": "#C", "battleTime": stamp("2023-02-01"), "event_id": 5},
            {"player_id": "#D", "battleTime": "20230105Tbad", "event_id": 5},
        ],
    )
    rows = cohort_filter(logs, CohortParams(ranges=RANGES, bad_time="null")).collect()
    found = sorted((r["player_id"], r["cohort"], r["is_starPlayer"]) for r in rows)
    assert found == [("#A", 1, 1), ("#A", 2, 1), ("#C", 2, 0)]
    assert len({r["battlelog_id"] for r in rows}) == 3
    first = next(r for r in rows if r["player_id"] == "#A")
    assert first["battleTime"] == dt.date(2023, 1, 25)
    assert first["battle_players"] == ['{"tag":"#A","brawler":{"name":"o\'b"}}']
    with pytest.raises(Exception, match="bad"):
        cohort_filter(logs, CohortParams(ranges=RANGES)).collect()


def test_cohort_filter_can_keep_missing_events(spark):
    logs = raw_logs(
        spark, [{"player_id": "#B", "battleTime": stamp("2023-01-05"), "event_id": 0}]
    )
    params = CohortParams(ranges=RANGES, exclude_missing_events=False)
    assert cohort_filter(logs, params).count() == 1
    assert cohort_filter(logs, CohortParams(ranges=RANGES)).count() == 0


def test_cohort_filter_needs_the_time_column(spark):
    with pytest.raises(ValueError, match="battleTime"):
        cohort_filter(spark.range(1))


def test_schema_is_checked(spark):
    good = spark.createDataFrame([("1", "x")], "a string, b string")
    assert apply_ddl(good, "b STRING, a BIGINT").schema.simpleString() == (
        "struct<b:string,a:bigint>"
    )
    with pytest.raises(ValueError, match="missing column"):
        apply_ddl(good, "c INT")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply_ddl(good, "b INT").collect()
