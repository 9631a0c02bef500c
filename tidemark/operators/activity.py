"""From cohort logs to activity per player and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import bucket_start, days_between


def daily_sessions(logs: DataFrame) -> DataFrame:
    """(cohort, battleTime, player_id, daily_sessions): log rows per player and day."""
    return logs.groupBy("cohort", "battleTime", "player_id").agg(
        F.count("*").alias("daily_sessions")
    )


def with_bucket(rows: DataFrame, frequency: str | None) -> DataFrame:
    """Add ``bucket``: the day, or the start of its week or month."""
    return rows.withColumn("bucket", bucket_start("battleTime", frequency))


def with_first_log(bucketed: DataFrame, scope: str = "global") -> DataFrame:
    """Add the player's first bucket, over all cohorts or within each cohort."""
    keys = ["player_id"] if scope == "global" else ["player_id", "cohort"]
    return bucketed.withColumn(
        "first_log", F.min("bucket").over(Window.partitionBy(*keys))
    )


def bucket_sessions(logs: DataFrame, frequency: str | None) -> DataFrame:
    """(cohort, bucket, player_id, daily_sessions): log rows per player and bucket."""
    return (
        with_bucket(logs, frequency)
        .groupBy("cohort", "bucket", "player_id")
        .agg(F.count("*").alias("daily_sessions"))
    )


def player_days(
    logs: DataFrame,
    frequency: str | None = "daily",
    scope: str = "global",
    per_day: bool = True,
) -> DataFrame:
    """(cohort, player_id, first_log, days_to_return, daily_sessions).

    Sessions are counted before the window, so a player brings one row per day and
    cohort to its task, however many log rows there are. Under a weekly or monthly
    frequency several active days share one ``days_to_return``; with ``per_day`` off they
    are counted together, in fewer rows.
    """
    if per_day:
        counted = with_bucket(daily_sessions(logs), frequency)
    else:
        counted = bucket_sessions(logs, frequency)
    return with_first_log(counted, scope).select(
        "cohort",
        "player_id",
        "first_log",
        days_between("bucket", "first_log").alias("days_to_return"),
        "daily_sessions",
    )


def observed_positions(days: DataFrame) -> DataFrame:
    """(cohort, days_to_return, position, width): rank from 0 of a day among the days
    seen in its cohort, and their number. Ranks the distinct days only."""
    pairs = days.select("cohort", "days_to_return").distinct()
    in_cohort = Window.partitionBy("cohort")
    return pairs.select(
        "cohort",
        "days_to_return",
        (F.dense_rank().over(in_cohort.orderBy("days_to_return")) - 1).alias(
            "position"
        ),
        F.count("*").over(in_cohort).cast("int").alias("width"),
    )


def observed_days(days: DataFrame) -> DataFrame:
    """(cohort, seen_days): sorted array of the days seen in a cohort. The array has one
    entry per calendar day at most, and is combined before the shuffle."""
    # A row of player_days always has a session, so the filter keeps every row. It makes
    # this branch read the same columns as the retention branch, and so the same shuffle.
    return (
        days.filter(F.col("daily_sessions") > 0)
        .groupBy("cohort")
        .agg(F.array_sort(F.collect_set("days_to_return")).alias("seen_days"))
    )


def activity_pivot(days: DataFrame, columns: Sequence[int] | None = None) -> DataFrame:
    """One row per player and first day, with ``{d}_day`` (active days) and
    ``{d}_day_sessions`` per day to return. Without ``columns`` Spark looks the days up
    in a job of its own."""
    wide = days.groupBy("player_id", "first_log").pivot(
        "days_to_return", list(columns) if columns is not None else None
    )
    return wide.agg(
        F.sum(F.lit(1)).alias("day"), F.sum("daily_sessions").alias("day_sessions")
    )
