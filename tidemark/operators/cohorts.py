"""From raw logs to cohorts: missing events, flags, and date ranges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import LOG_TIME_PATTERN, parse_log_day
from tidemark.functions.names import quoted
from tidemark.functions.nested import PLAYERS_DDL, TEAMS_DDL, json_fragments
from tidemark.operators.lookup import lookup_join
from tidemark.params import CohortParams, one_of, require_columns

Ranges = Sequence[tuple[str, str]]

# Every row is compared with each range of a range join, so the list has to be short.
RANGE_JOIN_ROWS = 64

# (cohort, day) rows of 16 bytes that may be broadcast.
BROADCAST_DAYS = 1_000_000

_ONE_DAY = dt.timedelta(days=1)


def drop_missing_events(logs: DataFrame, event: str = "event_id") -> DataFrame:
    """Rows with a known event: an id of 0 or NULL is dropped."""
    return logs.filter(F.col(event) != 0)


def keep_modes(
    logs: DataFrame, modes: Sequence[str], mode: str = "event_mode"
) -> DataFrame:
    """Rows whose mode is in a list."""
    return logs.filter(F.col(mode).isin(list(modes)))


def star_flag(star, player) -> Column:
    """1 when the star player is the player, else 0 (also for a NULL star)."""
    return F.when(F.col(star) == F.col(player), 1).otherwise(0)


def _inclusive(ranges: Ranges, closed: str) -> list[tuple[int, dt.date, dt.date]]:
    """(cohort number, first day, last day) per range, both days inside the cohort."""
    one_of("closed", closed, ("neither", "left", "right", "both"))
    if not ranges:
        raise ValueError("at least one cohort range is needed")
    days = []
    for number, (lo, hi) in enumerate(ranges, start=1):
        first, last = dt.date.fromisoformat(lo), dt.date.fromisoformat(hi)
        if closed in ("neither", "right"):
            first += _ONE_DAY
        if closed in ("neither", "left"):
            last -= _ONE_DAY
        days.append((number, first, last))
    return days


def range_table(
    spark: SparkSession, ranges: Ranges, closed: str = "neither"
) -> DataFrame:
    """(cohort, first_day, last_day), one row per range, numbered from 1."""
    rows = [
        F.struct(
            F.lit(number).alias("cohort"),
            F.lit(first).alias("first_day"),
            F.lit(last).alias("last_day"),
        )
        for number, first, last in _inclusive(ranges, closed)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def within_ranges(
    logs: DataFrame,
    stamp: str,
    ranges: Ranges,
    closed: str = "neither",
    keep_malformed: bool = False,
) -> DataFrame:
    """Keep the span from the first to the last range day.

    The comparison is made on the column as it is stored (log text, date or time), so
    the predicate reaches the file scan and skips row groups outside the span. Rows without
    a time are in no range. Log text that is not a log time is compared as text, or stays
    with ``keep_malformed``, for a later step to raise on; then texts are looked at one by
    one, and only dates and times are skipped by row groups.
    """
    days = _inclusive(ranges, closed)
    first = min(d for _, d, _ in days)
    after = max(d for _, _, d in days) + _ONE_DAY
    dtype = logs.schema[stamp].dataType
    if isinstance(dtype, T.StringType):
        lo, hi = F.lit(first.strftime("%Y%m%d")), F.lit(after.strftime("%Y%m%d"))
    else:
        lo, hi = (F.lit(d.isoformat()).cast(dtype) for d in (first, after))
    inside = (F.col(stamp) >= lo) & (F.col(stamp) < hi)
    if keep_malformed and isinstance(dtype, T.StringType):
        inside = inside | ~F.col(stamp).rlike(LOG_TIME_PATTERN)
    return logs.filter(inside)


def assign_cohorts(
    logs: DataFrame, day: str, ranges: Ranges, closed: str = "neither"
) -> DataFrame:
    """One copy of a row per cohort range that holds its day; other rows vanish.

    A time counts with its date. A short list of ranges is broadcast and matched by range. A
    long one is written out as (cohort, day) rows and matched by equality; these are
    broadcast up to a known number, and beyond it joined with salted days.
    """
    date = F.col(day).cast("date")
    table = range_table(logs.sparkSession, ranges, closed)
    if len(ranges) <= RANGE_JOIN_ROWS:
        held = date.between(F.col("first_day"), F.col("last_day"))
        return logs.join(F.broadcast(table), held).drop("first_day", "last_day")
    days = table.filter("first_day <= last_day").select(
        "cohort", F.explode(F.sequence("first_day", "last_day")).alias("_day")
    )
    dated = logs.withColumn("_day", date)
    spans = _inclusive(ranges, closed)
    if sum((last - first).days + 1 for _, first, last in spans) <= BROADCAST_DAYS:
        joined = dated.join(F.broadcast(days), "_day")
    else:
        joined = lookup_join(dated, days, "_day", logs.columns)
    return joined.select(*[quoted(c) for c in logs.columns], "cohort")


def with_row_id(logs: DataFrame, name: str = "battlelog_id") -> DataFrame:
    """Add a unique id that is not consecutive.

    The value depends on how the input is split. Use it on a scan with narrow steps
    only, and write the result before several consumers read it.
    """
    return logs.withColumn(name, F.monotonically_increasing_id())


def cohorts_of(logs: DataFrame) -> DataFrame:
    """The distinct cohort numbers."""
    return logs.select("cohort").distinct()


def filter_cohort(logs: DataFrame, cohort: int) -> DataFrame:
    """Rows of one cohort."""
    return logs.filter(F.col("cohort") == cohort)


def _parsed_rosters(logs: DataFrame, typed: bool) -> DataFrame:
    parsed = {
        name: F.from_json(name, ddl) if typed else json_fragments(name)
        for name, ddl in (("battle_teams", TEAMS_DDL), ("battle_players", PLAYERS_DDL))
        if name in logs.columns and isinstance(logs.schema[name].dataType, T.StringType)
    }
    return logs.withColumns(parsed) if parsed else logs


def cohort_filter(logs: DataFrame, params: CohortParams = CohortParams()) -> DataFrame:
    """Raw logs to cohort logs.

    Drops missing events, parses the roster texts to arrays, flags star players, turns
    ``battleTime`` into a date and assigns cohorts and row ids. No shuffle. A text that is
    not a log time raises wherever it sorts, or is dropped with ``bad_time='null'``; a row
    without a time is in no cohort and is dropped.
    """
    require_columns(logs.columns, ["battleTime", "player_id", "battle_starPlayer_tag"])
    if params.exclude_missing_events:
        logs = drop_missing_events(logs)
    logs = within_ranges(
        logs, "battleTime", params.ranges, params.closed, params.bad_time == "raise"
    )
    if isinstance(logs.schema["battleTime"].dataType, T.StringType):
        day = parse_log_day("battleTime", params.bad_time)
    else:
        day = F.col("battleTime").cast("date")
    logs = _parsed_rosters(logs, params.typed_rosters).withColumns(
        {
            "is_starPlayer": star_flag("battle_starPlayer_tag", "player_id"),
            "battleTime": day,
        }
    )
    return with_row_id(
        assign_cohorts(logs, "battleTime", params.ranges, params.closed)
    )
