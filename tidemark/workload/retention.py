"""Cohorts, activity, retention and ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import (
    days_between,
    format_day,
    log_time_text,
    parse_log_day,
    text_to_day,
)
from tidemark.functions.names import quoted
from tidemark.operators.activity import (
    activity_pivot,
    daily_sessions,
    observed_positions,
    player_days,
    with_bucket,
    with_first_log,
)
from tidemark.operators.bitmaps import (
    activity_bitmaps,
    activity_state,
    advance_state,
    retention_of_bitmaps,
    user_activity_of_state,
)
from tidemark.operators.cohorts import (
    assign_cohorts,
    cohort_filter,
    cohorts_of,
    drop_missing_events,
    filter_cohort,
    keep_modes,
    star_flag,
    with_row_id,
)
from tidemark.operators.ordering import with_gapless_id
from tidemark.operators.retention import ratio_register, user_activity
from tidemark.operators.shape import union_by_position
from tidemark.params import ActivityParams, CohortParams, RatioParams
from tidemark.sources.layout import shared_folder
from tidemark.sources.readers import read_parquet
from tidemark.sources.writers import write_parquet
from tidemark.workload.views import (
    EVENT_DAYS,
    EVENT_RANGES,
    MODES,
    ORDER_RANGES,
    event_cohorts,
    order_cohorts,
    raw_logs,
    table,
)

RATIO_PARAMS = RatioParams(
    ratios=((1, 0), (3, 0), (7, 0), (14, 0), (28, 0)),
    analytical_ratios=((3, 1), (7, 3), (28, 7)),
)
WEEK_DAYS = (0, 7, 28, 56, 84, 168)
OBSERVED_DAYS = (0, 1, 3, 7, 14, 30)


# ---------------------------------------------------------------- SQL building blocks


def ranges_sql(ranges) -> str:
    rows = ", ".join(
        f"({i}, DATE '{lo}', DATE '{hi}')" for i, (lo, hi) in enumerate(ranges, 1)
    )
    return f"ranges(cohort, lo, hi) AS (VALUES {rows})"


def logs_sql(source: str, player: str, stamp: str, ranges, where: str = "TRUE") -> str:
    """CTEs ``ranges`` and ``logs(cohort, player_id, day)``."""
    return f"""{ranges_sql(ranges)},
    logs AS (
        SELECT CAST(cohort AS INT) AS cohort, {player} AS player_id,
               CAST({stamp} AS DATE) AS day
        FROM {source} JOIN ranges
          ON CAST({stamp} AS DATE) > lo AND CAST({stamp} AS DATE) < hi
        WHERE {where}
    )"""


EVENT_LOGS = logs_sql("events", "user_id", "ts", EVENT_RANGES)
PURCHASE_LOGS = logs_sql(
    "events", "user_id", "ts", EVENT_RANGES, "event_type = 'purchase'"
)
ORDER_LOGS = logs_sql("orders", "o_custkey", "o_orderdate", ORDER_RANGES)


def player_days_sql(unit: str | None = None, scope: str = "player_id") -> str:
    """CTE ``player_days`` over ``logs``."""
    bucket = f"CAST(date_trunc('{unit}', day) AS DATE)" if unit else "day"
    return f"""daily AS (
        SELECT cohort, day, player_id, count(*) AS sessions, {bucket} AS bucket
        FROM logs GROUP BY cohort, day, player_id
    ),
    firsts AS (
        SELECT *, min(bucket) OVER (PARTITION BY {scope}) AS first_log FROM daily
    ),
    player_days AS (
        SELECT cohort, player_id, first_log,
               date_diff('day', first_log, bucket) AS d, sessions
        FROM firsts
    )"""


def _columns_sql(days, flag, total) -> str:
    parts = []
    for d in days:
        parts.append(f"CAST(CASE WHEN {flag(d)} THEN 1 ELSE 0 END AS INT) AS D{d}R")
        parts.append(
            f"CAST(CASE WHEN {flag(d)} THEN {total(d)} ELSE 0 END AS BIGINT) "
            f"AS D{d}_Sessions"
        )
    return ", ".join(parts)


def calendar_sql(days, mode: str = "rolling") -> str:
    """CTE ``activity`` over ``player_days``: the calendar rule."""
    sign = ">=" if mode == "rolling" else "="
    columns = _columns_sql(
        days,
        lambda d: f"bool_or(d = 0) AND bool_or(d {sign} {d})",
        lambda d: f"sum(CASE WHEN d <= {d} THEN sessions ELSE 0 END)",
    )
    return f"""activity AS (
        SELECT cohort, player_id, first_log, {columns}
        FROM player_days GROUP BY cohort, player_id, first_log
    )"""


def observed_sql(days, mode: str = "rolling") -> str:
    """CTE ``activity`` over ``player_days``: the rule by observed position, with an
    explicit position per row and the list width."""

    def flag(d):
        if mode == "exact":
            return f"coalesce(max(v) FILTER (p = 0), 0) = 1 AND coalesce(max(v) FILTER (p = {d}), 0) = 1"
        top = "coalesce(max(p) FILTER (v = 1), -1)"
        return (
            "coalesce(max(v) FILTER (p = 0), 0) = 1 AND "
            f"({d} <= {top} OR ({d} = max(width) AND {top} = max(width) - 1))"
        )

    columns = _columns_sql(
        days, flag, lambda d: f"coalesce(sum(s) FILTER (p <= {d}), 0)"
    )
    return f"""positions AS (
        SELECT cohort, d, dense_rank() OVER (PARTITION BY cohort ORDER BY d) - 1 AS p,
               count(*) OVER (PARTITION BY cohort) AS width
        FROM (SELECT DISTINCT cohort, d FROM player_days) AS pairs
    ),
    placed AS (
        SELECT cohort, player_id, first_log, p, width, count(*) AS v, sum(sessions) AS s
        FROM player_days JOIN positions USING (cohort, d)
        GROUP BY cohort, player_id, first_log, p, width
    ),
    activity AS (
        SELECT cohort, player_id, first_log, {columns}
        FROM placed GROUP BY cohort, player_id, first_log
    )"""


def activity_sql(logs: str, rule: str, unit=None, scope: str = "player_id") -> str:
    return f"WITH {logs}, {player_days_sql(unit, scope)}, {rule}"


def ratio_sql(num: str, den: str) -> str:
    return (
        f"round(CASE WHEN {den} IS NULL OR {den} = 0 THEN 0.0 "
        f"ELSE CAST({num} AS DOUBLE) / {den} END, 6)"
    )


# ------------------------------------------------------------------------------ queries


def _daily_sessions(spark, d):
    return daily_sessions(event_cohorts(spark, d))


def _first_activity(frequency):
    def query(spark, d):
        rows = with_first_log(
            with_bucket(daily_sessions(order_cohorts(spark, d)), frequency)
        )
        return rows.select(
            "cohort",
            "player_id",
            "battleTime",
            "bucket",
            "first_log",
            days_between("bucket", "first_log").alias("days_to_return"),
        )

    return query


def _first_activity_sql(unit):
    return f"""WITH {ORDER_LOGS}, {player_days_sql(unit)}
        SELECT cohort, player_id, day AS battleTime, bucket, first_log,
               CAST(date_diff('day', first_log, bucket) AS INT) AS days_to_return
        FROM firsts"""


def _cohort_ranges(spark, d):
    return event_cohorts(spark, d)


def _cohort_ranges_closed(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", F.col("ts").cast("date").alias("day")
    )
    return assign_cohorts(rows, "day", EVENT_RANGES, closed="both")


# More ranges than a range join takes, in January 2024.
MANY_RANGES = tuple(
    (f"2024-01-{first:02d}", f"2024-01-{first + length:02d}")
    for length in range(5)
    for first in range(1, 21)
)


def _cohort_ranges_many(spark, d):
    rows = table(spark, d, "events").select("event_id", "ts")
    return assign_cohorts(rows, "ts", MANY_RANGES, closed="both").select("event_id", "cohort")


def _distinct_cohorts(spark, d):
    return cohorts_of(event_cohorts(spark, d))


def _cohort_union(spark, d):
    logs = event_cohorts(spark, d)
    parts = [
        filter_cohort(logs, c).select(
            "player_id", "battleTime", F.lit(c * 10).alias("part")
        )
        for c in (1, 2)
    ]
    return union_by_position(parts)


def _battle_time_parse(spark, d):
    rows = raw_logs(spark, d).select("battleTime", "player_id")
    day = parse_log_day("battleTime")
    return rows.select(
        "battleTime",
        "player_id",
        day.alias("day"),
        format_day(day).alias("day_text"),
        text_to_day(format_day(day)).alias("day_again"),
        log_time_text("battleTime").alias("time_text"),
    )


def _row_ids(spark, d):
    rows = with_row_id(table(spark, d, "orders").select("o_orderkey"), "row_id")
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_distinct("row_id").alias("n_ids")
    )


def _star_flag(spark, d):
    logs = drop_missing_events(raw_logs(spark, d))
    return logs.select(
        "event_id",
        "player_id",
        star_flag("battle_starPlayer_tag", "player_id").alias("is_starPlayer"),
    )


def _family_split(spark, d):
    logs = raw_logs(spark, d)
    families = {
        "solo": ("soloShowdown",),
        "team": ("duoShowdown", "gemGrab"),
        "special": ("bossFight",),
    }
    parts = [
        keep_modes(logs, modes).select(
            F.lit(name).alias("family"), "event_mode", "player_id", "battleTime"
        )
        for name, modes in families.items()
    ]
    return union_by_position(parts)


def _cohort_filter(spark, d):
    logs = cohort_filter(raw_logs(spark, d), CohortParams(ranges=EVENT_RANGES))
    return logs.select(
        "cohort",
        "battleTime",
        "player_id",
        "event_id",
        "event_mode",
        "is_starPlayer",
        F.size("battle_teams").alias("n_teams"),
        F.array_join("battle_players", "|").alias("players_text"),
    )


def _activity(logs, params, n_cohorts=None):
    def query(spark, d):
        return user_activity(logs(spark, d), params, n_cohorts)

    return query


def _purchases(spark, d):
    return event_cohorts(spark, d, "purchase")


# Days from the first to the last day of the order ranges, and lists of days within.
ORDER_SPAN = 2557
FAR_DAYS = (0, 1, 31, 63, 64, 92, 365, 1000)


def _stored(spark, rows):
    path = shared_folder(spark)
    write_parquet(rows, path)
    return read_parquet(spark, path)


def order_bitmaps(spark, d):
    """Stored bitmaps of the orders, from which any list of days is read."""
    return _stored(spark, activity_bitmaps(player_days(order_cohorts(spark, d)), ORDER_SPAN))


def _bitmap_retention(days, mode):
    def query(spark, d):
        return retention_of_bitmaps(order_bitmaps(spark, d), days, mode)

    return query


# Orders that a stored state has seen, and the rest: by day, and late rows of any day.
BEFORE_CUT = "o_orderdate < DATE '1998-01-01'"
ON_TIME = "o_orderkey % 3 <> 0"


def _advanced(seen, params):
    def query(spark, d):
        state = _stored(spark, activity_state(order_cohorts(spark, d, seen), ORDER_SPAN, params.frequency))
        rest = order_cohorts(spark, d, f"NOT ({seen})")
        state = advance_state(state, rest, ORDER_SPAN, params.frequency)
        return user_activity_of_state(state, params)

    return query


def _flags_only(query):
    def flags(spark, d):
        rows = query(spark, d)
        return rows.select(*[c for c in rows.columns if not c.endswith("_Sessions")])

    return flags


def _flags_sql(days) -> str:
    return "cohort, player_id, first_log, " + ", ".join(f"D{d}R" for d in days)


def _sessions_only(spark, d):
    rows = user_activity(event_cohorts(spark, d), ActivityParams(days=EVENT_DAYS))
    return rows.select(
        "cohort", "player_id", *[c for c in rows.columns if c.endswith("_Sessions")]
    )


def _observed_positions(spark, d):
    return observed_positions(player_days(_purchases(spark, d)))


def _observed_positions_all(spark, d):
    return observed_positions(player_days(event_cohorts(spark, d)))


def _gapless_ids(spark, d):
    """Numbers by day and key, from rows that were dealt anew."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate").repartition(7)
    return with_gapless_id(orders, ["o_orderdate"], "row_id").select("o_orderkey", "row_id")


def _rounded(df):
    return df.select(
        *[
            F.round(quoted(f.name), 6).alias(f.name)
            if f.dataType.simpleString() == "double"
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def cohort_ratios(spark, d):
    """Flagship: events to cohorts, daily activity, retention flags, sums and ratios."""
    activity = user_activity(event_cohorts(spark, d), ActivityParams(days=EVENT_DAYS))
    return _rounded(ratio_register(activity, RATIO_PARAMS))


def _report_sql() -> str:
    ratios = dict(RATIO_PARAMS.ratios)
    columns = []
    for d in EVENT_DAYS:
        count = f"sum(D{d}R)"
        columns.append(
            f"{ratio_sql(count, f'sum(D{ratios[d]}R)')} AS D{d}R"
            if d in ratios
            else f"CAST({count} AS BIGINT) AS D{d}R"
        )
        columns.append(f"CAST(sum(D{d}_Sessions) AS BIGINT) AS D{d}_Sessions")
    for num, den in RATIO_PARAMS.analytical_ratios:
        columns.append(
            f"{ratio_sql(f'sum(D{num}R)', f'sum(D{den}R)')} AS \"D{num}/D{den}\""
        )
    return f"SELECT first_log, {', '.join(columns)} FROM activity GROUP BY first_log"


# All days between two days of the event table.
PIVOT_DAYS = tuple(range(30))


def _activity_pivot(spark, d):
    return activity_pivot(player_days(event_cohorts(spark, d)), PIVOT_DAYS)


def _pivot_sql() -> str:
    columns = ", ".join(
        f'nullif(count(*) FILTER (d = {n}), 0) AS "{n}_day", '
        f'CAST(sum(sessions) FILTER (d = {n}) AS BIGINT) AS "{n}_day_sessions"'
        for n in PIVOT_DAYS
    )
    return f"""WITH {EVENT_LOGS}, {player_days_sql()}
        SELECT player_id, first_log, {columns}
        FROM player_days GROUP BY player_id, first_log"""


_MODE_SQL = (
    "CASE event_type "
    + " ".join(f"WHEN '{t}' THEN '{m}'" for t, m in MODES.items())
    + " END"
)
_K_SQL = "CAST(json_extract_string(props, '$.k') AS INT)"
# The raw-log stand-in in SQL, with the size of its rosters.
RAW_SQL = f"""raw AS (
    SELECT ts, user_id, event_type, {_K_SQL} AS k,
           CAST(floor({_K_SQL} / 20.0) AS INT) AS size,
           '#' || user_id AS player_id,
           strftime(ts, '%Y%m%dT%H%M%S.%gZ') AS battle_time,
           CASE WHEN event_type = 'error' THEN 0
                WHEN {_K_SQL} < 90 THEN event_id + 1 END AS event_id,
           {_MODE_SQL} AS event_mode,
           CAST(floor(value) AS BIGINT) AS trophies,
           CASE WHEN {_K_SQL} >= 10 THEN '#' || {_K_SQL} END AS star
    FROM events
)"""

_STAR_SQL = "CAST(CASE WHEN star = player_id THEN 1 ELSE 0 END AS INT)"


def player_json_sql(tag: str, name: str) -> str:
    return (
        f"""'{{"tag":"' || {tag} || '","brawler":{{"name":"' || {name} || '"}}}}'"""
    )


_PLAYERS_TEXT_SQL = f"""CASE WHEN k < 80 THEN array_to_string(([
    {player_json_sql("player_id", "upper(event_type)")},
    {player_json_sql("'#' || k", "'K' || k")},
    {player_json_sql("'#' || (user_id + k)", "'THIRD'")}])[1:size], '|') END"""

QUERIES = {
    "daily_sessions": _daily_sessions,
    "weekly_first_activity": _first_activity("weekly"),
    "monthly_first_activity": _first_activity("monthly"),
    "cohort_ranges": _cohort_ranges,
    "cohort_ranges_closed": _cohort_ranges_closed,
    "cohort_ranges_many": _cohort_ranges_many,
    "distinct_cohorts": _distinct_cohorts,
    "cohort_union": _cohort_union,
    "battle_time_parse": _battle_time_parse,
    "row_ids": _row_ids,
    "star_flag": _star_flag,
    "event_family_split": _family_split,
    "cohort_filter": _cohort_filter,
    "retention_rolling": _flags_only(
        _activity(event_cohorts, ActivityParams(days=EVENT_DAYS))
    ),
    "retention_exact": _flags_only(
        _activity(event_cohorts, ActivityParams(days=EVENT_DAYS, mode="exact"))
    ),
    "retention_observed": _activity(
        _purchases,
        ActivityParams(days=EVENT_DAYS, day_index="observed"),
        len(EVENT_RANGES),
    ),
    "retention_observed_all": _activity(
        event_cohorts,
        ActivityParams(days=EVENT_DAYS, day_index="observed"),
        len(EVENT_RANGES),
    ),
    "retention_observed_exact_all": _activity(
        event_cohorts,
        ActivityParams(days=EVENT_DAYS, day_index="observed", mode="exact"),
        len(EVENT_RANGES),
    ),
    "retention_observed_salted": _activity(
        order_cohorts, ActivityParams(days=OBSERVED_DAYS, day_index="observed")
    ),
    "retention_observed_exact": _activity(
        _purchases,
        ActivityParams(days=EVENT_DAYS, day_index="observed", mode="exact"),
        len(EVENT_RANGES),
    ),
    "retention_observed_weekly": _activity(
        order_cohorts,
        ActivityParams(frequency="weekly", days=OBSERVED_DAYS, day_index="observed"),
        len(ORDER_RANGES),
    ),
    "retention_sessions": _sessions_only,
    "observed_positions": _observed_positions,
    "observed_positions_all": _observed_positions_all,
    "row_ids_gapless": _gapless_ids,
    "bitmap_retention": _bitmap_retention(FAR_DAYS, "rolling"),
    "bitmap_retention_exact": _bitmap_retention(WEEK_DAYS, "exact"),
    "state_advanced": _advanced(BEFORE_CUT, ActivityParams(days=FAR_DAYS)),
    "state_late_rows": _advanced(ON_TIME, ActivityParams(days=WEEK_DAYS, mode="exact")),
    "state_weekly": _advanced(ON_TIME, ActivityParams("weekly", days=WEEK_DAYS)),
    "user_activity": _activity(event_cohorts, ActivityParams(days=EVENT_DAYS)),
    "user_activity_weekly": _activity(
        order_cohorts, ActivityParams(frequency="weekly", days=WEEK_DAYS)
    ),
    "user_activity_monthly": _activity(
        order_cohorts,
        ActivityParams(frequency="monthly", days=(0, 31, 92, 365)),
    ),
    "user_activity_cohort_scope": _activity(
        order_cohorts, ActivityParams(days=WEEK_DAYS, first_log_scope="cohort")
    ),
    "cohort_ratios": cohort_ratios,
    "activity_pivot": _activity_pivot,
}

ORACLES = {
    "daily_sessions": f"""WITH {EVENT_LOGS}
        SELECT cohort, day AS battleTime, player_id, count(*) AS daily_sessions
        FROM logs GROUP BY cohort, day, player_id""",
    "weekly_first_activity": _first_activity_sql("week"),
    "monthly_first_activity": _first_activity_sql("month"),
    "cohort_ranges": f"""WITH {EVENT_LOGS}
        SELECT player_id, day AS battleTime, cohort FROM logs""",
    "cohort_ranges_closed": f"""WITH {ranges_sql(EVENT_RANGES)}
        SELECT event_id, CAST(ts AS DATE) AS day, CAST(cohort AS INT) AS cohort
        FROM events JOIN ranges ON CAST(ts AS DATE) BETWEEN lo AND hi""",
    "cohort_ranges_many": f"""WITH {ranges_sql(MANY_RANGES)}
        SELECT event_id, CAST(cohort AS INT) AS cohort
        FROM events JOIN ranges ON CAST(ts AS DATE) BETWEEN lo AND hi""",
    "distinct_cohorts": f"WITH {EVENT_LOGS} SELECT DISTINCT cohort FROM logs",
    "cohort_union": f"""WITH {EVENT_LOGS}
        SELECT player_id, day AS battleTime, CAST(10 AS INT) AS part
        FROM logs WHERE cohort = 1
        UNION ALL
        SELECT player_id, day, 20 FROM logs WHERE cohort = 2""",
    "battle_time_parse": f"""WITH {RAW_SQL}
        SELECT battle_time AS battleTime, player_id, CAST(ts AS DATE) AS day,
               strftime(ts, '%Y-%m-%d') AS day_text, CAST(ts AS DATE) AS day_again,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text
        FROM raw""",
    "row_ids": "SELECT count(*) AS n_rows, count(*) AS n_ids FROM orders",
    "star_flag": f"""WITH {RAW_SQL}
        SELECT event_id, player_id, {_STAR_SQL} AS "is_starPlayer"
        FROM raw WHERE event_id <> 0""",
    "event_family_split": f"""WITH {RAW_SQL}
        SELECT 'solo' AS family, event_mode, player_id, battle_time AS battleTime
        FROM raw WHERE event_mode IN ('soloShowdown')
        UNION ALL
        SELECT 'team', event_mode, player_id, battle_time
        FROM raw WHERE event_mode IN ('duoShowdown', 'gemGrab')
        UNION ALL
        SELECT 'special', event_mode, player_id, battle_time
        FROM raw WHERE event_mode IN ('bossFight')""",
    "cohort_filter": f"""WITH {RAW_SQL}, {ranges_sql(EVENT_RANGES)}
        SELECT CAST(cohort AS INT) AS cohort, CAST(ts AS DATE) AS battleTime, player_id,
               event_id, event_mode, {_STAR_SQL} AS "is_starPlayer",
               CAST(CASE WHEN k < 80 THEN 2 END AS INT) AS n_teams,
               {_PLAYERS_TEXT_SQL} AS players_text
        FROM raw JOIN ranges ON CAST(ts AS DATE) > lo AND CAST(ts AS DATE) < hi
        WHERE event_id <> 0""",
    "retention_rolling": activity_sql(EVENT_LOGS, calendar_sql(EVENT_DAYS))
    + f" SELECT {_flags_sql(EVENT_DAYS)} FROM activity",
    "retention_exact": activity_sql(EVENT_LOGS, calendar_sql(EVENT_DAYS, "exact"))
    + f" SELECT {_flags_sql(EVENT_DAYS)} FROM activity",
    "retention_observed": activity_sql(PURCHASE_LOGS, observed_sql(EVENT_DAYS))
    + " SELECT * FROM activity",
    "retention_observed_all": activity_sql(EVENT_LOGS, observed_sql(EVENT_DAYS))
    + " SELECT * FROM activity",
    "retention_observed_salted": activity_sql(ORDER_LOGS, observed_sql(OBSERVED_DAYS))
    + " SELECT * FROM activity",
    "retention_observed_exact": activity_sql(
        PURCHASE_LOGS, observed_sql(EVENT_DAYS, "exact")
    )
    + " SELECT * FROM activity",
    "retention_observed_weekly": activity_sql(
        ORDER_LOGS, observed_sql(OBSERVED_DAYS), "week"
    )
    + " SELECT * FROM activity",
    "retention_sessions": activity_sql(EVENT_LOGS, calendar_sql(EVENT_DAYS))
    + " SELECT cohort, player_id, "
    + ", ".join(f"D{d}_Sessions" for d in EVENT_DAYS)
    + " FROM activity",
    "observed_positions_all": f"""WITH {EVENT_LOGS}, {player_days_sql()},
        pairs AS (SELECT DISTINCT cohort, d FROM player_days)
        SELECT cohort, CAST(d AS INT) AS days_to_return,
               CAST(dense_rank() OVER (PARTITION BY cohort ORDER BY d) - 1 AS INT)
                   AS position,
               CAST(count(*) OVER (PARTITION BY cohort) AS INT) AS width
        FROM pairs""",
    "row_ids_gapless": """SELECT o_orderkey,
        row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id FROM orders""",
    "retention_observed_exact_all": activity_sql(
        EVENT_LOGS, observed_sql(EVENT_DAYS, "exact")
    )
    + " SELECT * FROM activity",
    "observed_positions": f"""WITH {PURCHASE_LOGS}, {player_days_sql()},
        pairs AS (SELECT DISTINCT cohort, d FROM player_days)
        SELECT cohort, CAST(d AS INT) AS days_to_return,
               CAST(dense_rank() OVER (PARTITION BY cohort ORDER BY d) - 1 AS INT)
                   AS position,
               CAST(count(*) OVER (PARTITION BY cohort) AS INT) AS width
        FROM pairs""",
    "bitmap_retention": activity_sql(ORDER_LOGS, calendar_sql(FAR_DAYS))
    + " SELECT * FROM activity",
    "bitmap_retention_exact": activity_sql(ORDER_LOGS, calendar_sql(WEEK_DAYS, "exact"))
    + " SELECT * FROM activity",
    "state_advanced": activity_sql(ORDER_LOGS, calendar_sql(FAR_DAYS))
    + " SELECT * FROM activity",
    "state_late_rows": activity_sql(ORDER_LOGS, calendar_sql(WEEK_DAYS, "exact"))
    + " SELECT * FROM activity",
    "state_weekly": activity_sql(ORDER_LOGS, calendar_sql(WEEK_DAYS), "week")
    + " SELECT * FROM activity",
    "user_activity": activity_sql(EVENT_LOGS, calendar_sql(EVENT_DAYS))
    + " SELECT * FROM activity",
    "user_activity_weekly": activity_sql(ORDER_LOGS, calendar_sql(WEEK_DAYS), "week")
    + " SELECT * FROM activity",
    "user_activity_monthly": activity_sql(
        ORDER_LOGS, calendar_sql((0, 31, 92, 365)), "month"
    )
    + " SELECT * FROM activity",
    "user_activity_cohort_scope": activity_sql(
        ORDER_LOGS, calendar_sql(WEEK_DAYS), None, "player_id, cohort"
    )
    + " SELECT * FROM activity",
    "cohort_ratios": activity_sql(EVENT_LOGS, calendar_sql(EVENT_DAYS))
    + " "
    + _report_sql(),
    "activity_pivot": _pivot_sql(),
}
