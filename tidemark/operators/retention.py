"""D-day retention flags, session totals and retention ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import names_except, names_like, quoted
from tidemark.functions.nested import element
from tidemark.functions.numbers import safe_ratio
from tidemark.operators.activity import observed_days, player_days
from tidemark.operators.lookup import lookup_join
from tidemark.params import (
    ActivityParams,
    RatioParams,
    check_ratio_days,
    retention_days_of,
)

_KEYS = ("cohort", "player_id", "first_log")


def _any(condition: Column) -> Column:
    """Aggregate: TRUE when the condition holds on a row of the group."""
    return F.coalesce(F.max(condition), F.lit(False))


def _total(condition: Column, values: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, values)), F.lit(0))


def _finish(measured: DataFrame, days: Sequence[int]) -> DataFrame:
    """Flags and session totals from the aggregates ``_start``, ``_hit_d``, ``_sum_d``."""
    columns = []
    for d in days:
        kept = F.col("_start") & F.col(f"_hit_{d}")
        columns.append(F.when(kept, 1).otherwise(0).alias(f"D{d}R"))
        columns.append(
            F.when(kept, F.col(f"_sum_{d}")).otherwise(0).alias(f"D{d}_Sessions")
        )
    return measured.select(*_KEYS, *columns)


def _calendar(days: DataFrame, params: ActivityParams) -> DataFrame:
    day = F.col("days_to_return")
    aggregates = [_any(day == 0).alias("_start")]
    for d in params.days:
        reached = day >= d if params.mode == "rolling" else day == d
        aggregates.append(_any(reached).alias(f"_hit_{d}"))
        aggregates.append(
            _total(day <= d, F.col("daily_sessions")).alias(f"_sum_{d}")
        )
    return _finish(days.groupBy(*_KEYS).agg(*aggregates), params.days)


def _observed(
    days: DataFrame, params: ActivityParams, n_cohorts: int | None
) -> DataFrame:
    # Position p of a day in the cohort's list is at most d exactly when the day is at
    # most seen_days[d]; so each cohort needs a short list of thresholds, and no row
    # needs its own position.
    thresholds = observed_days(days).select(
        "cohort",
        element("seen_days", 0).alias("_first"),
        F.element_at("seen_days", -1).alias("_last"),
        F.size("seen_days").alias("_width"),
        *[element("seen_days", d).alias(f"_day_{d}") for d in params.days],
    )
    per_day = days.groupBy(*_KEYS, "days_to_return").agg(
        F.count("*").alias("active"), F.sum("daily_sessions").alias("sessions")
    )
    rows = lookup_join(per_day, thresholds, "cohort", "player_id", n_cohorts)

    day, once = F.col("days_to_return"), F.col("active") == 1
    aggregates = [_any(once & (day == F.col("_first"))).alias("_start")]
    for d in params.days:
        at_d = F.col(f"_day_{d}")
        if params.mode == "rolling":
            # The list end counts as reached for the first day number past the list.
            past_end = (F.col("_width") == d) & (day == F.col("_last"))
            reached = F.coalesce(day >= at_d, F.lit(False)) | past_end
        else:
            reached = day == at_d
        aggregates.append(_any(once & reached).alias(f"_hit_{d}"))
        upto = day <= F.coalesce(at_d, F.col("_last"))
        aggregates.append(_total(upto, F.col("sessions")).alias(f"_sum_{d}"))
    return _finish(rows.groupBy(*_KEYS).agg(*aggregates), params.days)


def user_activity(
    logs: DataFrame,
    params: ActivityParams = ActivityParams(),
    n_cohorts: int | None = None,
) -> DataFrame:
    """(cohort, player_id, first_log, D{d}R, D{d}_Sessions, ...) from cohort logs.

    ``D{d}R`` is 1 when the player was active on the first day and again on day d or
    later (``rolling``) or on day d (``exact``). ``D{d}_Sessions`` counts the sessions up
    to day d, and is 0 where the flag is 0. A player seen first in an earlier cohort has
    no first day in a later one, and so has 0 there.

    ``n_cohorts`` is the number of cohort ranges, if known; it only matters for
    ``day_index='observed'``, where it allows the per-cohort day list to be broadcast.
    """
    # Only the observed rule asks how many days of a week or month were active.
    observed = params.day_index == "observed"
    days = player_days(logs, params.frequency, params.first_log_scope, observed)
    if not observed:
        return _calendar(days, params)
    return _observed(days, params, n_cohorts)


def sum_columns(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Sum of each column per key, under its own name."""
    return df.groupBy(*keys).agg(*[F.sum(quoted(c)).alias(c) for c in columns])


def ratio_columns(
    columns: Sequence[str], params: RatioParams
) -> tuple[dict[str, Column], dict[str, Column]]:
    """Expressions over summed ``D{d}R`` columns: those that replace a count by a ratio,
    and the analytical ones that come on top. Every ratio is made from the counts."""
    analytical = params.analytical_ratios or ()
    check_ratio_days([*params.ratios, *analytical], retention_days_of(columns))

    def ratio(num: int, den: int) -> Column:
        return safe_ratio(F.col(f"D{num}R"), F.col(f"D{den}R"))

    replaced = {f"D{num}R": ratio(num, den) for num, den in params.ratios}
    added = {f"D{num}/D{den}": ratio(num, den) for num, den in analytical}
    return replaced, added


def with_ratios(sums: DataFrame, params: RatioParams) -> DataFrame:
    """Sums with their ratios: replaced columns in place, analytical ones at the end."""
    replaced, added = ratio_columns(sums.columns, params)
    kept = [replaced.get(c, quoted(c)).alias(c) for c in sums.columns]
    return sums.select(*kept, *[e.alias(name) for name, e in added.items()])


def ratio_register(
    activity: DataFrame, params: RatioParams = RatioParams()
) -> DataFrame:
    """Retention report per first day: ``D0R`` players, ``D{n}R`` ratios, summed
    sessions and analytical ratios, in order of the first day."""
    columns = names_except(activity, ["cohort", "player_id", "first_log"])
    sums = sum_columns(activity, ["first_log"], columns)
    return with_ratios(sums, params).orderBy("first_log")


def retention_columns(df: DataFrame) -> list[str]:
    """Names of the ``D{d}R`` columns."""
    return names_like(df, r"D\d+R")
