"""Retention by cluster."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.names import quoted
from tidemark.operators.retention import user_activity
from tidemark.operators.segments import (
    cluster_retention,
    label_activity,
    retention_chart,
)
from tidemark.params import ActivityParams
from tidemark.workload.retention import (
    EVENT_LOGS,
    RATIO_PARAMS,
    activity_sql,
    calendar_sql,
    ratio_sql,
)
from tidemark.workload.views import EVENT_DAYS, cluster_labels, event_cohorts

LAST_DAYS = 7


def _activity(spark, d, scope="cohort"):
    return user_activity(
        event_cohorts(spark, d),
        ActivityParams(days=EVENT_DAYS, first_log_scope=scope),
    )


def _activity_labels(spark, d):
    rows = label_activity(_activity(spark, d), cluster_labels(spark, d))
    return rows.select("cohort", "player_id", "first_log", "cluster_labels", "D0R", "D7R")


def _table(spark, d):
    return cluster_retention(
        _activity(spark, d), cluster_labels(spark, d), RATIO_PARAMS
    )


def _cluster_retention(spark, d):
    rows = _table(spark, d)
    doubles = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "double"]
    return rows.select(
        "cluster_labels",
        "first_log",
        *[F.round(quoted(c), 6).alias(c) for c in doubles],
    )


def _retention_chart(spark, d):
    chart = retention_chart(_table(spark, d), LAST_DAYS)
    return chart.withColumn("value", F.round("value", 6))


_LABELS = """labels AS (
    SELECT c_custkey AS player_id,
           CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey % 4 AS DOUBLE) END AS label
    FROM customer
    UNION ALL
    SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey % 4 AS DOUBLE) END
    FROM supplier
)"""


def _columns_sql() -> str:
    columns = ["1.0::DOUBLE AS D0R"]
    for num, den in RATIO_PARAMS.ratios:
        columns.append(f"{ratio_sql(f'sum(D{num}R)', f'sum(D{den}R)')} AS D{num}R")
    for num, den in RATIO_PARAMS.analytical_ratios:
        columns.append(
            f"{ratio_sql(f'sum(D{num}R)', f'sum(D{den}R)')} AS \"D{num}/D{den}\""
        )
    return ", ".join(columns)


_BASE = (
    activity_sql(EVENT_LOGS, calendar_sql(EVENT_DAYS), None, "player_id, cohort")
    + f", {_LABELS}"
)
_TABLE = f"""{_BASE}, report AS (
    SELECT CAST(label AS INT) AS cluster_labels, first_log, {_columns_sql()}
    FROM activity JOIN labels USING (player_id)
    WHERE label IS NOT NULL GROUP BY label, first_log
)"""

QUERIES = {
    "activity_labels": _activity_labels,
    "cluster_retention": _cluster_retention,
    "retention_chart": _retention_chart,
}

ORACLES = {
    "activity_labels": f"""{_BASE}
        SELECT cohort, player_id, first_log, label AS cluster_labels, D0R, D7R
        FROM activity LEFT JOIN labels USING (player_id)""",
    "cluster_retention": f"{_TABLE} SELECT * FROM report",
    "retention_chart": f"""{_TABLE},
        recent AS (
            SELECT * FROM report
            WHERE first_log >= (SELECT max(first_log) FROM report) - {LAST_DAYS}
        )
        SELECT cluster_labels, first_log, metric, value
        FROM (SELECT cluster_labels, first_log, {", ".join(f"D{d}R" for d in EVENT_DAYS)}
              FROM recent)
        UNPIVOT (value FOR metric IN ({", ".join(f"D{d}R" for d in EVENT_DAYS)}))""",
}
