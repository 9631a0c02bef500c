"""Retention by player cluster, and the data behind its chart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import days_before
from tidemark.functions.names import names_except, quoted
from tidemark.operators.retention import retention_columns, sum_columns, with_ratios
from tidemark.params import RatioParams


def label_activity(
    activity: DataFrame, labels: DataFrame, unique_labels: bool = False
) -> DataFrame:
    """Activity rows with their player's cluster label. A player without a label keeps
    its row; one with several labels has a row for each.

    Repeated labels are joined as one row with a weight, so one left join is enough and a
    player that fills the label table stays a few rows; its rows are repeated after the join.
    ``unique_labels`` skips that count when the label table has one row per player.
    """
    labels = labels.select("player_id", "cluster_labels")
    if unique_labels:
        return activity.join(labels, "player_id", "left")
    weighted = labels.groupBy("player_id", "cluster_labels").agg(
        F.count("*").cast("int").alias("_weight")
    )
    joined = activity.join(weighted, "player_id", "left")
    copies = F.array_repeat(F.lit(0), F.coalesce("_weight", F.lit(1)))
    return joined.withColumn("_copy", F.explode(copies)).drop("_weight", "_copy")


def cluster_retention(
    activity: DataFrame,
    labels: DataFrame,
    params: RatioParams = RatioParams(),
    unique_labels: bool = False,
) -> DataFrame:
    """Retention ratios per cluster and first day, in order of day and cluster.

    Players without a label are left out, and ``D0R`` is 1.0 throughout. Repeated labels
    count once each: they are joined as one row with a weight, so a player that fills a
    large share of the label table stays one row. ``unique_labels`` skips that count when
    the label table has one row per player.
    """
    columns = retention_columns(activity)
    weighted = labels.select("player_id", "cluster_labels").dropna(
        subset=["cluster_labels"]
    )
    if unique_labels:
        weighted = weighted.withColumn("_weight", F.lit(1))
    else:
        weighted = weighted.groupBy("player_id", "cluster_labels").agg(
            F.count("*").alias("_weight")
        )
    rows = (
        activity.select("player_id", "first_log", *columns)
        .join(weighted, "player_id")
        .select(
            F.col("cluster_labels").cast("int").alias("cluster_labels"),
            "first_log",
            *[(F.col(c) * F.col("_weight")).alias(c) for c in columns],
        )
    )
    sums = sum_columns(rows, ["cluster_labels", "first_log"], columns)
    return (
        with_ratios(sums, params)
        .withColumn("D0R", F.lit(1.0))
        .orderBy("first_log", "cluster_labels")
    )


def retention_chart(table: DataFrame, last_days: int = 30) -> DataFrame:
    """(cluster_labels, first_log, metric, value): chart points of the last days.

    The window reaches back ``last_days`` from the newest first day, which is looked up in
    the sums, one row per cluster and day.
    """
    sums = sum_columns(
        table,
        ["cluster_labels", "first_log"],
        names_except(table, ["cluster_labels", "first_log"]),
    ).withColumn("first_log", F.col("first_log").cast("date"))
    newest = F.max("first_log").over(Window.partitionBy())
    columns = retention_columns(table)
    return (
        sums.withColumn("_newest", newest)
        .filter(F.col("first_log") >= days_before(F.col("_newest"), last_days))
        .select(
            "cluster_labels",
            "first_log",
            *[quoted(c).cast("double").alias(c) for c in columns],
        )
        .unpivot(["cluster_labels", "first_log"], columns, "metric", "value")
    )
