"""The flows of a run as functions. Each table is written once and read back by the next
step, so a lost executor costs tasks and never a whole lineage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.clusters import (
    GridResult,
    assign_clusters,
    centroid_pairs,
    kmeans_grid,
)
from tidemark.operators.cohorts import cohort_filter
from tidemark.operators.features import (
    prepare_profiles,
    scale_max_abs,
    select_features,
)
from tidemark.operators.quality import as_points, cluster_metrics
from tidemark.operators.retention import ratio_register, user_activity
from tidemark.operators.rosters import split_event_families
from tidemark.operators.segments import cluster_retention, retention_chart
from tidemark.operators.shape import require_rows
from tidemark.params import (
    PROFILE_DDL,
    ActivityParams,
    ClusterParams,
    CohortParams,
    FamilyParams,
    RatioParams,
)
from tidemark.sources.layout import table_path
from tidemark.sources.writers import (
    append_version,
    write_csv,
    write_model,
    write_parquet,
    write_record,
)


@dataclass(frozen=True)
class RunParams:
    """Parameters of a whole run. ``label`` is the class column of feature selection, one
    of the columns of ``profile_ddl``; without one features are selected by variance."""

    label: str | None = None
    profile_ddl: str = PROFILE_DDL
    cohorts: CohortParams = field(default_factory=CohortParams)
    families: FamilyParams = field(default_factory=FamilyParams)
    activity: ActivityParams = field(default_factory=ActivityParams)
    ratios: RatioParams = field(default_factory=RatioParams)
    clusters: ClusterParams = field(default_factory=ClusterParams)
    last_days: int = 30


def _stored(df: DataFrame, base: str, name: str) -> DataFrame:
    path = table_path(base, name)
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def _stored_and_counted(
    df: DataFrame, base: str, name: str, partition_by: Sequence[str]
) -> tuple[DataFrame, int]:
    """The stored table, and its rows as the write has seen them."""
    path, counts = table_path(base, name), Observation()
    observed = df.observe(counts, F.count(F.lit(1)).alias("rows"))
    write_parquet(observed, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path), counts.get["rows"]


def retention_flow(
    logs: DataFrame, base: str, params: RunParams
) -> dict[str, DataFrame]:
    """Raw logs to cohort logs, event tables, user activity and the ratio report."""
    cohort_logs, n_logs = _stored_and_counted(
        cohort_filter(logs, params.cohorts), base, "cohort_logs", ["cohort"]
    )
    if not n_logs:
        # The write tells; only where it has no row the input is looked at.
        require_rows(logs, "battle logs")
    tables = {"cohort_logs": cohort_logs}
    # One pass and one table, with a folder for each family.
    families = split_event_families(
        cohort_logs, params.families, table_path(base, "event_rosters")
    )
    tables.update({f"event_{family}": table for family, table in families.items()})
    tables["user_activity"] = _stored(
        user_activity(cohort_logs, params.activity, len(params.cohorts.ranges)),
        base,
        "user_activity",
    )
    tables["cohort_activity"] = _stored(
        ratio_register(tables["user_activity"], params.ratios), base, "cohort_activity"
    )
    return tables


def cluster_flow(
    profiles: DataFrame, base: str, params: RunParams, version: str
) -> tuple[dict[str, DataFrame], GridResult]:
    """Prepared profiles to scaled and selected features, a fitted model, its reports, and
    one label per player. Profiles hold ``player_id``, the label if any, and numeric features."""
    spark = profiles.sparkSession
    scaled = _stored(
        scale_max_abs(profiles, ["player_id", *([params.label] if params.label else [])]),
        base,
        "profiles_scaled",
    )
    reduced, names = select_features(
        scaled, params.label, params.clusters.top_features
    )
    reduced = _stored(reduced, base, "profiles_reduced")
    write_record(
        spark.createDataFrame([(names,)], "features_selected array<string>"),
        table_path(base, "features_selected"),
    )

    grid = kmeans_grid(reduced, names, params.clusters)
    write_model(grid.model, table_path(base, "kmeans_model"))
    write_record(grid.best_params, table_path(base, "best_params"))
    write_record(grid.eval_params, table_path(base, "eval_params"))
    append_version(grid.curve, table_path(base, "inertia_curve"), version)

    clustered = _stored(
        assign_clusters(reduced, grid.model, names), base, "profiles_clustered"
    )
    metrics = cluster_metrics(as_points(clustered, names), grid.model.getK())
    write_record(metrics, table_path(base, "metrics"))
    append_version(
        centroid_pairs(reduced, grid.model, names),
        table_path(base, "centroid_pairs"),
        version,
    )
    tables = {
        "profiles_scaled": scaled,
        "profiles_reduced": reduced,
        "profiles_clustered": clustered,
        "metrics": spark.read.json(table_path(base, "metrics")),
    }
    return tables, grid


def segment_flow(
    activity: DataFrame,
    clustered: DataFrame,
    base: str,
    params: RunParams,
    version: str,
) -> dict[str, DataFrame]:
    """User activity and cluster labels to retention by cluster and its chart data."""
    table = cluster_retention(activity, clustered, params.ratios)
    write_csv(table, table_path(base, "cluster_activity"))
    stored = table.sparkSession.read.csv(
        table_path(base, "cluster_activity"), header=True, schema=table.schema
    )
    chart = retention_chart(stored, params.last_days)
    append_version(chart, table_path(base, "retention_chart"), version)
    return {"cluster_activity": stored, "retention_chart": chart}


def run(
    logs: DataFrame,
    profiles: DataFrame,
    base: str,
    params: RunParams,
    version: str | None = None,
) -> dict[str, DataFrame]:
    """The whole run, from raw logs and raw profiles to the reports."""
    if version is None:
        version = dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")
    tables = retention_flow(logs, base, params)
    prepared = _stored(
        prepare_profiles(profiles, params.profile_ddl, keep=[params.label] if params.label else []),
        base,
        "profiles_prepared",
    )
    clusters, _ = cluster_flow(prepared, base, params, version)
    tables.update(clusters)
    tables.update(
        segment_flow(
            tables["user_activity"],
            clusters["profiles_clustered"],
            base,
            params,
            version,
        )
    )
    return tables
