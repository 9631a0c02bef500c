"""Where the tables of a run are stored, and shared space for intermediate ones."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Layer of each table of a run.
LAYERS = {
    "raw": ("player_tags", "battle_logs", "profiles"),
    "primary": (
        "cohort_logs",
        "profiles_prepared",
        "event_rosters",
        "user_activity",
        "cohort_activity",
    ),
    "model_input": ("profiles_scaled",),
    "feature": ("profiles_reduced", "features_selected"),
    "models": ("kmeans_model", "best_params", "eval_params"),
    "model_output": ("metrics", "profiles_clustered", "cluster_activity"),
    "reporting": ("inertia_curve", "centroid_pairs", "retention_chart"),
}

_LAYER_OF = {name: layer for layer, names in LAYERS.items() for name in names}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def table_path(base: str, name: str) -> str:
    """Path of a table under a base path; the base may be any Hadoop file system URI."""
    return f"{base.rstrip('/')}/{_LAYER_OF[name]}/{name}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, visible to all executors.

    It lies under the session's ``spark.checkpoint.dir``. Only a local session may do
    without that setting; it gets a temporary folder that goes with the process.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)  # set by the cluster
    if base:
        return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, True)
    return folder
