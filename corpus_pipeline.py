"""From raw documents to shards: the stages of the training-data pipeline.

Each stage takes the documents that the stage before has kept and returns documents with the
same columns; the last one adds each row's shard and its place there. ``run`` writes every
stage to the shared folder and reads it back, so that a lost executor costs tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import is_class, store, table
from tidemark.llm.decontamination import without_leaks
from tidemark.llm.dedup import without_near_duplicates
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.quality import good_documents
from tidemark.llm.sharding import assign_shards

SHARDS = 40
# Near duplicates share at least so many percent of their five-word shingles.
NEAR_PERCENT = 80
COLUMNS = ("text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than not; learns from labels that are not held out."""
    learn = F.col("doc_id").isNotNull() & ~is_class(F.col("doc_id"), 4, 2)
    return good_documents(docs, table(spark, sf_dir, "labels"), learn)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are 80 percent alike."""
    return without_near_duplicates(docs, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard``, ``slot`` and ``grown_shard``."""
    carried = [c for c in COLUMNS if c in docs.columns]
    sharded = assign_shards(docs, SHARDS, carried)
    return sharded.select("doc_id", *carried, "shard", "slot", "grown_shard")


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("sharding", sharding),
]

# A trained network, sketches and checksums have no SQL form; tests compare the operators with
# brute force where there is one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
