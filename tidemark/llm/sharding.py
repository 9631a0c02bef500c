"""Assignment of documents to shards that stays put when shards are added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows numbered by one task at a time.
BUCKET_ROWS = 20_000
# Jumps that nearly every key is done with; the rest takes as many as there are shards.
USUAL_JUMPS = 48


def _walk(key: Column, shards: int, steps: int) -> Column:
    """Jumps of one key: the last places below ``shards`` and below ``shards + 1``, and the next."""
    start = F.struct(
        F.lit(0).cast("long").alias("now"),
        F.lit(0).cast("long").alias("grown"),
        F.lit(0).cast("long").alias("next"),
    )

    def jump(s: Column, i: Column) -> Column:
        draw = (F.shiftrightunsigned(F.xxhash64(key, i), 11) + F.lit(0.5)) / F.lit(2.0**53)
        stepped = F.struct(
            F.when(s["next"] < shards, s["next"]).otherwise(s["now"]).alias("now"),
            s["next"].alias("grown"),
            F.floor((s["next"] + 1) / draw).alias("next"),
        )
        return F.when(s["next"] > shards, s).otherwise(stepped)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, jump)


def jump_shards(key: Column, shards: int) -> Column:
    """Struct of the shard of a key, of its shard with one more shard, and of a next place.

    Jump consistent hashing: a key sits at 0 and jumps to ever larger places, each one drawn
    from the key and the number of the jump alone; its shard is the last place below the
    number of shards. One more shard thus takes ``1 / (shards + 1)`` of the keys and moves no
    other. A jump goes at least one place on, so ``shards + 1`` jumps always suffice.
    """
    if shards <= USUAL_JUMPS:
        return _walk(key, shards, shards + 1)
    usual = _walk(key, shards, USUAL_JUMPS)
    return F.when(usual["next"] > shards, usual).otherwise(_walk(key, shards, shards + 1))


def assign_shards(docs: DataFrame, shards: int = 40, carry: Sequence[str] = ()) -> DataFrame:
    """Shard and place within the shard of every document.

    Returns ``doc_id, size, text_crc32, shard, slot, grown_shard``, and the columns of
    ``docs`` named in ``carry``, which travel with the rows. ``size`` is the UTF-8
    length of the text plus 16, ``slot`` counts from 0 without gaps in each shard, and
    ``grown_shard`` is the shard if there were one more. Shards depend on ``doc_id`` alone:
    rows with one ``doc_id`` share a shard, and so do all rows with a NULL one. Repeated rows
    get slots of their own. A NULL text has size 16 and the checksum of an empty text. An
    empty table gives no rows. Columns not carried are not read.

    Slots are numbered inside buckets of a shard, which are a hash of id and text and grow in
    number with the rows, and are then shifted by the counts of the buckets before.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    buckets = max(1, -(-docs.count() // (shards * BUCKET_ROWS)))
    places = jump_shards(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), shards)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.lit("slot"), F.col("doc_id"), text).alias("mix"),
        places.alias("place"),
        F.struct(F.lit(0).alias("none"), *[docs[c] for c in carry]).alias("doc"),
    )
    rows = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        "mix",
        F.col("place.now").cast("int").alias("shard"),
        F.col("place.grown").cast("int").alias("grown_shard"),
        F.pmod("mix", F.lit(buckets)).alias("bucket"),
        "doc",
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    counts = counts.select("shard", "bucket", before.alias("before"))
    order = Window.partitionBy("shard", "bucket").orderBy("mix", "doc_id", "text_crc32", "size")
    return rows.join(counts, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.row_number().over(order) - 1 + F.col("before")).alias("slot"),
        "grown_shard",
        *[F.col("doc")[c].alias(c) for c in carry],
    )
