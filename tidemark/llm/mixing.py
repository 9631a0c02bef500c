"""Mixing of sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lookup, store, word_count

# Sampling keys are histogrammed in this many steps per doubling of the key.
STEPS = 4096
# Parts into which equal rows are cut to be numbered.
PARTS = 64


def letter_share(text: Column) -> Column:
    """Weight of a document: its share of letters, from 0.05 to 1. Empty texts weigh least."""
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    share = letters / F.nullif(F.length(text), F.lit(0))
    return F.greatest(F.lit(0.05), F.coalesce(share, F.lit(0.0)))


def source_targets(
    sizes: DataFrame, weights: Sequence[float], cap: int, share: float
) -> DataFrame:
    """Target of each source, given ``src, source_size``, one row per source.

    ``src`` is the source after an equals sign, and empty for the NULL source.

    Sources in the order of their code points, NULL last, take the weights in turn. Targets are ``min(cap * size, level * weight)`` at the one level that spends the whole budget.
    The level is read off the sources sorted by the level at which each is full: up to some
    source all are full, and the rest share what is left. The windows see one row per source.
    """
    ordered = Window.orderBy(F.col("src") == "", "src")
    turn = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    rows = sizes.withColumn("weight", weight)
    rows = rows.withColumn("room", (F.col("source_size") * cap).cast("double"))
    rows = rows.withColumn("full_at", F.col("room") / F.col("weight"))
    by_level = Window.orderBy("full_at", "src").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spent = F.coalesce(F.sum("room").over(by_level), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    rows = rows.withColumn(
        "level", (budget - spent) / (F.sum("weight").over(everything) - used)
    )
    first_open = F.min(
        F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "src", "level"))
    ).over(everything)
    rows = rows.withColumn("level", first_open["level"])
    target = F.least("room", F.coalesce(F.col("level") * F.col("weight"), F.col("room")))
    return rows.select("src", "source_size", F.greatest(target, F.lit(0.0)).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    cap: int = 3,
    share: float = 1.0,
    quality: Column | None = None,
) -> DataFrame:
    """How often each document enters a mix of sources with given weights.

    Returns ``doc_id, size, source, source_size, target, copies, taken, digest``. A source takes
    every document as often as its target holds the source whole; the rest of the target is
    filled by weighted sampling without replacement: each document draws the key
    ``-ln(u) / quality``, and documents come in the order of their keys until the target is
    met, the last one if at least half of it fits. ``u`` is a digest of id and text, so
    reruns agree. ``quality`` is a positive column, by default the share of letters.

    Sizes are words; a NULL or empty text has none and is never drawn before it fits. A NULL
    source is a source. Repeated rows are rows of their own and are drawn next to each other.
    Sources without words get target 0; an empty table gives no rows. Other columns are not
    read, unless ``quality`` reads them.

    No source is ever sorted whole: keys fall into narrow steps, steps are summed with
    map-side sums, and only rows of one step of one source are put in order.
    """
    digest = _digest(docs)
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    u = (draw + 0.5) / F.lit(2.0**52)
    weight = letter_share(F.col("text")) if quality is None else quality
    rows = docs.select(
        F.col("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("src"),
        word_count(F.col("text")).alias("size"),
        digest.alias("digest"),
        (-F.log(u) / weight).alias("key"),
    )
    rows = store(rows.withColumn("step", F.floor(F.log2("key") * STEPS)))

    steps = rows.groupBy("src", "step").agg(F.sum("size").alias("step_size"))
    sizes = steps.groupBy("src").agg(F.sum("step_size").alias("source_size"))
    targets = source_targets(sizes, weights, cap, share)
    running = F.sum("step_size").over(Window.partitionBy("src").orderBy("step"))
    epochs = F.coalesce(
        F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)
    )
    plan = steps.select("src", "step", (running - F.col("step_size")).alias("before"))
    plan = plan.join(targets, "src").select(
        "src",
        "step",
        "source_size",
        "target",
        epochs.alias("epochs"),
        (F.col("target") - epochs * F.col("source_size") - F.col("before")).alias("left"),
    )

    order = Window.partitionBy("src", "step").orderBy("key", "digest", "doc_id")
    order = order.rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(order), F.lit(0))
    drawn = (F.col("size") > 0) & (ahead + F.col("size") / 2 <= F.col("left"))
    mixed = rows.join(plan, ["src", "step"]).withColumn(
        "copies", (F.col("epochs") + drawn.cast("long")).cast("long")
    )
    return mixed.select(
        "doc_id",
        "size",
        F.when(F.col("src") != "", F.substring("src", 2, 1 << 30)).alias("source"),
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        "digest",
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix_sources` takes it, with all columns.

    Rows equal in id, text and source are not told apart by the draw. Their copies are dealt
    to them in equal shares, and what is left over to the first of them, so that together they
    come exactly as often as the mix takes them. They are numbered by the parts of the input
    they are read from, and only where there are several, so that a row that is there very
    often does not meet in one task.
    """
    src = F.coalesce(F.concat(F.lit("="), docs["source"]), F.lit("")).alias("_src")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("_part")
    rows = docs.select(_digest(docs).alias("_digest"), src, part, row)
    group = ["_digest", "_src"]
    mixed = mix_sources(docs, **settings)
    mixed_src = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_src")
    taken = mixed.groupBy(F.col("digest").alias("_digest"), mixed_src).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_n")
    )
    taken = store(taken.where(F.col("_copies") > 0))
    single = rows.join(taken.where(F.col("_n") == 1).drop("_n"), group).select("row", "_copies")

    several = lookup(rows, taken.where(F.col("_n") > 1), group, "inner")
    per_part = several.groupBy(*group, "_part").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select(
        *group, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(F.lit(0))) - 1
    numbered = several.withColumn("_inside", inside).join(per_part, [*group, "_part"])
    over = F.col("_before") + F.col("_inside") < F.col("_copies") % F.col("_n")
    share = F.floor(F.col("_copies") / F.col("_n")) + over.cast("long")
    dealt = single.unionByName(numbered.select("row", share.alias("_copies")))
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_copy")
    return dealt.select("row", repeated).select("row.*")


def _digest(docs: DataFrame) -> Column:
    return F.md5(F.concat_ws(":", docs["doc_id"].cast("string"), docs["text"]))
