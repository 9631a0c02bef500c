"""Profile features: preparation, scaling and selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quoted
from tidemark.operators.shape import apply_ddl
from tidemark.params import PROFILE_DDL, PROFILE_DROPPED, require_columns


def prepare_profiles(
    profiles: DataFrame,
    ddl: str = PROFILE_DDL,
    dropped: Sequence[str] = PROFILE_DROPPED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Profiles with their declared types, without descriptive and seasonal columns
    (except those in ``keep``)."""
    return apply_ddl(profiles, ddl).drop(*[c for c in dropped if c not in keep])


def numeric_features(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Names of the numeric columns that are not keys."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in keys and isinstance(f.dataType, T.NumericType)
    ]


def scale_max_abs(
    df: DataFrame,
    keys: Sequence[str] = ("player_id",),
    features: Sequence[str] | None = None,
) -> DataFrame:
    """The keys, and each feature divided by its largest absolute value; an all-zero one
    stays 0. All maxima come from one aggregate, used as a scalar subquery.
    """
    names = list(features) if features is not None else numeric_features(df, keys)
    tops = df.agg(
        F.struct(*[F.max(F.abs(quoted(c))).cast("double").alias(c) for c in names])
    ).scalar()

    def scaled(name: str) -> Column:
        top = tops.getField(name)
        divisor = F.when(top == 0, F.lit(1.0)).otherwise(top)
        return (quoted(name).cast("double") / divisor).alias(name)

    return df.select(*keys, *[scaled(c) for c in names])


def anova_table(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(position, feature, f_score): one-way ANOVA F of each feature against a label.

    Two aggregates: sums per label, then over the labels. Rejects a label with no more
    rows than classes, for which F is not defined. F is infinite when the feature is
    constant within every class but not over all, and NaN when it is constant.
    """
    require_columns(df.columns, [label, *features])
    per_class = df.groupBy(quoted(label).alias("_label")).agg(
        F.count("*").alias("_n"),
        *[F.sum(quoted(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(features)],
        *[
            F.sum(quoted(c).cast("double") * quoted(c).cast("double")).alias(f"_q{i}")
            for i, c in enumerate(features)
        ],
    )
    totals = per_class.agg(
        F.sum("_n").cast("double").alias("n"),
        F.count("*").cast("double").alias("k"),
        *[
            F.struct(
                F.sum(f"_s{i}").alias("s"),
                F.sum(f"_q{i}").alias("q"),
                F.sum(F.col(f"_s{i}") * F.col(f"_s{i}") / F.col("_n")).alias("b"),
            ).alias(f"_f{i}")
            for i in range(len(features))
        ],
    )
    n, k = F.col("n"), F.col("k")

    def f_score(part: Column) -> Column:
        mean_part = part["s"] * part["s"] / n
        between = (part["b"] - mean_part) / (k - 1)
        within = (part["q"] - part["b"]) / (n - k)
        undefined = F.when(between == 0, F.lit(float("nan"))).otherwise(
            F.lit(float("inf"))
        )
        return F.when(within == 0, undefined).otherwise(F.try_divide(between, within))

    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("feature"),
            f_score(F.col(f"_f{i}")).alias("f_score"),
        )
        for i, c in enumerate(features)
    ]
    checked = F.when((n > k) & (k > 1), F.array(*rows)).otherwise(
        F.raise_error(
            F.lit(
                f"label {label!r} needs at least two classes and fewer classes than rows"
            )
        )
    )
    return totals.select(F.inline(checked))


def top_features(table: DataFrame, k: int) -> DataFrame:
    """The ``k`` features with the highest F, NaN last, ties to the later column, with
    their rank from 1."""
    worth = F.when(F.isnan("f_score"), float("-inf")).otherwise(F.col("f_score"))
    # One entry per feature column, so the whole table fits in an array.
    entries = F.collect_list(F.struct(worth.alias("worth"), "position", "feature", "f_score"))
    best = table.agg(F.slice(F.sort_array(entries, asc=False), 1, k).alias("best"))
    return best.select(F.posexplode("best").alias("place", "entry")).select(
        (F.col("place") + 1).alias("rank"),
        "entry.position",
        "entry.feature",
        "entry.f_score",
    )


def variance_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(position, feature, f_score): the variance of each feature, in one pass. It stands in
    for the F score where there are no classes."""
    totals = df.agg(
        *[F.var_pop(quoted(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(features)]
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("feature"),
            F.coalesce(F.col(f"_v{i}"), F.lit(float("nan"))).alias("f_score"),
        )
        for i, c in enumerate(features)
    ]
    return totals.select(F.inline(F.array(*rows)))


def select_features(
    df: DataFrame,
    label: str | None,
    k: int,
    key: str = "player_id",
    features: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """The key with the ``k`` best features against ``label``, and their names, both in
    column order. Without a label those that vary most are the best, and features that do
    not vary are left out. Runs one aggregation to fix the names."""
    if features is not None:
        names = list(features)
    else:
        names = numeric_features(df, [key, *([label] if label else [])])
    if label:
        scores = anova_table(df, names, label)
    else:
        scores = variance_table(df, names).filter("f_score > 0 AND NOT isnan(f_score)")
    best = top_features(scores, k)
    kept = {row["feature"] for row in best.select("feature").collect()}
    selected = [c for c in names if c in kept]
    return df.select(key, *[quoted(c) for c in selected]), selected
