"""Removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, ascii_lower, lookup


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column) -> Column:
    lowered = _lines(ascii_lower(text))
    return F.transform(lowered, lambda line: F.btrim(line, F.lit(SPACES)))


def _hashes(*parts: Column) -> list[Column]:
    """128 bits, so that no two lines of a corpus share them by chance."""
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("line"), *parts).alias("h2")]


def _without(lines: Column, dropped: Column) -> Column:
    """The lines whose positions are not in the sorted array; linear in both arrays.

    The runs between dropped positions are cut out whole. The one-element array binds the
    split text to a variable, so that it is computed once and not once per run.
    """

    def cut(x: Column) -> Column:
        edges = F.concat(F.array(F.lit(-1)), x["dropped"], F.array(F.size(x["lines"])))
        runs = F.transform(
            F.sequence(F.lit(1), F.size(x["dropped"]) + 1),
            lambda i: F.slice(
                x["lines"],
                F.element_at(edges, i) + 2,
                F.element_at(edges, i + 1) - F.element_at(edges, i) - 1,
            ),
        )
        return F.flatten(runs)

    both = F.array(F.struct(lines.alias("lines"), dropped.alias("dropped")))
    return F.element_at(F.transform(both, cut), 1)


def drop_common_lines(docs: DataFrame, min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """Documents without the lines found in at least ``min_docs`` documents.

    Lines are compared by key: white space stripped at both ends, A-Z in lower case. Keys of
    fewer than ``min_chars`` code points never count. Returns ``doc_id, text, n_lines,
    n_dropped``; ``text`` holds the lines that stay, joined by newlines.

    Documents are told apart by ``doc_id``: rows with one id are one document where lines are
    counted, and rows without an id are none; each row is returned, without the common lines.
    A NULL or empty text is one empty line and stays an empty text; so does a text that loses
    all its lines. Texts of any length are read whole. Other columns are not read.

    Lines travel as hashes: each is kept once per document, documents are counted with map-side
    sums, and only the positions of dropped lines come back to a document, by a hash of its id
    and text. A line that very many documents share is looked up in several tasks. Explodes are outer, as inner ones would
    first ask for the number of lines and so split each text twice.
    """
    doc_id, text = F.col("doc_id"), F.col("text")
    docs = docs.select("doc_id", "text")
    row = [F.xxhash64(doc_id, text), F.xxhash64(F.lit("row"), doc_id, text)]

    seen = docs.where(doc_id.isNotNull()).select(
        "doc_id", F.explode_outer(F.array_distinct(_keys(text))).alias("key")
    )
    seen = seen.where(F.length("key") >= min_chars).select("doc_id", *_hashes(F.col("key")))
    common = seen.distinct().groupBy("h1", "h2").count().where(F.col("count") >= min_docs)

    placed = docs.select(
        row[0].alias("r1"), row[1].alias("r2"), F.posexplode_outer(_keys(text)).alias("pos", "key")
    )
    placed = placed.where(F.length("key") >= min_chars)
    placed = placed.select("r1", "r2", "pos", *_hashes(F.col("key")))
    dropped = lookup(placed, common, ["h1", "h2"], "left_semi").groupBy("r1", "r2")
    dropped = dropped.agg(F.array_sort(F.collect_set("pos")).alias("dropped"))

    joined = docs.withColumns({"r1": row[0], "r2": row[1]}).join(dropped, ["r1", "r2"], "left")
    kept = F.array_join(_without(_lines(text), F.col("dropped")), "\n")
    whole = F.coalesce(text, F.lit(""))
    return joined.select(
        "doc_id",
        F.when(F.col("dropped").isNull(), whole).otherwise(kept).alias("text"),
        (F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"))) + 1)
        .cast("long")
        .alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
