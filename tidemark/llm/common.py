"""Expressions and storage shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.layout import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_class(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % modulus


def is_class(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where the id is of that class; False for a NULL id."""
    return F.coalesce(crc_class(doc_id, modulus) == remainder, F.lit(False))


def store(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, lineage cut."""
    spark = df.sparkSession
    path = folder or shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a stored table that nothing will read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lookup(rows: DataFrame, counts: DataFrame, keys: list[str], how: str, salts: int = 8) -> DataFrame:
    """Join to a frame with one row per key, with every key split in several.

    The split keeps a hot key from one task, and leaves Spark free to split it further, as
    neither side comes ready partitioned by the join's keys. ``rows`` spread over the salts by
    a hash of all their other columns.
    """
    rest = [c for c in rows.columns if c not in keys]
    salted = rows.withColumn("_salt", F.pmod(F.hash(*rest), F.lit(salts)))
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return salted.join(counts.withColumn("_salt", spread), [*keys, "_salt"], how).drop("_salt")
