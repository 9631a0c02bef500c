"""Small files in any Hadoop file system, written whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place in one step: readers see the old content or the new."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    target = fs.Path(path)
    # Files with a leading dot are no data to Spark's readers.
    draft = fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = target.getFileSystem(conf).create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace_file(spark, draft.toString(), path)


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, over the target if there is one."""
    fs = spark._jvm.org.apache.hadoop.fs
    path = fs.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    path.getFileSystem(conf).mkdirs(path.getParent())
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = fs.FileContext.getFileContext(path.toUri(), conf)
    context.rename(context.makeQualified(fs.Path(source)), context.makeQualified(path), options)


def file_names(spark: SparkSession, folder: str, ending: str = "") -> list[str]:
    """Names of the files of a folder, without hidden ones; none if there is no folder."""
    fs = spark._jvm.org.apache.hadoop.fs
    path = fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = (status.getPath().getName() for status in system.listStatus(path))
    return sorted(n for n in names if n[0] not in "._" and n.endswith(ending))
