"""Writes: truncate-and-load, retry-safe append, partition routing, one small file if absent."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sources with a partition of their own; all others share the default.
PARTITIONS = {1: "alpha", 2: "beta", 3: "gamma"}
DEFAULT_PARTITION = "default"


def sink_overwrite(df: DataFrame, path: str) -> None:
    """Replace a landing table with this batch.

    Compressed by zstd: of hashes and ids Spark's default saves next to nothing.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def sink_append(df: DataFrame, path: str, run_column: str = "dag_run_id") -> None:
    """Add a run's rows to a table; writing the same run again replaces its rows."""
    (
        df.write.partitionBy(run_column)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def route_partition(source_id: str | Column = "source_id") -> Column:
    """Name of the partition a row belongs to; unknown and NULL sources go to the default."""
    c = F.col(source_id) if isinstance(source_id, str) else source_id
    routed = F.lit(DEFAULT_PARTITION)
    for value, name in PARTITIONS.items():
        routed = F.when(c == value, name).otherwise(routed)
    return routed


def _located(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text, through the file system of its path."""
    found, fs = _located(spark, path)
    stream = fs.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file with all of ``text``, unless the path is taken; tells which.

    The text is written beside it and then takes the name in one step that fails where the
    name exists: a hard link on a local disk, elsewhere a rename without overwriting, as the
    file system defines it. So of several writers exactly one is told True.
    """
    target, fs = _located(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    fs.mkdirs(target.getParent())
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(part.toUri().getPath(), target.toUri().getPath())
        else:
            none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark._jsc.hadoopConfiguration()
            )
            context.rename(fs.makeQualified(part), fs.makeQualified(target), options)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" not in str(problem.java_exception):
            raise
        return False
    finally:
        fs.delete(part, False)
