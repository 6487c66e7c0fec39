"""Tables laid out so that a read opens only the folders it needs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import ts_literal
from tidemark.sources.sinks import route_partition

ROUTE, END_MONTH = "partition_name", "end_month"


def _spread(df: DataFrame, column: str, path: str) -> None:
    """One folder per value; the rebalance hint gathers a small value into one file and cuts
    a large one up, so no value is one task's work."""
    df.hint("rebalance", F.col(column)).write.partitionBy(column).mode("overwrite").parquet(path)


def write_routed(df: DataFrame, path: str) -> None:
    """A table with a folder for each source that has one, and a default for all others."""
    _spread(df.withColumn(ROUTE, route_partition("source_id")), ROUTE, path)


def read_routed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema.add(T.StructField(ROUTE, T.StringType()))).parquet(path)


def of_sources(routed: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of some sources, given as rows of the sources dimension.

    The dimension says which folders can hold them, so the filter on it prunes the scan when
    the query runs, whatever it filters by.
    """
    wanted = sources.select("source_id", route_partition("source_id").alias(ROUTE))
    return routed.join(wanted, ["source_id", ROUTE], "left_semi").drop(ROUTE)


def _month(moment: datetime) -> int:
    return 100 * moment.year + moment.month


def write_by_end(versions: DataFrame, path: str) -> None:
    """Versions by the month they end in; open ones share the month of the open end."""
    month = 100 * F.year("end_date") + F.month("end_date")
    _spread(versions.withColumn(END_MONTH, month), END_MONTH, path)


def read_by_end(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema.add(T.StructField(END_MONTH, T.IntegerType()))).parquet(path)


def versions_at(laid: DataFrame, moment: datetime) -> DataFrame:
    """The versions in force at a moment, past or present: begun by then, not ended.

    Folders of versions that had ended before are not opened, and the start is compared in
    the scan; so a moment costs what ended since, not the whole history.
    """
    at = ts_literal(moment)
    held = (F.col(END_MONTH) >= _month(moment)) & (F.col("start_date") <= at) & (F.col("end_date") > at)
    return laid.where(held).drop(END_MONTH)


def interval_lookup(rows: DataFrame, versions: DataFrame, key: str, at: str, shown: list[str]) -> DataFrame:
    """Rows with the columns of the version of their key that was in force at ``at``.

    An equality join with a range on top; rows without a version stay, with NULLs. A key
    meets its own versions only, of which a dimension has few.
    """
    renamed = [F.col(c).alias(f"_{c}") for c in (key, "start_date", "end_date")]
    dim = versions.select(*renamed, *shown)
    held = (F.col(at) >= F.col("_start_date")) & (F.col(at) < F.col("_end_date"))
    met = rows.join(dim, (rows[key] == dim[f"_{key}"]) & held, "left")
    return met.drop(f"_{key}", "_start_date", "_end_date")
