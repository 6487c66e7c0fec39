"""Object feed: gzip, pipe-delimited, fully quoted CSV objects numbered by name."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import empty_to_null, rename_columns
from tidemark.schemas import GAMMA_OBJECT

# Fixed value: the object name. A dataset written by Spark holds its part files in a
# folder ``object=<name>``, which names the object just as well as a single file does.
OBJECT_NAME = r"(?:^|/)(?:object=)?\s*(\d{1,10})_client_gamma_support_data_\d{8}_\d{6}\.csv\.gz(?:/[^/]*)?$"


def object_sequence(path: Column) -> Column:
    """Sequence number in an object's path; NULL when the name is not one of ours.

    Spark computes this for every row, not once a file. The name is among the last two parts
    of the path, so only these are decoded and searched.
    """
    named = F.url_decode(F.substring_index(path, "/", -2))
    return F.regexp_extract(named, OBJECT_NAME, 1).try_cast("bigint")


def list_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Names and sequence numbers of all objects, without opening any of them.

    Only the path of the binary-file source is selected, so no content is read.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    ).select(F.col("path").alias("file_name"))
    numbered = listing.withColumn("file_seq", object_sequence(F.col("file_name")))
    return numbered.where("file_seq IS NOT NULL")


def has_new_objects(objects: DataFrame, checkpoint: int) -> DataFrame:
    """One row: is any sequence number beyond the checkpoint?

    Compares sequence with sequence; counting objects goes wrong once numbers skip.
    """
    return objects.agg((F.coalesce(F.max("file_seq"), F.lit(0)) > checkpoint).alias("has_new"))


def order_files_by_sequence(objects: DataFrame) -> DataFrame:
    """The order in which objects take effect. One row per object, so sorting is cheap."""
    return objects.select("file_seq", "file_name").orderBy("file_seq", "file_name")


CSV_OPTIONS = {"sep": "|", "header": "true", "quote": '"', "escape": '"', "recursiveFileLookup": "true"}


def with_object(rows: DataFrame) -> DataFrame:
    """The raw fields with the number and path of the object they come from."""
    path = F.col("_metadata.file_path")
    return rows.select(*GAMMA_OBJECT.names, object_sequence(path).alias("file_seq"), path.alias("file_name"))


def number_object_rows(rows: DataFrame) -> DataFrame:
    """Rows of objects under their canonical names, empty as NULL, with ``row_id``."""
    return _with_row_id(rows.where("file_seq IS NOT NULL"))


def _with_row_id(rows: DataFrame) -> DataFrame:
    return empty_to_null(rename_columns(rows.withColumn("row_id", F.monotonically_increasing_id())))


def _newer(spark: SparkSession, folder: str, checkpoint: int) -> list[tuple[str, int]]:
    """Path and number of every object file beyond the checkpoint, searched once a file."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    path = F.col("_metadata.file_path")
    numbered = listed.select(path.alias("file_name"), object_sequence(path).alias("file_seq"))
    return [tuple(r) for r in numbered.where(F.col("file_seq") > checkpoint).collect()]


def _met(named: DataFrame, newer: list[tuple[str, int]]) -> DataFrame:
    """Rows with their ``file_name``, numbered where it is among ``newer``; the others go."""
    ordered = named.withColumn("row_id", F.monotonically_increasing_id())
    # An Arrow table becomes a local relation: Spark knows its size and moves no object row.
    names, sequences = ([r[i] for r in newer] for i in (0, 1))
    numbers = named.sparkSession.createDataFrame(
        pa.table({"file_name": pa.array(names, pa.string()), "file_seq": pa.array(sequences, pa.int64())})
    )
    met = ordered.join(numbers, "file_name").select(*GAMMA_OBJECT.names, "file_seq", "file_name", "row_id")
    return empty_to_null(rename_columns(met))


def scan_csv_objects_since(spark: SparkSession, folder: str, checkpoint: int) -> DataFrame:
    """Rows of every object beyond the checkpoint, all text, empty as NULL.

    One multi-file read. Each file's own header is skipped, so no data row is lost.
    Paths are listed and searched for their number once a file; a row finds that of its file
    by a join. They are listed after the read is planned, so none of its files is missed. The
    filter on paths looks only at file metadata, so Spark drops older files before opening
    them. ``row_id`` grows along a file (gzip is never
    split), which gives rows a total order together with ``file_seq`` and ``file_name``.
    """
    rows = spark.read.schema(GAMMA_OBJECT).options(**CSV_OPTIONS).csv(folder)
    path = F.col("_metadata.file_path")
    newer = _newer(spark, folder, checkpoint)
    named = rows.where(path.isin([name for name, _ in newer])).select("*", path.alias("file_name"))
    return _met(named, newer)


def number_by_listing(folder: str, since: Callable[[], int]) -> Callable[[DataFrame], DataFrame]:
    """Prepares micro-batches of rows with their ``file_name`` as ``scan_csv_objects_since`` does.

    ``since`` tells the checkpoint, asked for each micro-batch. The folder is listed then too,
    after Spark has chosen the micro-batch's files, so none of them is missed.
    """
    return lambda rows: _met(rows, _newer(rows.sparkSession, folder, since()))


def union_files(*frames: DataFrame) -> DataFrame:
    """Frames of equal fields, matched by name, one below the other."""
    head, *rest = frames
    for frame in rest:
        head = head.unionByName(frame)
    return head
