"""Document feed: one JSON document per row, addressed by a growing serial number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.filters import filter_beyond_checkpoint
from tidemark.schemas import ALPHA_DOCUMENT


UNTIL = "serial_until"


def land_documents(documents: DataFrame, path: str, span: int, mode: str = "append") -> None:
    """Raw documents in folders by ranges of ``span`` serial numbers, each named after the last
    number it can hold, so that a scan need not open what lies before its checkpoint. Files are
    compressed, and as each is then read by one task, they hold ``span`` documents at most."""
    until = (F.floor(F.col("serial_number") / span) + 1) * span - 1
    writer = documents.withColumn(UNTIL, until).write.partitionBy(UNTIL).mode(mode)
    writer.option("maxRecordsPerFile", span).json(path, compression="gzip")


def _may_lie_beyond(checkpoint: int) -> Column:
    """Looks at a file's path alone: Spark drops the others before it opens them. Files whose
    path names no range are opened. Spark asks this of every row too, so only the end of the
    path, the folder and the file, is searched."""
    place = F.substring_index(F.col("_metadata.file_path"), "/", -2)
    until = F.regexp_extract(place, rf"^{UNTIL}=(\d+)/", 1).try_cast("bigint")
    return F.coalesce(until > checkpoint, F.lit(True))


def scan_documents_since(
    spark: SparkSession, path: str, checkpoint: int, fmt: str = "json"
) -> DataFrame:
    """Documents strictly beyond the checkpoint.

    ``fmt`` names any Spark source that yields these fields, so a document-store
    connector slots in where one is installed and receives the filter as a pushdown. Of raw
    files laid out by ``land_documents`` only those are opened that can hold new numbers.
    """
    documents = spark.read.format(fmt).schema(ALPHA_DOCUMENT)
    if fmt == "json":
        found = documents.option("recursiveFileLookup", True).load(path)
        documents = found.where(_may_lie_beyond(checkpoint))
    else:
        documents = documents.load(path)
    return filter_beyond_checkpoint(documents, "serial_number", checkpoint)


def has_new_documents(documents: DataFrame, checkpoint: int) -> DataFrame:
    """One row: is there any document beyond the checkpoint?

    ``limit(1)`` lets the scan stop at the first hit.
    """
    beyond = filter_beyond_checkpoint(documents, "serial_number", checkpoint).limit(1)
    return beyond.agg((F.count(F.lit(1)) > 0).alias("has_new"))
