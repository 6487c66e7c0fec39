"""Feeds as streams: each micro-batch goes through the batch pipeline."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.feeds import FeedSpec
from tidemark.operators.filters import filter_beyond_checkpoint
from tidemark.plans.ingest import ingest_batch
from tidemark.plans.state import FeedState
from tidemark.schemas import ALPHA_DOCUMENT, GAMMA_OBJECT, PARTITION_MESSAGE, TOPIC_MESSAGE
from tidemark.sources.objects import CSV_OPTIONS, with_object
from tidemark.sources.topic import beyond_positions


def _reader(spark: SparkSession, schema: StructType, files_per_batch: int | None):
    """A delivery is one micro-batch, unless the caller caps its files.

    A cap splits deliveries, and each part then gets versions of its own.
    """
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def document_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    return _reader(spark, ALPHA_DOCUMENT, files_per_batch).option("recursiveFileLookup", True).json(folder)


def message_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    return _reader(spark, TOPIC_MESSAGE, files_per_batch).parquet(folder)


def partitioned_message_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    return _reader(spark, PARTITION_MESSAGE, files_per_batch).parquet(folder)


def object_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of the object feed with the object they come from; ``number_object_rows`` prepares
    a micro-batch of them."""
    reader = _reader(spark, GAMMA_OBJECT, files_per_batch).options(**CSV_OPTIONS)
    return with_object(reader.csv(folder))


def named_object_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of the object feed with their file's path alone; ``number_by_listing`` prepares a
    micro-batch of them and searches a path once a file, not once a row."""
    reader = _reader(spark, GAMMA_OBJECT, files_per_batch).options(**CSV_OPTIONS)
    return reader.csv(folder).select("*", F.col("_metadata.file_path").alias("file_name"))


def upsert_by_position(
    prepare: Callable[[DataFrame], DataFrame],
    state: FeedState,
    spec: FeedSpec,
    dims: dict[str, DataFrame],
    as_of: Callable[[int], datetime],
) -> Callable[[DataFrame, int], None]:
    """The merge of one micro-batch, decided by what is published, not by its number.

    Of what Spark hands over, the rows beyond the published checkpoint are taken: those that
    an earlier try or an earlier stream has published are not, whatever number they come
    under now. The run key and the version time follow from how many batches the feed has
    published, so a try that is repeated has the same ones. Rows of a micro-batch that
    arrive after higher positions were published are not taken, as in a batch scan.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        before = state.latest()
        rows = prepare(batch)
        if spec.partition:
            rows = rows.where(beyond_positions(before.positions, spec.partition, spec.position))
        elif before.source_checkpoint is not None:
            rows = filter_beyond_checkpoint(rows, spec.position, before.source_checkpoint)
        ingest_batch(state, spec, rows, dims, f"{spec.source}-{before.seq}", as_of(before.seq))

    return apply


def stream_ingest(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    state: FeedState,
    spec: FeedSpec,
    dims: dict[str, DataFrame],
    checkpoint: str,
    as_of: Callable[[int], datetime],
) -> StreamingQuery:
    """Drain what has arrived, one pipeline run per micro-batch, then stop.

    Spark's checkpoint remembers which files have been handed over; the feed's published
    checkpoint decides which of their rows are new. So a batch repeated after a crash, and
    a stream started with another or an empty checkpoint folder, lose and double nothing.
    ``as_of`` maps the number of batches published so far to the next one's version time. A
    later batch always supersedes an earlier one.
    """
    return cross_batch_upsert(stream, upsert_by_position(prepare, state, spec, dims, as_of), checkpoint)


def cross_batch_upsert(
    stream: DataFrame,
    merge: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Hand every micro-batch in arrival order to ``merge``."""
    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
