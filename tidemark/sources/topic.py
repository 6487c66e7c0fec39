"""Message feed: offset-addressed XML records."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.filters import filter_beyond_checkpoint
from tidemark.schemas import BETA_RECORD, PARTITION_MESSAGE, TOPIC_MESSAGE

# Fixed value: how many unread messages make a run worth starting.
MINIMUM_LAG = 10
CORRUPT = "_corrupt_record"


def topic_reader(
    spark: SparkSession, servers: str, topic: str, checkpoint: int, partition: int = 0
) -> DataFrame:
    """Bounded read of a Kafka topic partition from the message after ``checkpoint``.

    Needs the Kafka connector on the class path.
    """
    start = json.dumps({topic: {str(partition): checkpoint + 1}})
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("assign", json.dumps({topic: [partition]}))
        .option("startingOffsets", start)
        .option("endingOffsets", "latest")
        .load()
        .select("offset", F.col("value").cast("string").alias("value"))
    )


def scan_topic_since(
    spark: SparkSession, path: str, checkpoint: int, fmt: str = "parquet"
) -> DataFrame:
    """Archived messages strictly beyond the checkpoint.

    The checkpoint is the last offset loaded and starts at -1, so the message at
    offset 0 is loaded too.
    """
    messages = spark.read.format(fmt).schema(TOPIC_MESSAGE).load(path)
    return filter_beyond_checkpoint(messages, "offset", checkpoint)


def parse_xml_records(messages: DataFrame) -> DataFrame:
    """One XML record per message to text fields, padding kept; blank or absent is NULL.

    Text that is not XML gives all-NULL fields and keeps the text in
    ``_corrupt_record``, for the caller to set aside.
    """
    schema = T.StructType([*BETA_RECORD.fields, T.StructField(CORRUPT, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "nullValue": "",
        "ignoreSurroundingSpaces": "false",
        "columnNameOfCorruptRecord": CORRUPT,
    }
    record = F.from_xml("value", schema.simpleString(), options)
    place = [F.col("offset").alias("topic_offset")]
    if "partition" in messages.columns:
        place.append(F.col("partition").alias("topic_partition"))
    parsed = messages.select(*place, record.alias("r"))
    fields = [(F.col(f"r.{n}"), n.lower()) for n in BETA_RECORD.names]
    return parsed.select(
        *[name for name in parsed.columns if name != "r"],
        *[F.when(F.trim(text) != "", text).alias(name) for text, name in fields],
        F.col(f"r.{CORRUPT}").alias(CORRUPT),
    )


def has_topic_lag(messages: DataFrame, checkpoint: int, minimum: int = MINIMUM_LAG) -> DataFrame:
    """One row: are more than ``minimum`` messages waiting?

    The high watermark is the offset the next message will get.
    """
    high = F.coalesce(F.max("offset") + 1, F.lit(0))
    return messages.agg((high > checkpoint + minimum).alias("has_new"))


# -- topics of several partitions ------------------------------------------------


def starting_offsets(topic: str, checkpoints: dict[int, int], partitions: list[int]) -> str:
    """The offsets a bounded read starts from, as the connector takes them: after what was
    loaded of a partition, and from the earliest (-2) where nothing was."""
    return json.dumps({topic: {str(p): checkpoints[p] + 1 if p in checkpoints else -2 for p in partitions}})


def beyond_positions(
    checkpoints: dict[int, int], partition: str = "partition", offset: str = "offset"
) -> Column:
    """Strictly beyond the checkpoint of its partition; partitions without one are all new.

    A disjunction of plain comparisons, so it reaches the Parquet scan. The vector has one
    number for each partition of the topic.
    """
    known = [(F.col(partition) == p) & (F.col(offset) > o) for p, o in sorted(checkpoints.items())]
    beyond = ~F.col(partition).isin(*sorted(checkpoints)) if checkpoints else F.lit(True)
    for condition in known:
        beyond = beyond | condition
    return beyond


def scan_partitions_since(
    spark: SparkSession, path: str, checkpoints: dict[int, int], fmt: str = "parquet"
) -> DataFrame:
    """Archived messages of all partitions, each strictly beyond its own checkpoint."""
    messages = spark.read.format(fmt).schema(PARTITION_MESSAGE).load(path)
    return messages.where(beyond_positions(checkpoints))


def next_positions(batch: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """One row per partition of a batch: its highest offset."""
    return batch.groupBy(F.col(partition).alias("partition")).agg(F.max(offset).alias("position"))


def partition_lag(messages: DataFrame, checkpoints: dict[int, int]) -> DataFrame:
    """One row per partition: what was loaded (-1: nothing), the high watermark, what waits."""
    loaded = F.lit(-1).cast("bigint")
    for p, o in sorted(checkpoints.items()):
        loaded = F.when(F.col("partition") == p, F.lit(o).cast("bigint")).otherwise(loaded)
    tops = next_positions(messages).select("partition", loaded.alias("loaded"), (F.col("position") + 1).alias("high"))
    return tops.withColumn("waiting", F.greatest(F.col("high") - F.col("loaded") - 1, F.lit(0)))


def has_partition_lag(
    messages: DataFrame, checkpoints: dict[int, int], minimum: int = MINIMUM_LAG
) -> DataFrame:
    """One row: do more than ``minimum`` messages wait in all partitions together?"""
    waiting = F.coalesce(F.sum("waiting"), F.lit(0))
    return partition_lag(messages, checkpoints).agg((waiting > minimum).alias("has_new"))
