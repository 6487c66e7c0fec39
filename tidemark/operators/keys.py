"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def surrogate_key(df: DataFrame, name: str, last: int = 0) -> DataFrame:
    """Unique ids above ``last``, increasing within a partition, with gaps between.

    Needs no shuffle. The ids follow the physical layout, so they must be written by
    the job that assigns them, with no exchange in between, and be read from there
    afterwards: an executor lost later would otherwise renumber rows that others have
    already read. A job uses up 2**33 ids per task, of 2**63 in all.
    """
    return df.withColumn(name, F.lit(last) + 1 + F.monotonically_increasing_id())


def dense_key(stored: DataFrame, name: str, last: int = 0) -> DataFrame:
    """``stored`` with ids ``last`` + 1, ``last`` + 2, ... without gaps in ``name``.

    ``name`` holds what ``surrogate_key`` with the same ``last`` has given, as it was
    *written*: a task's number and the row's place in it. A second pass counts the rows of
    each task, one number a task for the driver, and shifts them to follow each other. So the
    ids depend on what is stored alone: reading again, or a task that is repeated, gives the
    same ones. No row is shuffled.
    """
    raw = F.col(name) - last - 1
    task = F.shiftright(raw, 33).cast("int")
    starts, total = [], 0
    for number, rows in sorted(stored.groupBy(task.alias("t")).count().collect()):
        starts.append((number, total))
        total += rows
    offsets = stored.sparkSession.createDataFrame(starts or [(0, 0)], "_task int, _start bigint")
    place = F.col("_start") + raw.bitwiseAND(F.lit((1 << 33) - 1)) + last + 1
    return (
        stored.withColumn("_task", task)
        .join(offsets, "_task")
        .withColumn(name, place)
        .select(stored.columns)
    )


def id_figures(df: DataFrame, group: str, name: str) -> DataFrame:
    """``records``, ``first_id``, ``last_id`` and the exact number of different ``ids`` of each group.

    Ids are counted as the bits of one word for each 64 numbers. So where they follow each
    other a task holds, and the shuffle moves, a word for 64 rows and not a row for each.
    """
    id_ = F.col(name)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(id_, F.lit(64)).cast("int"))
    words = df.groupBy(group, F.shiftright(id_, 6).alias("_word")).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(id_).alias("first_id"),
        F.max(id_).alias("last_id"),
        F.bit_or(bit).alias("_bits"),
    )
    return words.groupBy(group).agg(
        F.sum("records").alias("records"),
        F.min("first_id").alias("first_id"),
        F.max("last_id").alias("last_id"),
        F.sum(F.bit_count("_bits")).alias("ids"),
    )
