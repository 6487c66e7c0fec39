"""One row per key within a batch.

``row_number() == 1`` is planned with a group limit on both sides of the exchange:
each task keeps its best row per key before anything is shuffled. A key that holds a
third of the batch therefore reaches its final task as one row per upstream task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import parse_ts_created


def dedup_by_rank(df: DataFrame, keys: str | list[str], rank: Iterable[Column]) -> DataFrame:
    """Keep the row that ``rank`` puts first for each key. NULL keys form one group."""
    keys = [keys] if isinstance(keys, str) else keys
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*rank))
    return df.withColumn("_rank", position).where("_rank = 1").drop("_rank")


def dedup_latest_by_serial(
    df: DataFrame, key: str = "interaction_id", serial: str = "serial_number", *ties: str
) -> DataFrame:
    """Highest serial wins."""
    return dedup_by_rank(df, key, [F.desc(serial), *[F.desc(t) for t in ties]])


def dedup_latest_by_created(
    df: DataFrame,
    key: str = "support_identifier",
    created: str = "time_stamp",
    offset: str = "topic_offset",
) -> DataFrame:
    """Newest creation time wins, then the higher offset; unreadable times come last.

    The creation text is parsed with its own layout. A plain cast would give NULL for
    every row and leave the winner to chance.
    """
    return dedup_by_rank(
        df, key, [parse_ts_created(created).desc_nulls_last(), F.desc(offset)]
    )


def dedup_first_seen(
    df: DataFrame,
    key: str = "ticket_identifier",
    order: tuple[str, ...] = ("file_seq", "file_name", "row_id"),
) -> DataFrame:
    """First row in file and row order wins."""
    return dedup_by_rank(df, key, [F.asc(c) for c in order])
