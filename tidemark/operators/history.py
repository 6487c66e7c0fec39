"""Versioned history from a log of row changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import OPEN_END, ts_literal


def _next_time(changes: DataFrame, key: str, op_ts: str, seq: str, chunk_seconds: int) -> DataFrame:
    """Add ``_next``: when the next change of the same key happens, NULL for the last.

    A window over the key alone would send all changes of one busy key to one task. So
    the window runs inside (key, time chunk), and only the first change of each chunk -
    at most one row per key and chunk, however many changes there are - is lined up
    over the key to close the last change of the chunk before. The join back uses the
    partitioning the first window already made. The key is a primary key, never NULL.
    """
    epoch = ts_literal(OPEN_END.replace(year=1970, month=1, day=1, hour=0, minute=0, second=0))
    chunk = F.floor(F.timestamp_diff("SECOND", epoch, F.col(op_ts)) / chunk_seconds)
    chunked = changes.withColumn("_chunk", chunk)
    inside = Window.partitionBy(key, "_chunk").orderBy(op_ts, seq)
    heads = chunked.groupBy(key, "_chunk").agg(F.min(op_ts).alias("_head"))
    across = Window.partitionBy(key).orderBy("_chunk")
    following = heads.select(
        F.col(key).alias("_key"),
        F.col("_chunk").alias("_of"),
        F.lead("_head").over(across).alias("_following"),
    )
    here = chunked.withColumn("_inside", F.lead(op_ts).over(inside))
    joined = here.join(
        following, (here[key] == F.col("_key")) & (F.col("_chunk") == F.col("_of")), "left"
    )
    return joined.withColumn("_next", F.coalesce("_inside", "_following")).drop(
        "_chunk", "_inside", "_key", "_of", "_following"
    )


def history_from_changes(
    changes: DataFrame,
    key: str,
    op: str = "op",
    op_ts: str = "op_ts",
    seq: str = "seq",
    chunk_seconds: int = 60,
) -> DataFrame:
    """Every change as a version ``[start_date, end_date]`` with its operation.

    A version ends when the next change of its key begins; the last stays open. A
    DELETE closes what was open and stands as an inactive version that starts and ends
    at its own time. ``is_active`` says whether a version is current; a soft-delete
    flag of the row itself is an ordinary column and is kept as it is.
    """
    timed = _next_time(changes, key, op_ts, seq, chunk_seconds)
    deleted: Column = F.col(op) == "DELETE"
    body = [c for c in changes.columns if c not in (op, op_ts)]
    return timed.select(
        *body,
        F.col(op).alias("dml_operation"),
        F.col(op_ts).alias("start_date"),
        F.when(deleted, F.col(op_ts))
        .otherwise(F.coalesce("_next", ts_literal(OPEN_END)))
        .alias("end_date"),
        (~deleted & F.col("_next").isNull()).alias("is_active"),
    )


def _from(changes: DataFrame, key: str, op_ts: str) -> DataFrame:
    """One row per changed key: the time of its earliest change."""
    return changes.groupBy(F.col(key).alias("_key")).agg(F.min(op_ts).alias("_from"))


def stale_versions(history: DataFrame, changes: DataFrame, key: str, op_ts: str = "op_ts") -> DataFrame:
    """Versions that new changes may alter: of changed keys, those that end when their earliest
    change happens or later. Without late changes these are the open versions alone."""
    since = _from(changes, key, op_ts)
    return history.join(since, (history[key] == since["_key"]) & (history["end_date"] >= since["_from"]), "left_semi")


def redone_versions(
    history: DataFrame,
    changes: DataFrame,
    key: str,
    op: str = "op",
    op_ts: str = "op_ts",
    seq: str = "seq",
    chunk_seconds: int = 60,
) -> DataFrame:
    """The versions that stand in place of the stale ones, and those of the new changes.

    A version is a change with its end worked out, so the stale versions and the new changes
    together are a change log, and late changes fall between the versions they belong between.
    A table format applies this as: delete the stale (key, seq), insert these.
    """
    stale = stale_versions(history, changes, key, op_ts)
    body = [c for c in history.columns if c not in ("dml_operation", "start_date", "end_date", "is_active")]
    again = stale.select(*body, F.col("dml_operation").alias(op), F.col("start_date").alias(op_ts))
    return history_from_changes(again.unionByName(changes), key, op, op_ts, seq, chunk_seconds)


def history_increment(
    history: DataFrame,
    changes: DataFrame,
    key: str,
    op: str = "op",
    op_ts: str = "op_ts",
    seq: str = "seq",
    chunk_seconds: int = 60,
) -> DataFrame:
    """The history after more changes, equal to that of all changes at once.

    Only versions of changed keys from their earliest change on are worked on again; all
    others pass as they are. Changes without a key make no history, as keys are never NULL.
    """
    since = _from(changes, key, op_ts)
    kept = history.join(since, (history[key] == since["_key"]) & (history["end_date"] >= since["_from"]), "left_anti")
    redone = redone_versions(history, changes, key, op, op_ts, seq, chunk_seconds)
    return kept.unionByName(redone.select(history.columns))
