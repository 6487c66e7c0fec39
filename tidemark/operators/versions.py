"""Append-only versions: what a version's end is, is derived when it is read.

A log holds the versions that runs opened, each with its run's number and start. A version
ends where the next run that holds its key begins. Nothing stored is ever changed, so what a
batch writes follows the batch, not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import OPEN_END, ts_literal

KEY, RUN = "version_key", "dag_run_id"


def versions_at_read(log: DataFrame, key: str = KEY, run: str = RUN) -> DataFrame:
    """The log with ``end_date`` and ``is_active``.

    Runs of a key are lined up, not its versions: the window sees one row per key and run,
    made with a map-side combine, however many versions of a busy key a run wrote. A row
    without a key is never superseded.
    """
    heads = log.where(F.col(key).isNotNull()).groupBy(key, run).agg(F.min("start_date").alias("_began"))
    across = Window.partitionBy(key).orderBy(run)
    ends = heads.select(
        F.col(key).alias("_key"), F.col(run).alias("_run"), F.lead("_began").over(across).alias("_next")
    ).where("_next is not null")
    met = log.join(ends, (log[key] == ends["_key"]) & (log[run] == ends["_run"]), "left")
    return met.withColumns(
        {"is_active": F.col("_next").isNull(), "end_date": F.coalesce("_next", ts_literal(OPEN_END))}
    ).drop("_key", "_run", "_next")


def open_ended(log: DataFrame) -> DataFrame:
    """The log's rows as versions that none has ended."""
    return log.withColumns({"is_active": F.lit(True), "end_date": ts_literal(OPEN_END)})


def current_of(log: DataFrame, keys: DataFrame, key: str = KEY, run: str = RUN) -> DataFrame:
    """The newest version of each of ``keys``, with the log's columns.

    The log is cut to the keys first; where Spark measures them to be small they are
    broadcast, and the log is not shuffled. Then one row per key and task is shuffled. Of
    several versions that one run wrote for a key, one is taken.
    """
    wanted = keys.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    met = log.join(wanted, log[key] == wanted["_key"], "left_semi")
    newest = F.max_by(F.struct(*[F.col(c) for c in log.columns]), F.col(run)).alias("v")
    return met.groupBy(key).agg(newest).select("v.*")


def active_of(log: DataFrame, key: str = KEY, run: str = RUN) -> DataFrame:
    """Active versions only, with ``end_date`` and ``is_active``."""
    return versions_at_read(log, key, run).where("is_active")


def delta_since(log: DataFrame, since: int, key: str = KEY, run: str = RUN) -> tuple[DataFrame, DataFrame]:
    """(opened, closed) by the runs after ``since``, both as they are while open.

    What was active at ``since``, less what is closed, plus what is opened, is active now. A
    version that a later one of these runs closed again is in neither. The older log is cut to
    the keys of the newer one, so the work follows the new runs.
    """
    newer, older = log.where(F.col(run) > since), log.where(F.col(run) <= since)
    keys = newer.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    met = older.join(keys, older[key] == keys["_key"], "left_semi")
    return active_of(newer, key, run), active_of(met, key, run)
