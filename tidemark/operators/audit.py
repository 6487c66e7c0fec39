"""Checkpoints, the run log and its metrics. These tables have one row per run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import run_duration, validity_percentage
from tidemark.functions.values import OPEN_END, ts_literal
from tidemark.operators.keys import surrogate_key
from tidemark.operators.quality import without_match
from tidemark.schemas import RUN_LOG

# Run states and the stages a run passes through.
STARTED, SUCCESS = "STARTED", "SUCCESS"
STAGES = ["LND TO PRS", "PRS TO CDC", "CDC TO PRE-DM", "PRE-DM TO DM"]
LOADED = "ALL LOADING STAGES COMPLETED"

COUNTS = ["batch_count", "insert_count", "update_count", "duplicate_count", "valid_count"]


def max_or_zero(df: DataFrame, column: str, name: str = "max_value") -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias(name))


def max_offset(messages: DataFrame, offset: str = "topic_offset") -> DataFrame:
    return messages.agg(F.max(offset).alias("max_offset"))


def of_source(df: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    """Rows of the source with this name (the scalar subquery on the source name)."""
    return df.join(sources.where(F.col("source_name") == source), "source_id", "left_semi")


def current_checkpoint(runs: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    return max_or_zero(of_source(runs, sources, source), "source_checkpoint", "checkpoint")


def next_checkpoint(batch: DataFrame, position: str) -> DataFrame:
    """Highest position of the whole batch, before duplicates are dropped.

    Taking it after would move the checkpoint back whenever the newest row is a
    superseded copy.
    """
    return max_or_zero(batch, position, "next_checkpoint")


def table_count(df: DataFrame, condition: str | Column | None = None) -> DataFrame:
    rows = df if condition is None else df.where(condition)
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def valid_count(stage: DataFrame, source_id: int, dag_run_id: int) -> DataFrame:
    mine = (F.col("source_id") == source_id) & (F.col("dag_run_id") == dag_run_id)
    return stage.where(mine & F.col("is_valid")).agg(F.count(F.lit(1)).alias("valid_count"))


def run_log_open(
    runs: DataFrame, arrivals: DataFrame, sources: DataFrame, status: str = STARTED
) -> DataFrame:
    """The run log with a row for every arriving run key it does not hold yet.

    ``arrivals`` has ``run_key, source_name, run_start_date``. A key that is known, or
    repeated among the arrivals, opens one run only.
    """
    first = arrivals.groupBy("run_key").agg(
        F.min(F.struct("run_start_date", "source_name")).alias("a")
    )
    fresh = without_match(first, runs, "run_key").select("run_key", "a.*")
    known = sources.select("source_name", "source_id")
    numbered = surrogate_key(fresh.join(known, "source_name", "left"), "_id")
    last = max_or_zero(runs, "dag_run_id").scalar()
    rows = numbered.select(
        (last + F.col("_id")).alias("dag_run_id"),
        "run_key",
        "source_id",
        F.lit(status).alias("dag_run_status"),
        "run_start_date",
        ts_literal(OPEN_END).alias("run_end_date"),
    )
    return runs.unionByName(rows, allowMissingColumns=True)


def scd1_upsert(table: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """Update or insert by key; the change with the highest ``order`` wins.

    Partial aggregation keeps one candidate per key and task, so a key that changes
    all the time is reduced before the shuffle.
    """
    columns = [c for c in table.columns if c != key]
    stacked = table.withColumn(order, F.lit(None).cast(dict(changes.dtypes)[order])).unionByName(
        changes.select(key, *columns, order)
    )
    ranking = F.struct(F.col(order), *[F.col(c) for c in columns])
    best = stacked.groupBy(key).agg(F.max(ranking).alias("w"))
    return best.select(key, *[F.col(f"w.{c}").alias(c) for c in columns]).select(table.columns)


def run_log_close(
    run: DataFrame, counts: DataFrame, finished: datetime, status: str = SUCCESS
) -> DataFrame:
    """The run's row with its end, counts, validity, duration and checkpoint.

    ``counts`` has one row per ``dag_run_id``.
    """
    open_rows = run.drop(*COUNTS, "source_checkpoint", "validity_percentage", "run_duration")
    closed = close_counted(open_rows.join(counts, "dag_run_id"), finished, status)
    return closed.select(RUN_LOG.names)


def close_counted(run: DataFrame, finished: datetime, status: str = SUCCESS) -> DataFrame:
    """The same for rows that carry their counts already; other columns are kept."""
    share = validity_percentage(*[F.col(f"{c}_count") for c in ("valid", "insert", "update")])
    ended = run.withColumns(
        {
            "run_end_date": ts_literal(finished),
            "dag_run_status": F.lit(status),
            "validity_percentage": share,
        }
    )
    return ended.withColumn("run_duration", run_duration())


def run_status_trail(completed: int, failed: bool = False) -> list[str]:
    """Statuses a run shows after ``completed`` stages; the stage after them may fail."""
    steps = ["SOURCE TO LND", *STAGES]
    following = [*STAGES, LOADED]
    trail = [STARTED] + [f"PROCESSING - {name}" for name in following[:completed]]
    if failed:
        name = steps[completed] if completed < len(steps) else "FINALIZE DAG RUN"
        return trail + [f"FAILED - {name}"]
    return trail + [SUCCESS] if completed == len(steps) else trail


def status_changes(steps: DataFrame) -> DataFrame:
    """Status rows ``(run_key, status, op_ts, seq)`` as a change log for the history operator."""
    first = F.col("status") == STARTED
    return steps.withColumn("op", F.when(first, "INSERT").otherwise("UPDATE"))
