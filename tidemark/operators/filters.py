"""Row filters shared by the pipeline and the views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import ts_literal

CHANGED = ("INSERT", "UPDATE")


def filter_active(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_active"))


def filter_run(df: DataFrame, dag_run_id: int, source_id: int | None = None) -> DataFrame:
    rows = df.where(F.col("dag_run_id") == dag_run_id)
    return rows if source_id is None else rows.where(F.col("source_id") == source_id)


def filter_merge_type(df: DataFrame, *kinds: str) -> DataFrame:
    return df.where(F.col("merge_type").isin(*(kinds or CHANGED)))


def filter_invalid(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_valid"))


def valid_as_of(df: DataFrame, as_of: datetime) -> DataFrame:
    """Active, valid rows whose interval holds ``as_of``, both ends included."""
    moment = ts_literal(as_of)
    return df.where(
        F.col("is_active") & F.col("is_valid") & moment.between(F.col("start_date"), F.col("end_date"))
    )


def filter_success_runs(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("dag_run_status") == "SUCCESS")


def filter_beyond_checkpoint(df: DataFrame, position: str, checkpoint: int) -> DataFrame:
    """Strictly beyond: the row at the checkpoint was loaded before."""
    return df.where(F.col(position) > checkpoint)
