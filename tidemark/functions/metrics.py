"""Run metrics: durations, null-to-zero, validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRIC_COLUMNS = [
    "batch_count",
    "insert_count",
    "update_count",
    "duplicate_count",
    "valid_count",
    "validity_percentage",
]


def coalesce_metrics(columns: list[str] | None = None) -> list[Column]:
    """Each metric with NULL shown as zero."""
    return [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns or METRIC_COLUMNS]


def run_duration(start: str = "run_start_date", end: str = "run_end_date") -> Column:
    """Elapsed time as a day-time interval."""
    return F.col(end) - F.col(start)


def interval_epoch_seconds(interval: str | Column) -> Column:
    """Length of a day-time interval in seconds, fractions kept."""
    c = F.col(interval) if isinstance(interval, str) else interval
    days, hours, minutes = (F.extract(F.lit(f), c) for f in ("DAY", "HOUR", "MINUTE"))
    return (
        days * 86400 + hours * 3600 + minutes * 60 + F.extract(F.lit("SECOND"), c)
    ).cast("double")


def validity_percentage(valid: Column, inserted: Column, updated: Column) -> Column:
    """Share of valid rows among those loaded; 0.00 when nothing was loaded."""
    share = F.try_divide(valid.cast("decimal(18,0)") * 100, (inserted + updated).cast("decimal(18,0)"))
    return F.coalesce(F.round(share, 2), F.lit(0)).cast("decimal(5,2)")
