"""Required-column validation, error history and constraint audits."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import scd_defaults
from tidemark.operators.filters import filter_invalid
from tidemark.operators.merge import update_from_keys
from tidemark.schemas import REQUIRED_COLUMNS

# What an invalid row is recorded as.
ERROR_TYPE = "INVALID"
ERROR_DESCRIPTION = "A REQUIRED COLUMN IS NULL"
IDENTIFIER = "source_system_identifier"


def validate_required(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """``is_valid``: none of the required columns is NULL."""
    present = [F.col(c).isNotNull() for c in required or REQUIRED_COLUMNS]
    return df.withColumn("is_valid", reduce(lambda a, b: a & b, present))


def error_rows(stage: DataFrame, *more: str) -> DataFrame:
    """Error records of the invalid rows, with any further columns asked for."""
    return filter_invalid(stage).select(
        *more,
        "dag_run_id",
        "source_id",
        F.lit(ERROR_TYPE).alias("error_type"),
        F.lit(ERROR_DESCRIPTION).alias("error_description"),
        IDENTIFIER,
        "source_record_id",
    )


def error_history(
    errors: DataFrame, stage: DataFrame, as_of: datetime, resolve: bool = False
) -> DataFrame:
    """Error table after a stage: failing identifiers get a new active error.

    An older active error is closed when its identifier fails again. A row that has
    become valid leaves its old error open unless ``resolve`` is set.
    """
    failing = error_rows(stage)
    touched = stage if resolve else failing
    closed = update_from_keys(errors, touched.select(IDENTIFIER), IDENTIFIER, as_of)
    return closed.unionByName(scd_defaults(failing, as_of).select(errors.columns))


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, from one pass over the rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "violations")


def check_unique(df: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """References without a parent row, with the number of rows that hold each.

    The child is first reduced to its distinct references, so a hot reference costs
    one row in the join. A NULL reference breaks nothing. The join is an outer one with
    a null test because Spark would move an anti join below the aggregation.
    """
    held = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("reference"))
    counted = held.agg(F.count(F.lit(1)).alias("violations"))
    return without_match(counted, parent.select(F.col(parent_key).alias("reference")), "reference")


def without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` does not hold, with ``left`` computed first."""
    held = right.select(F.col(key).alias("_held"))
    joined = left.join(held, F.col(key) == F.col("_held"), "left")
    return joined.where(F.col("_held").isNull()).drop("_held")


def check_interval_order(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose interval ends before it starts."""
    return df.where(F.col(end) < F.col(start))
