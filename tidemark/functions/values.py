"""Renaming, null handling and value normalisation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# End of an open version, and the rating words from lowest to highest.
OPEN_END = datetime(9999, 12, 31, 23, 59, 59)
RATING_LABELS = ["WORST", "BAD", "NEUTRAL", "GOOD", "BEST"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: datetime) -> Column:
    """A ``timestamp_ntz`` literal (a bare datetime literal would be zoned)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def rename_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Source field names to canonical ones; by default every name is lower-cased."""
    return df.withColumnsRenamed(names or {c: c.lower() for c in df.columns})


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes NULL in every string column."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(
        *[F.when(F.col(c) != "", F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def normalise_boolean(c: str | Column, true_word: str, false_word: str) -> Column:
    """Case-insensitive word pair to boolean; anything else is NULL."""
    word = F.upper(_col(c))
    return F.when(word == true_word.upper(), True).when(word == false_word.upper(), False)


def cast_numeric(c: str | Column, kind: str = "int") -> Column:
    """Text to a whole number; NULL when it is not one."""
    return _col(c).try_cast(kind)


def work_time_from_total(total: str | Column, handled: str | Column) -> Column:
    return _col(total) - _col(handled)


def rating_halve(c: str | Column) -> Column:
    """1-10 to 1-5, rounding up."""
    return F.ceil(_col(c).try_cast("int") / 2).cast("int")


def rating_from_label(c: str | Column) -> Column:
    """Rating word to 1-5; an unknown word is NULL. Case matters."""
    scale = F.array(*[F.lit(w) for w in RATING_LABELS])
    return F.nullif(F.array_position(scale, _col(c)), F.lit(0)).cast("int")


def tag_run(df: DataFrame, source_id: int, dag_run_id: int) -> DataFrame:
    return df.withColumns(
        {"source_id": F.lit(source_id).cast("int"), "dag_run_id": F.lit(dag_run_id).cast("long")}
    )


def scd_defaults(df: DataFrame, as_of: datetime) -> DataFrame:
    """Open-version columns. ``as_of`` is a parameter so that a retry writes the same rows."""
    return df.withColumns(
        {
            "is_active": F.lit(True),
            "start_date": ts_literal(as_of),
            "end_date": ts_literal(OPEN_END),
        }
    )
