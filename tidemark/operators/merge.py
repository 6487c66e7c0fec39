"""Change classification and versioned (SCD2) merges.

All joins here meet one row per key on both sides, so no key can fan out. Which side
is broadcast, if any, is left to the sizes Spark measures.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import scd_defaults, ts_literal
from tidemark.operators.filters import filter_active, filter_merge_type


def join_landing_to_active(
    landing: DataFrame, active: DataFrame, key: str, record_id: str = "prs_record_id"
) -> DataFrame:
    """Landing rows with the active stored version of their key, if any.

    Only the version's id and hash are taken, so only those columns are scanned. The
    store is first cut to the landed keys: a landing that Spark measures to be small is
    broadcast for that, so the store is not shuffled. A NULL key matches nothing.
    """
    stored = filter_active(active).select(
        F.col(key), F.col(record_id), F.col("hash_key").alias("prs_hash_key")
    )
    stored = stored.join(landing.select(key), key, "left_semi")
    return landing.withColumnRenamed("hash_key", "lnd_hash_key").join(stored, key, "left")


def merge_type(
    record_id: str = "prs_record_id", new: str = "lnd_hash_key", old: str = "prs_hash_key"
) -> Column:
    """No stored version: INSERT. Other hash: UPDATE. Same hash: DUPLICATE."""
    return (
        F.when(F.col(record_id).isNull(), "INSERT")
        .when(F.col(new) != F.col(old), "UPDATE")
        .when(F.col(new) == F.col(old), "DUPLICATE")
    )


def merge_classify(
    landing: DataFrame, active: DataFrame, key: str, record_id: str = "prs_record_id"
) -> DataFrame:
    """Landing rows with ``merge_type`` and the id of the version they meet."""
    joined = join_landing_to_active(landing, active, key, record_id)
    return joined.withColumn("merge_type", merge_type(record_id))


def merge_counts(classified: DataFrame, *more: Column) -> DataFrame:
    """One row: inserts, updates, duplicates, and any further aggregates asked for."""
    kinds = {"insert_count": "INSERT", "update_count": "UPDATE", "duplicate_count": "DUPLICATE"}
    return classified.agg(
        *[F.count_if(F.col("merge_type") == k).alias(name) for name, k in kinds.items()], *more
    )


def affected_keys(classified: DataFrame, key: str) -> DataFrame:
    """Keys whose active version this batch closes."""
    return filter_merge_type(classified, "UPDATE").select(key)


def update_from_keys(store: DataFrame, keys: DataFrame, key: str, as_of: datetime) -> DataFrame:
    """Close the active version of every listed key; other rows are unchanged.

    Closed versions never match, so they skip the join.
    """
    hit = keys.select(F.col(key), F.lit(True).alias("_hit")).distinct()
    active = filter_active(store).join(hit, key, "left")
    matched = F.col("_hit").isNotNull()
    stamped = active.withColumns(
        {
            "is_active": ~matched,
            "end_date": F.when(matched, ts_literal(as_of)).otherwise(F.col("end_date")),
        }
    )
    return stamped.select(store.columns).unionByName(store.where(~F.col("is_active")))


def scd2_apply(store: DataFrame, classified: DataFrame, key: str, as_of: datetime) -> DataFrame:
    """The store after a batch: updated keys closed, inserts and updates appended.

    ``classified`` carries the store's columns plus ``merge_type``. It must be a
    materialised snapshot when ``store`` is a table this result will replace.
    """
    closed = update_from_keys(store, affected_keys(classified, key), key, as_of)
    fresh = scd_defaults(filter_merge_type(classified), as_of).select(store.columns)
    return closed.unionByName(fresh)


def cdc_extract(store: DataFrame, dag_run_id: int, record_id: str = "prs_record_id") -> DataFrame:
    """Active versions this run wrote, without the version bookkeeping."""
    rows = filter_active(store).where(F.col("dag_run_id") == dag_run_id)
    kept = [c for c in store.columns if c not in ("hash_key", "is_active", "end_date")]
    return rows.select(kept).withColumnRenamed(record_id, "cdc_record_id")


def join_stage_to_fact(
    stage: DataFrame, fact: DataFrame, key: str = "source_system_identifier"
) -> DataFrame:
    """Stage rows marked UPDATE when an active fact holds their identifier, else INSERT."""
    met = filter_active(fact).select(key).join(stage.select(key), key, "left_semi")
    held = met.distinct().withColumn("_held", F.lit(True))
    kind = F.when(F.col("_held").isNotNull(), "UPDATE").otherwise("INSERT")
    return stage.join(held, key, "left").withColumn("merge_type", kind).drop("_held")


def fact_scd2_merge(
    fact: DataFrame, stage: DataFrame, as_of: datetime, key: str = "source_system_identifier"
) -> DataFrame:
    """Close every matched fact and append all stage rows, valid or not.

    An identifier without an active fact closes nothing, so the stage need not be
    classified first: that would be a second join over the same rows.
    """
    closed = update_from_keys(fact, stage, key, as_of)
    return closed.unionByName(scd_defaults(stage, as_of).select(fact.columns))
