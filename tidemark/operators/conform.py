"""Typing landed text and projecting each feed onto the conformed fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.feeds import ALPHA, BETA, GAMMA, FeedSpec
from tidemark.schemas import FACT_COLUMNS

# fact key -> (dimension, its name column)
LOOKUPS = {
    "agent_id": ("agents", "pseudo_code"),
    "support_area_id": ("support_areas", "support_area_name"),
    "customer_type_id": ("customer_types", "customer_type_name"),
}


def lookup_dictionary(
    dimension: DataFrame, sources: DataFrame, source: str, id_column: str, name_column: str
) -> DataFrame:
    """``(id, name)`` of one dimension for one source."""
    mine = sources.where(F.col("source_name") == source)
    return dimension.join(mine, "source_id", "left_semi").select(id_column, name_column)


def active_lookup_values(
    dimension: DataFrame, sources: DataFrame, source: str, column: str
) -> DataFrame:
    """Distinct active values of a dimension column for an active source."""
    mine = sources.where(F.col("is_active") & (F.col("source_name") == source))
    rows = dimension.where(F.col("is_active")).join(mine, "source_id", "left_semi")
    return distinct_lookup(rows, column)


def distinct_lookup(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def lookup_join(df: DataFrame, *lookups: tuple[DataFrame, str, str, str]) -> DataFrame:
    """Left-join ``(dictionary, id column, name column, df column)`` entries.

    No hint is given: Spark broadcasts a dictionary when its size is known to be small
    and otherwise shuffles, where adaptive execution splits a hot name.
    """
    for dictionary, id_column, name_column, column in lookups:
        entry = dictionary.select(F.col(id_column), F.col(name_column).alias("_name"))
        df = df.join(entry, df[column] == F.col("_name"), "left").drop("_name")
    return df


def type_landing(landing: DataFrame, spec: FeedSpec, *more: str) -> DataFrame:
    """Landed text to stored types; the landing hash is kept, and any further columns asked for."""
    columns = [
        (spec.typed[c]() if c in spec.typed else F.col(c)).alias(c) for c in spec.fields
    ]
    return landing.select(*columns, "hash_key", *more)


def conform(cdc: DataFrame, spec: FeedSpec, dims: dict[str, DataFrame]) -> DataFrame:
    """Changed rows of one feed as conformed fact rows.

    Wants ``cdc_record_id, source_id, dag_run_id, source_system_identifier`` and the
    feed's stored fields.
    """
    lookups = []
    for id_column, column in spec.lookups.items():
        table, name_column = LOOKUPS[id_column]
        dictionary = lookup_dictionary(
            dims[table], dims["sources"], spec.source, id_column, name_column
        )
        lookups.append((dictionary, id_column, name_column, column))
    joined = lookup_join(cdc, *lookups).withColumnRenamed("cdc_record_id", "source_record_id")
    return joined.select(
        *[(spec.conformed[c]() if c in spec.conformed else F.col(c)).alias(c) for c in FACT_COLUMNS]
    )


def conform_alpha(cdc: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return conform(cdc, ALPHA, dims)


def conform_beta(cdc: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return conform(cdc, BETA, dims)


def conform_gamma(cdc: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return conform(cdc, GAMMA, dims)


def fact_all_sources(*facts: DataFrame) -> DataFrame:
    """The conformed facts of all feeds as one table."""
    head, *rest = facts
    for fact in rest:
        head = head.unionByName(fact)
    return head
