"""KPIs of interactions kept as a state that batches add to and take from.

The state has one row for each combination of what the dashboards group by, with counts and
sums only. A batch adds the versions it opens and takes back those it closes, so no figure
scans the fact again. Whole numbers keep the sums exact however often rows come and go.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import scd_defaults
from tidemark.operators.filters import filter_active

GROUPS = ["interaction_day", "pseudo_code", "query_status", "customer_type_name", "support_area_name"]


def _measures() -> dict[str, Column]:
    return {
        "interactions": F.count(F.lit(1)),
        "first_contacts": F.count_if("first_contact_resolution"),
        "handle_seconds": F.sum(F.col("handle_time").cast("long")),
        "handled": F.count("handle_time"),
        "rating_points": F.sum(F.col("customer_rating").cast("long")),
        "rated": F.count("customer_rating"),
    }


def interaction_state(view: DataFrame) -> DataFrame:
    """The state of a whole view of current interactions."""
    day = view.withColumn("interaction_day", F.to_date("interaction_date"))
    sums = [F.coalesce(m, F.lit(0)).alias(name) for name, m in _measures().items()]
    return day.groupBy(*GROUPS).agg(*sums)


def fold(state: DataFrame, opened: DataFrame, closed: DataFrame) -> DataFrame:
    """The state after a batch: plus the view of what it opened, minus that of what it closed.

    All three are aggregated before they meet; NULL is a group like others. Groups that
    nothing is left of go.
    """
    back = interaction_state(closed).withColumns({m: -F.col(m) for m in _measures()})
    parts = state.unionByName(interaction_state(opened)).unionByName(back)
    summed = parts.groupBy(*GROUPS).agg(*[F.sum(m).alias(m) for m in _measures()])
    return summed.where("interactions != 0")


def fact_delta(
    fact: DataFrame, stage: DataFrame, as_of: datetime, key: str = "source_system_identifier"
) -> tuple[DataFrame, DataFrame]:
    """Versions that merging ``stage`` opens, and those it closes, both as they are while open."""
    opened = scd_defaults(stage, as_of).select(fact.columns)
    return opened, filter_active(fact).join(stage.select(key), key, "left_semi").select(fact.columns)


def kpi_interactions(state: DataFrame) -> DataFrame:
    total = state.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in _measures()])
    return total.select(
        F.col("interactions").alias("total_interactions"),
        F.try_divide(F.col("first_contacts").cast("double") * 100, "interactions").alias("first_contact_pct"),
        F.try_divide(F.col("handle_seconds").cast("double"), "handled").alias("avg_handle_time"),
        F.try_divide(F.col("rating_points").cast("double"), "rated").alias("avg_rating"),
    )


def interactions_by(state: DataFrame, *groups: str) -> DataFrame:
    """Interactions by some of ``GROUPS``."""
    return state.groupBy(*groups).agg(F.sum("interactions").alias("interactions"))
