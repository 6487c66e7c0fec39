"""Reporting views and the KPI queries of the two dashboards.

The dashboards name their charts without giving the queries behind them; the grouping
columns here are our own reading of the chart titles.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import interval_epoch_seconds
from tidemark.operators.conform import LOOKUPS
from tidemark.operators.filters import filter_success_runs, valid_as_of



def _rows() -> Column:
    return F.count(F.lit(1))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


# -- views ---------------------------------------------------------------------


def join_runs_to_sources(runs: DataFrame, sources: DataFrame) -> DataFrame:
    return runs.join(sources.select("source_id", "source_name"), "source_id")


def data_metrics_view(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Successful runs with their source, metrics shown as zero when missing.

    Rows come unordered; ``order_runs_desc`` sorts them where they are shown.
    """
    joined = join_runs_to_sources(filter_success_runs(runs), sources)
    counts = ["batch_count", "insert_count", "update_count", "duplicate_count", "valid_count"]
    seconds = F.coalesce(interval_epoch_seconds("run_duration"), F.lit(0.0))
    return joined.select(
        "dag_run_id",
        "source_name",
        "run_start_date",
        *[_zero(c).alias(c) for c in counts],
        _zero("validity_percentage").cast("decimal(5,2)").alias("data_quality_score"),
        seconds.alias("run_duration_sec"),
    )


def star_join(
    fact: DataFrame,
    required: list[tuple[DataFrame, str, str]],
    optional: list[tuple[DataFrame, str, str]],
) -> DataFrame:
    """Fact with its dimensions, given as ``(dimension, fact key, dimension key)``.

    Small dimensions are broadcast because Spark sees their size; a large one is
    shuffled, and adaptive execution splits a hot key on the fact's side.
    """
    for how, dimensions in (("inner", required), ("left", optional)):
        for dimension, fact_key, key in dimensions:
            named = dimension.withColumnRenamed(key, "_key")
            fact = fact.join(named, F.col(fact_key) == F.col("_key"), how).drop("_key")
    return fact


def customer_support_fact_view(
    fact: DataFrame, dims: dict[str, DataFrame], as_of: datetime
) -> DataFrame:
    """Current valid facts with names in place of keys."""
    sources = dims["sources"].select("source_id", "source_name")
    names = [
        (dims[table].select(key, name), key, key) for key, (table, name) in LOOKUPS.items()
    ]
    current = valid_as_of(fact, as_of)
    return star_join(current, [(sources, "source_id", "source_id")], names).select(
        "source_name",
        "source_record_id",
        "source_system_identifier",
        "pseudo_code",
        "interaction_date",
        "support_area_name",
        "interaction_status",
        "interaction_type",
        "customer_type_name",
        "handle_time",
        "work_time",
        "first_contact_resolution",
        "query_status",
        "solution_type",
        "customer_rating",
    )


# -- run history ---------------------------------------------------------------


def run_history_summary(history: DataFrame) -> DataFrame:
    """Per job: runs, completed, failed, average records (0 when none are recorded)."""
    status = F.col("status")
    return history.groupBy("script_name").agg(
        _rows().alias("total_runs"),
        F.count_if(status == "Completed").alias("successful_runs"),
        F.count_if(status == "Failed").alias("failed_runs"),
        F.coalesce(F.avg("records_generated"), F.lit(0.0)).alias("avg_records"),
    )


def run_status_counts(states: DataFrame) -> DataFrame:
    """Totals over the jobs' current states."""
    return states.agg(
        _rows().alias("scripts_total"),
        F.count_if(F.col("running")).alias("scripts_running"),
        F.count_if(F.col("status") == "Failed").alias("scripts_failed"),
        F.count_if(F.col("status") == "Completed").alias("scripts_completed"),
    )


def latest_n_runs(history: DataFrame, script: str, n: int = 5) -> DataFrame:
    """The ``n`` runs of a script that started last."""
    mine = history.where(F.col("script_name") == script)
    return mine.orderBy(F.desc("start_time"), F.desc("run_id")).limit(n)


def order_runs_desc(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("run_start_date"))


# -- data metrics dashboard ----------------------------------------------------


def kpi_runs(metrics: DataFrame) -> DataFrame:
    """Runs, mean duration, rows, valid and invalid rows, quality share."""
    loaded = F.sum(F.col("insert_count") + F.col("update_count"))
    valid = F.sum("valid_count")
    return metrics.agg(
        _rows().alias("total_runs"),
        F.avg("run_duration_sec").alias("avg_run_duration_sec"),
        F.sum("batch_count").alias("total_rows"),
        valid.alias("valid_rows"),
        (loaded - valid).alias("invalid_rows"),
        _share(valid, loaded).alias("quality_pct"),
    )


def batches_by_source(metrics: DataFrame) -> DataFrame:
    kinds = ["insert_count", "update_count", "duplicate_count"]
    return metrics.groupBy("source_name").agg(*[F.sum(c).alias(c) for c in kinds])


def validity_by_source(metrics: DataFrame) -> DataFrame:
    loaded = F.sum(F.col("insert_count") + F.col("update_count"))
    valid = F.sum("valid_count")
    return metrics.groupBy("source_name").agg(
        valid.alias("valid_rows"), (loaded - valid).alias("invalid_rows")
    )


def run_duration_over_time(metrics: DataFrame, grain: str = "day") -> DataFrame:
    period = F.date_trunc(grain, "run_start_date").cast("timestamp_ntz").alias("period")
    return metrics.groupBy(period).agg(F.avg("run_duration_sec").alias("avg_run_duration_sec"))


def runs_per_source_over_time(metrics: DataFrame, grain: str = "day") -> DataFrame:
    period = F.date_trunc(grain, "run_start_date").cast("timestamp_ntz").alias("period")
    return metrics.groupBy("source_name", period).agg(_rows().alias("runs"))


def run_outcomes(runs: DataFrame, sources: DataFrame) -> DataFrame:
    joined = join_runs_to_sources(runs, sources)
    return joined.groupBy("source_name", "dag_run_status").agg(_rows().alias("runs"))


def ten_latest_runs(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("run_start_date"), F.desc("dag_run_id")).limit(10)


# -- interactions dashboard ----------------------------------------------------


def kpi_interactions(view: DataFrame) -> DataFrame:
    """Interactions, share solved at first contact, mean handle time, mean rating."""
    return view.agg(
        _rows().alias("total_interactions"),
        _share(F.count_if("first_contact_resolution"), _rows()).alias("first_contact_pct"),
        F.avg("handle_time").alias("avg_handle_time"),
        F.avg("customer_rating").alias("avg_rating"),
    )


def query_status_counts(view: DataFrame) -> DataFrame:
    return view.groupBy("query_status").agg(_rows().alias("interactions"))


def interactions_per_agent(view: DataFrame) -> DataFrame:
    return view.groupBy("pseudo_code").agg(_rows().alias("interactions"))


def interactions_by_type_area(view: DataFrame) -> DataFrame:
    return view.groupBy("customer_type_name", "support_area_name").agg(_rows().alias("interactions"))


def interaction_volume_over_time(view: DataFrame) -> DataFrame:
    day = F.to_date("interaction_date").alias("interaction_day")
    return view.groupBy(day).agg(_rows().alias("interactions"))


def latest_interactions(view: DataFrame, n: int = 25, ties: tuple[str, ...] = ()) -> DataFrame:
    """The newest ``n`` rows; each task keeps its own best ``n``, so nothing is sorted whole."""
    newest = ["interaction_date", "source_system_identifier", *ties]
    return view.orderBy(*[F.desc(c) for c in newest]).limit(n)
