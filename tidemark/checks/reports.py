"""Counts and KPIs (G), top-k (O), the views (H12, H13)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.checks import carriers as c
from tidemark.checks import oracle as o
from tidemark.checks.merges import STAGED, _conformed, _fact
from tidemark.checks.registry import check
from tidemark.operators import audit, kpi_state, reporting
from tidemark.session import work_folder
from tidemark.sources import seeds
from tidemark.sources.sinks import sink_overwrite

AT = datetime(1998, 7, 1)
RUNS = c.runs(True)
FACTS = c.facts(True)


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """The run log with the figures a closed run carries."""
    counts = [F.col(x) for x in ("valid_count", "insert_count", "update_count")]
    share = F.when(F.col("batch_count").isNotNull(), fn.validity_percentage(*counts))
    return c.carrier(spark, sf, c.runs).withColumns(
        {"run_duration": fn.run_duration(), "validity_percentage": share}
    )


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.data_metrics_view(runs(spark, sf), seeds.sources(spark))


def view(spark: SparkSession, sf: str) -> DataFrame:
    fact = c.carrier(spark, sf, c.facts)
    return reporting.customer_support_fact_view(fact, seeds.dimensions(spark), AT)


PERCENT = """CASE WHEN coalesce(insert_count + update_count, 0) = 0 THEN CAST(0 AS DECIMAL(5, 2))
    ELSE CAST(((valid_count * 20000 + insert_count + update_count)
               // (2 * (insert_count + update_count))) / 100.0 AS DECIMAL(5, 2)) END"""
METRICS = f"""{o.DIMS},
    metrics AS (
        SELECT dag_run_id, source_name, run_start_date,
               coalesce(batch_count, 0) AS batch_count, coalesce(insert_count, 0) AS insert_count,
               coalesce(update_count, 0) AS update_count,
               coalesce(duplicate_count, 0) AS duplicate_count,
               coalesce(valid_count, 0) AS valid_count, {PERCENT} AS data_quality_score,
               CAST(epoch(run_end_date - run_start_date) AS DOUBLE) AS run_duration_sec
        FROM ({RUNS}) r JOIN src USING (source_id) WHERE dag_run_status = 'SUCCESS')"""
VIEW = f"""{o.DIMS},
    star AS (
        SELECT s.source_name, f.source_record_id, f.source_system_identifier, a.pseudo_code,
               f.interaction_date, b.support_area_name, f.interaction_status, f.interaction_type,
               k.customer_type_name, f.handle_time, f.work_time, f.first_contact_resolution,
               f.query_status, f.solution_type, f.customer_rating
        FROM ({FACTS}) f JOIN src s USING (source_id)
        LEFT JOIN agents a ON a.agent_id = f.agent_id
        LEFT JOIN areas b ON b.support_area_id = f.support_area_id
        LEFT JOIN kinds k ON k.customer_type_id = f.customer_type_id
        WHERE f.is_active AND f.is_valid
          AND TIMESTAMP '1998-07-01' BETWEEN f.start_date AND f.end_date)"""


# -- views ---------------------------------------------------------------------


@check(
    "join_runs_to_sources",
    f"""WITH {o.DIMS} SELECT dag_run_id, run_key, source_name, dag_run_status
    FROM ({RUNS}) r JOIN src USING (source_id)""",
)
def join_runs_to_sources(spark: SparkSession, sf: str) -> DataFrame:
    joined = reporting.join_runs_to_sources(c.carrier(spark, sf, c.runs), seeds.sources(spark))
    return joined.select("dag_run_id", "run_key", "source_name", "dag_run_status")


@check("data_metrics_view", f"WITH {METRICS} SELECT * FROM metrics")
def data_metrics_view(spark: SparkSession, sf: str) -> DataFrame:
    return metrics(spark, sf)


@check(
    "star_join",
    """SELECT o_orderkey, o_totalprice, c_name, n_name, r_name FROM orders
    JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def star_join(spark: SparkSession, sf: str) -> DataFrame:
    """One required and two optional dimensions, the first of which grows with the fact."""
    orders, customer, nation, region = (
        c.table(spark, sf, t) for t in ("orders", "customer", "nation", "region")
    )
    joined = reporting.star_join(
        orders,
        [(customer, "o_custkey", "c_custkey")],
        [(nation, "c_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")],
    )
    return joined.select("o_orderkey", "o_totalprice", "c_name", "n_name", "r_name")


@check("customer_support_fact_view", f"WITH {VIEW} SELECT * FROM star")
def customer_support_fact_view(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf)


# -- counts --------------------------------------------------------------------


@check("table_count", "SELECT count(*) AS row_count FROM lineitem WHERE l_returnflag = 'R'")
def table_count(spark: SparkSession, sf: str) -> DataFrame:
    return audit.table_count(c.table(spark, sf, "lineitem"), "l_returnflag = 'R'")


@check(
    "valid_count",
    f"SELECT count(*) AS valid_count FROM ({FACTS}) f WHERE source_id = 2 AND dag_run_id = 5 AND is_valid",
)
def valid_count(spark: SparkSession, sf: str) -> DataFrame:
    return audit.valid_count(c.carrier(spark, sf, c.facts), 2, 5)


@check("max_or_zero", "SELECT coalesce(max(event_id), 0) AS max_value FROM events")
def max_or_zero(spark: SparkSession, sf: str) -> DataFrame:
    return audit.max_or_zero(c.table(spark, sf, "events"), "event_id")


@check("max_offset", f"SELECT max(topic_offset) AS max_offset FROM ({o.RAW['beta']}) b")
def max_offset(spark: SparkSession, sf: str) -> DataFrame:
    return audit.max_offset(c.carrier(spark, sf, c.beta))


@check(
    "validity_percentage",
    f"SELECT dag_run_id, {PERCENT} AS validity_percentage FROM ({RUNS}) r WHERE batch_count IS NOT NULL",
)
def validity_percentage(spark: SparkSession, sf: str) -> DataFrame:
    done = runs(spark, sf).where("batch_count IS NOT NULL")
    return done.select("dag_run_id", "validity_percentage")


# -- run history ---------------------------------------------------------------

_HISTORY = """
    SELECT event_id AS run_id,
           CASE user_id % 3 WHEN 0 THEN 'client_alpha' WHEN 1 THEN 'client_beta' ELSE 'client_gamma' END
               AS script_name,
           CAST(FLOOR(value) AS BIGINT) AS records_generated, ts AS start_time, value AS duration,
           CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed'
                ELSE 'Running' END AS status
    FROM {events}"""
HISTORY = _HISTORY.replace("{events}", "events")


def history(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_HISTORY, events=c.table(spark, sf, "events"))


@check(
    "run_history_summary",
    f"""SELECT script_name, count(*) AS total_runs,
    count(*) FILTER (status = 'Completed') AS successful_runs,
    count(*) FILTER (status = 'Failed') AS failed_runs,
    CAST(sum(records_generated) AS DOUBLE) / count(records_generated) AS avg_records
    FROM ({HISTORY}) h GROUP BY script_name""",
)
def run_history_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.run_history_summary(history(spark, sf))


@check(
    "run_status_counts",
    f"""SELECT count(*) AS scripts_total, count(*) FILTER (status = 'Running') AS scripts_running,
    count(*) FILTER (status = 'Failed') AS scripts_failed,
    count(*) FILTER (status = 'Completed') AS scripts_completed FROM ({HISTORY}) h""",
)
def run_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    states = history(spark, sf).withColumn("running", F.col("status") == "Running")
    return reporting.run_status_counts(states)


@check(
    "latest_n_runs",
    f"""SELECT * FROM ({HISTORY}) h WHERE script_name = 'client_beta'
    ORDER BY start_time DESC, run_id DESC LIMIT 25""",
)
def latest_n_runs(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.latest_n_runs(history(spark, sf), "client_beta", 25)


@check("order_runs_desc", f"WITH {METRICS} SELECT * FROM metrics ORDER BY run_start_date DESC")
def order_runs_desc(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.order_runs_desc(metrics(spark, sf))


# -- data metrics dashboard ----------------------------------------------------


@check(
    "kpi_runs",
    f"""WITH {METRICS} SELECT count(*) AS total_runs,
    sum(run_duration_sec) / count(*) AS avg_run_duration_sec,
    CAST(sum(batch_count) AS BIGINT) AS total_rows, CAST(sum(valid_count) AS BIGINT) AS valid_rows,
    CAST(sum(insert_count + update_count - valid_count) AS BIGINT) AS invalid_rows,
    CAST(sum(valid_count) AS DOUBLE) * 100 / CAST(sum(insert_count + update_count) AS DOUBLE)
    AS quality_pct FROM metrics""",
)
def kpi_runs(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.kpi_runs(metrics(spark, sf))


@check(
    "batches_by_source",
    f"""WITH {METRICS} SELECT source_name, CAST(sum(insert_count) AS BIGINT) AS insert_count,
    CAST(sum(update_count) AS BIGINT) AS update_count,
    CAST(sum(duplicate_count) AS BIGINT) AS duplicate_count FROM metrics GROUP BY source_name""",
)
def batches_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.batches_by_source(metrics(spark, sf))


@check(
    "validity_by_source",
    f"""WITH {METRICS} SELECT source_name, CAST(sum(valid_count) AS BIGINT) AS valid_rows,
    CAST(sum(insert_count + update_count - valid_count) AS BIGINT) AS invalid_rows
    FROM metrics GROUP BY source_name""",
)
def validity_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.validity_by_source(metrics(spark, sf))


@check(
    "run_duration_over_time",
    f"""WITH {METRICS} SELECT CAST(date_trunc('day', run_start_date) AS TIMESTAMP) AS period,
    sum(run_duration_sec) / count(*) AS avg_run_duration_sec FROM metrics GROUP BY 1""",
)
def run_duration_over_time(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.run_duration_over_time(metrics(spark, sf))


@check(
    "runs_per_source_over_time",
    f"""WITH {METRICS} SELECT source_name, CAST(date_trunc('day', run_start_date) AS TIMESTAMP)
    AS period, count(*) AS runs FROM metrics GROUP BY 1, 2""",
)
def runs_per_source_over_time(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.runs_per_source_over_time(metrics(spark, sf))


@check(
    "run_outcomes",
    f"""WITH {o.DIMS} SELECT source_name, dag_run_status, count(*) AS runs
    FROM ({RUNS}) r JOIN src USING (source_id) GROUP BY ALL""",
)
def run_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.run_outcomes(c.carrier(spark, sf, c.runs), seeds.sources(spark))


@check(
    "ten_latest_runs",
    f"WITH {METRICS} SELECT * FROM metrics ORDER BY run_start_date DESC, dag_run_id DESC LIMIT 10",
)
def ten_latest_runs(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.ten_latest_runs(metrics(spark, sf))


# -- interactions dashboard ----------------------------------------------------


@check(
    "kpi_interactions",
    f"""WITH {VIEW} SELECT count(*) AS total_interactions,
    CAST(count(*) FILTER (first_contact_resolution) AS DOUBLE) * 100 / count(*) AS first_contact_pct,
    CAST(sum(handle_time) AS DOUBLE) / count(*) AS avg_handle_time,
    CAST(sum(customer_rating) AS DOUBLE) / count(*) AS avg_rating FROM star""",
)
def kpi_interactions(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.kpi_interactions(view(spark, sf))


def _counted(*columns: str) -> str:
    names = ", ".join(columns)
    return f"WITH {VIEW} SELECT {names}, count(*) AS interactions FROM star GROUP BY ALL"


@check("query_status_counts", _counted("query_status"))
def query_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.query_status_counts(view(spark, sf))


@check("interactions_per_agent", _counted("pseudo_code"))
def interactions_per_agent(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.interactions_per_agent(view(spark, sf))


@check("interactions_by_type_area", _counted("customer_type_name", "support_area_name"))
def interactions_by_type_area(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.interactions_by_type_area(view(spark, sf))


@check(
    "interaction_volume_over_time",
    _counted("CAST(interaction_date AS DATE) AS interaction_day"),
)
def interaction_volume_over_time(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.interaction_volume_over_time(view(spark, sf))


_TIES = ("handle_time", "work_time", "customer_rating", "pseudo_code", "query_status")


@check(
    "latest_interactions",
    f"""WITH {VIEW} SELECT * FROM star ORDER BY interaction_date DESC, source_system_identifier DESC,
    {", ".join(f"{t} DESC NULLS LAST" for t in _TIES)} LIMIT 25""",
)
def latest_interactions(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.latest_interactions(view(spark, sf), 25, _TIES)


# -- the same figures, kept as a state -------------------------------------------

_AFTER = f"""{STAGED},
    f AS (SELECT b.* FROM before b LEFT JOIN stage s USING (source_system_identifier)
          WHERE s.source_system_identifier IS NULL UNION ALL BY NAME SELECT * FROM stage),
    star AS (
        SELECT CAST(f.interaction_date AS DATE) AS interaction_day, a.pseudo_code, f.query_status,
               k.customer_type_name, b.support_area_name, f.handle_time, f.customer_rating,
               f.first_contact_resolution
        FROM f JOIN src s USING (source_id)
        LEFT JOIN agents a ON a.agent_id = f.agent_id
        LEFT JOIN areas b ON b.support_area_id = f.support_area_id
        LEFT JOIN kinds k ON k.customer_type_id = f.customer_type_id
        WHERE f.is_valid)"""
_LATER = datetime.fromisoformat(c.AS_OF)


def state_after(spark: SparkSession, sf: str) -> DataFrame:
    """The state of the stored fact, brought forward by what merging the stored stage opens and closes."""
    dims, stored = seeds.dimensions(spark), []
    for name, rows in (("fact", _fact(spark, sf)), ("stage", _conformed(spark, sf, False))):
        path = work_folder(spark, f"kpi-{name}")
        sink_overwrite(rows, path)
        stored.append(spark.read.schema(rows.schema).parquet(path))
    fact, stage = stored

    def shown(rows: DataFrame) -> DataFrame:
        return reporting.customer_support_fact_view(rows, dims, _LATER)

    opened, closed = kpi_state.fact_delta(fact, stage, _LATER)
    return kpi_state.fold(kpi_state.interaction_state(shown(fact)), shown(opened), shown(closed))


@check(
    "kpi_increment",
    f"""WITH {_AFTER} SELECT count(*) AS total_interactions,
    CAST(count(*) FILTER (first_contact_resolution) AS DOUBLE) * 100 / count(*) AS first_contact_pct,
    CAST(sum(handle_time) AS DOUBLE) / count(*) AS avg_handle_time,
    CAST(sum(customer_rating) AS DOUBLE) / count(*) AS avg_rating FROM star""",
)
def kpi_increment(spark: SparkSession, sf: str) -> DataFrame:
    return kpi_state.kpi_interactions(state_after(spark, sf))


_BY = {
    "query_status_increment": ["query_status"],
    "agent_increment": ["pseudo_code"],
    "type_area_increment": ["customer_type_name", "support_area_name"],
    "volume_increment": ["interaction_day"],
}
for _name, _groups in _BY.items():

    @check(_name, f"WITH {_AFTER} SELECT {', '.join(_groups)}, count(*) AS interactions FROM star GROUP BY ALL")
    def _increment(spark: SparkSession, sf: str, groups: list[str] = _groups) -> DataFrame:
        return kpi_state.interactions_by(state_after(spark, sf), *groups)
