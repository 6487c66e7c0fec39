"""Validation and error history (H4, H5), constraint audits (C), the run log (H8, H10, H11)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.checks import carriers as c
from tidemark.checks import oracle as o
from tidemark.checks.merges import STAGED, STORED_AT, _conformed
from tidemark.checks.registry import check
from tidemark.checks.reports import PERCENT, RUNS
from tidemark.checks.scalars import AS_OF
from tidemark.operators import audit, history
from tidemark.operators import quality as q
from tidemark.sources import seeds


@check("validate_required", f"WITH {STAGED} SELECT * FROM before UNION ALL BY NAME SELECT * FROM stage")
def validate_required(spark: SparkSession, sf: str) -> DataFrame:
    """Both batches of messages."""
    return _conformed(spark, sf, True).unionByName(_conformed(spark, sf, False))


_ERROR = """dag_run_id, source_id, 'INVALID' AS error_type,
    'A REQUIRED COLUMN IS NULL' AS error_description, source_system_identifier, source_record_id"""


@check(
    "error_history",
    f"""WITH {STAGED},
    old AS (SELECT {_ERROR} FROM before WHERE NOT is_valid),
    new AS (SELECT {_ERROR} FROM stage WHERE NOT is_valid)
    SELECT old.*, new.source_system_identifier IS NULL AS is_active,
           TIMESTAMP '2025-01-01' AS start_date,
           CASE WHEN new.source_system_identifier IS NULL THEN {o.OPEN_END}
                ELSE TIMESTAMP '{c.AS_OF}' END AS end_date
    FROM old LEFT JOIN new USING (source_system_identifier)
    UNION ALL BY NAME
    SELECT *, TRUE AS is_active, TIMESTAMP '{c.AS_OF}' AS start_date, {o.OPEN_END} AS end_date FROM new""",
)
def error_history(spark: SparkSession, sf: str) -> DataFrame:
    errors = fn.scd_defaults(q.error_rows(_conformed(spark, sf, True)), STORED_AT)
    return q.error_history(errors, _conformed(spark, sf, False), AS_OF)


# -- constraint audits ---------------------------------------------------------

_GAMMA_COLUMNS = ["ticket_identifier", "support_category", "resolved_in_first_contact", "rating"]


@check(
    "check_not_null",
    " UNION ALL ".join(
        f"SELECT '{x}' AS column_name, count(*) FILTER ({x} IS NULL) AS violations"
        f" FROM ({o.RAW['gamma']}) g"
        for x in _GAMMA_COLUMNS
    ),
)
def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return q.check_not_null(c.carrier(spark, sf, c.gamma), _GAMMA_COLUMNS)


@check(
    "check_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
)
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return q.check_unique(c.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@check(
    "check_foreign_key",
    """SELECT reference, count(*) AS violations FROM
    (SELECT l_partkey * 2 AS reference FROM lineitem) l
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = reference) GROUP BY reference""",
)
def check_foreign_key(spark: SparkSession, sf: str) -> DataFrame:
    """Part numbers are doubled, so that about half of them refer to nothing."""
    child = c.table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("part_ref"))
    return q.check_foreign_key(child, "part_ref", c.table(spark, sf, "part"), "p_partkey")


@check(
    "check_interval_order",
    """SELECT l_orderkey, l_linenumber, l_shipdate AS start_date,
    l_shipdate + to_days(l_linenumber - 3) AS end_date FROM lineitem WHERE l_linenumber < 3""",
)
def check_interval_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = c.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate AS start_date",
        "l_shipdate + make_dt_interval(l_linenumber - 3) AS end_date",
    )
    return q.check_interval_order(rows, "start_date", "end_date")


# -- run log -------------------------------------------------------------------

_OPENED = "run_key, source_id, dag_run_status, run_start_date, run_end_date"


@check(
    "run_log_open",
    f"""WITH {o.DIMS} SELECT {_OPENED} FROM ({RUNS}) r
    UNION ALL
    SELECT 'user-' || CAST(user_id AS VARCHAR), first(source_id), 'STARTED', min(ts), {o.OPEN_END}
    FROM events LEFT JOIN src ON source_name = 'CLIENT_BETA' GROUP BY user_id""",
)
def run_log_open(spark: SparkSession, sf: str) -> DataFrame:
    """Known run keys arrive again and new ones many times; each new one opens one run."""
    log = c.carrier(spark, sf, c.runs)
    known = log.select("run_key", F.lit("CLIENT_ALPHA").alias("source_name"), "run_start_date")
    new = c.table(spark, sf, "events").selectExpr(
        "'user-' || user_id AS run_key", "'CLIENT_BETA' AS source_name", "ts AS run_start_date"
    )
    opened = audit.run_log_open(log, known.unionByName(new), seeds.sources(spark))
    return opened.selectExpr(_OPENED.split(", "))


@check(
    "run_log_close",
    f"""SELECT dag_run_id, run_key, source_id, 'SUCCESS' AS dag_run_status, run_start_date,
    TIMESTAMP '{c.AS_OF}' AS run_end_date, batch_count, insert_count, update_count, duplicate_count,
    valid_count, {PERCENT} AS validity_percentage, source_checkpoint,
    CAST(epoch(TIMESTAMP '{c.AS_OF}' - run_start_date) AS DOUBLE) AS run_duration_sec
    FROM ({RUNS}) r WHERE batch_count IS NOT NULL""",
)
def run_log_close(spark: SparkSession, sf: str) -> DataFrame:
    log = c.carrier(spark, sf, c.runs)
    names = ["batch_count", "insert_count", "update_count", "duplicate_count", "valid_count"]
    counts = log.where("batch_count IS NOT NULL").select("dag_run_id", *names, "source_checkpoint")
    closed = audit.run_log_close(log, counts, AS_OF)
    return closed.withColumn("run_duration_sec", fn.interval_epoch_seconds("run_duration")).drop(
        "run_duration"
    )


_ENDS = {"F": (5, False), "O": (2, False), "P": (1, True)}


def _trail(status: str) -> list[str]:
    return audit.run_status_trail(*_ENDS[status])


def _trail_sql() -> str:
    """The trails spelled out, not taken from the operator."""
    steps = [
        "STARTED",
        "PROCESSING - LND TO PRS",
        "PROCESSING - PRS TO CDC",
        "PROCESSING - CDC TO PRE-DM",
        "PROCESSING - PRE-DM TO DM",
        "PROCESSING - ALL LOADING STAGES COMPLETED",
        "SUCCESS",
    ]
    lists = {"F": steps, "O": steps[:3], "P": [*steps[:2], "FAILED - LND TO PRS"]}
    rows = [
        f"('{status}', {i}, '{step}')" for status, chain in lists.items() for i, step in enumerate(chain)
    ]
    return ", ".join(rows)


@check(
    "run_status_trail",
    f"""WITH steps(o_orderstatus, seq, status) AS (VALUES {_trail_sql()}),
    trail AS (SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_key, status, seq,
                     o_orderdate + to_seconds(seq) AS start_date
              FROM orders JOIN steps USING (o_orderstatus)),
    timed AS (SELECT *, lead(start_date) OVER (PARTITION BY run_key ORDER BY seq) AS following FROM trail)
    SELECT run_key, status, seq, CASE seq WHEN 0 THEN 'INSERT' ELSE 'UPDATE' END AS dml_operation,
           start_date, coalesce(following, {o.OPEN_END}) AS end_date, following IS NULL AS is_active
    FROM timed""",
)
def run_status_trail(spark: SparkSession, sf: str) -> DataFrame:
    """Every run's status changes as versions of its run-log row."""
    chain = F.lit(None)
    for status in _ENDS:
        steps = F.array(*[F.lit(s) for s in _trail(status)])
        chain = F.when(F.col("o_orderstatus") == status, steps).otherwise(chain)
    orders = c.table(spark, sf, "orders")
    steps = orders.select(
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_key"),
        "o_orderdate",
        F.posexplode(chain).alias("seq", "status"),
    )
    at = F.expr("o_orderdate + make_dt_interval(0, 0, 0, seq)")
    changes = audit.status_changes(steps.select("run_key", "status", "seq", at.alias("op_ts")))
    return history.history_from_changes(changes, "run_key")
