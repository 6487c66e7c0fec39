"""Filters (F), dedup (W), joins (J), merges and history (H1-H3, H6, H7, H9), unions (U)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.checks import carriers as c
from tidemark.checks import oracle as o
from tidemark.checks.registry import check
from tidemark.checks.scalars import AS_OF, alpha, beta, gamma_first, gamma_store, latest_store
from tidemark.feeds import ALPHA, BETA, GAMMA
from tidemark.operators import audit, conform, dedup, filters, history, merge, quality
from tidemark.sources import seeds

# The stored batch ends after the landed one begins: what lies between arrives again.
LANDED_FROM, STORED_UNTIL = "2024-01-11 00:00:00", "2024-01-21 00:00:00"
STORED_AT = datetime(2025, 1, 1)
KEY = "interaction_id"
FIELDS = "interaction_id, hash_key, support_category, rating"


def _picked(spark: SparkSession, sf: str, where: str) -> DataFrame:
    rows = alpha(spark, sf).where(where)
    hashed = rows.withColumn("hash_key", fn.row_hash(list(ALPHA.hash_columns)))
    return dedup.dedup_latest_by_serial(hashed)


def landing(spark: SparkSession, sf: str) -> DataFrame:
    return _picked(spark, sf, f"ts >= timestamp_ntz'{LANDED_FROM}'")


def store(spark: SparkSession, sf: str) -> DataFrame:
    """Versions as two earlier batches left them: one active per key, older ones closed."""
    columns = [f.strip() for f in FIELDS.split(",")]

    def versions(until: str, run: int) -> DataFrame:
        rows = _picked(spark, sf, f"ts < timestamp_ntz'{until}'")
        return fn.tag_run(rows.selectExpr("serial_number AS prs_record_id", *columns), 1, run)

    active = fn.scd_defaults(versions(STORED_UNTIL, 2), STORED_AT)
    closed = fn.scd_defaults(versions(LANDED_FROM, 1), datetime(2024, 6, 1)).withColumns(
        {"is_active": F.lit(False), "end_date": fn.values.ts_literal(STORED_AT)}
    )
    return active.unionByName(closed)


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_classify(landing(spark, sf), store(spark, sf), KEY)


MERGE = f"""
    landing AS ({o.latest("alpha", f"ts >= TIMESTAMP '{LANDED_FROM}'")}),
    stored AS ({o.latest("alpha", f"ts < TIMESTAMP '{STORED_UNTIL}'")}),
    older AS ({o.latest("alpha", f"ts < TIMESTAMP '{LANDED_FROM}'")}),
    store AS (
        SELECT serial_number AS prs_record_id, {FIELDS}, 1 AS source_id, CAST(2 AS BIGINT) AS dag_run_id,
               TRUE AS is_active, TIMESTAMP '2025-01-01' AS start_date, {o.OPEN_END} AS end_date
        FROM stored
        UNION ALL
        SELECT serial_number, {FIELDS}, 1, CAST(1 AS BIGINT), FALSE, TIMESTAMP '2024-06-01',
               TIMESTAMP '2025-01-01' FROM older),
    classified AS (
        SELECT l.* EXCLUDE (hash_key), l.hash_key AS lnd_hash_key, s.prs_record_id,
               s.hash_key AS prs_hash_key,
               CASE WHEN s.prs_record_id IS NULL THEN 'INSERT'
                    WHEN s.hash_key <> l.hash_key THEN 'UPDATE' ELSE 'DUPLICATE' END AS merge_type
        FROM landing l LEFT JOIN store s ON l.{KEY} = s.{KEY} AND s.is_active)"""
SHOWN = "serial_number, interaction_id, lnd_hash_key, prs_record_id, prs_hash_key"


# -- dedup ---------------------------------------------------------------------


@check("dedup_latest_by_serial", o.latest("alpha").replace("SELECT * EXCLUDE (rn)", "SELECT * EXCLUDE (rn, hash_key)"))
def dedup_latest_by_serial(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_latest_by_serial(alpha(spark, sf))


@check("dedup_latest_by_created", o.latest("beta").replace("SELECT * EXCLUDE (rn)", "SELECT * EXCLUDE (rn, hash_key)"))
def dedup_latest_by_created(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_latest_by_created(beta(spark, sf))


@check("dedup_first_seen", o.latest("gamma").replace("SELECT * EXCLUDE (rn)", "SELECT * EXCLUDE (rn, hash_key)"))
def dedup_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return gamma_first(spark, sf)


# -- filters -------------------------------------------------------------------

_FACT_ID = "source_system_identifier, source_record_id, dag_run_id, source_id"


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return c.carrier(spark, sf, c.facts)


@check("filter_active", f"SELECT {_FACT_ID} FROM ({c.facts(True)}) f WHERE is_active")
def filter_active(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_active(_facts(spark, sf)).selectExpr(_FACT_ID.split(", "))


@check(
    "filter_run",
    f"SELECT * FROM ({c.runs(True)}) r WHERE dag_run_id = 77 AND source_id ="
    f" (SELECT source_id FROM ({c.runs(True)}) q WHERE dag_run_id = 77)",
)
def filter_run(spark: SparkSession, sf: str) -> DataFrame:
    """One run's rows for its own source; both are pushed to the scan."""
    runs = c.carrier(spark, sf, c.runs)
    owner = filters.filter_run(runs, 77).first()["source_id"]
    return filters.filter_run(runs, 77, owner)


@check(
    "filter_merge_type",
    f"WITH {MERGE} SELECT {SHOWN}, merge_type FROM classified WHERE merge_type <> 'DUPLICATE'",
)
def filter_merge_type(spark: SparkSession, sf: str) -> DataFrame:
    changed = filters.filter_merge_type(classified(spark, sf))
    return changed.selectExpr(*SHOWN.split(", "), "merge_type")


@check("filter_invalid", f"SELECT {_FACT_ID} FROM ({c.facts(True)}) f WHERE NOT is_valid")
def filter_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_invalid(_facts(spark, sf)).selectExpr(_FACT_ID.split(", "))


@check(
    "valid_as_of",
    f"""SELECT {_FACT_ID}, start_date, end_date FROM ({c.facts(True)}) f WHERE is_active
    AND is_valid AND TIMESTAMP '1998-07-01' BETWEEN start_date AND end_date""",
)
def valid_as_of(spark: SparkSession, sf: str) -> DataFrame:
    held = filters.valid_as_of(_facts(spark, sf), datetime(1998, 7, 1))
    return held.selectExpr(*_FACT_ID.split(", "), "start_date", "end_date")


@check(
    "filter_success_runs",
    f"SELECT * FROM ({c.runs(True)}) r WHERE dag_run_status = 'SUCCESS'",
)
def filter_success_runs(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_success_runs(c.carrier(spark, sf, c.runs))


@check(
    "filter_beyond_checkpoint",
    """SELECT event_id, user_id, event_type FROM events WHERE event_id >
    (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16')""",
)
def filter_beyond_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    events = c.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    loaded = events.where("ts < timestamp_ntz'2024-01-16 00:00:00'")
    last = audit.max_or_zero(loaded, "event_id").first()[0]
    return filters.filter_beyond_checkpoint(events.drop("ts"), "event_id", last)


# -- joins ---------------------------------------------------------------------


@check("join_landing_to_active", f"WITH {MERGE} SELECT {SHOWN} FROM classified")
def join_landing_to_active(spark: SparkSession, sf: str) -> DataFrame:
    joined = merge.join_landing_to_active(landing(spark, sf), store(spark, sf), KEY)
    return joined.selectExpr(SHOWN.split(", "))


@check(
    "lookup_join",
    """SELECT o_orderkey, o_custkey, c_name, n_nationkey, o_orderpriority
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_name = 'NATION_' || CAST(o_orderkey % 40 AS VARCHAR)""",
)
def lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """Two lookups: one against a growing table, one by a name that may be unknown."""
    orders = c.table(spark, sf, "orders").withColumn(
        "nation_name", F.expr("'NATION_' || (o_orderkey % 40)")
    )
    customers = c.table(spark, sf, "customer").select("c_name", "c_custkey")
    joined = conform.lookup_join(
        orders,
        (customers, "c_name", "c_custkey", "o_custkey"),
        (c.table(spark, sf, "nation"), "n_nationkey", "n_name", "nation_name"),
    )
    return joined.select("o_orderkey", "o_custkey", "c_name", "n_nationkey", "o_orderpriority")


def _conformed(spark: SparkSession, sf: str, first: bool) -> DataFrame:
    """Validated stage rows of the message feed, one batch or the other."""
    edge = f"o_orderdate < timestamp_ntz'{c.ORDER_CUT}'"
    rows = c.table(spark, sf, "orders").where(edge if first else f"NOT ({edge})")
    stored = latest_store(rows, c.beta, BETA).withColumn("dag_run_id", F.lit(1 if first else 2).cast("long"))
    cdc = merge.cdc_extract(stored, 1 if first else 2)
    staged = conform.conform_beta(cdc, seeds.dimensions(spark))
    return quality.validate_required(staged)


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return fn.scd_defaults(_conformed(spark, sf, True), STORED_AT)


STAGED = f"""{o.DIMS},
    before AS (SELECT *, ({o.VALID}) AS is_valid
               FROM ({o.conformed("beta", o.latest("beta", o.FIRST["beta"]), 1)}) x),
    stage AS (SELECT *, ({o.VALID}) AS is_valid
              FROM ({o.conformed("beta", o.latest("beta", f"NOT ({o.FIRST['beta']})"), 2)}) x)"""


@check(
    "join_stage_to_fact",
    f"""WITH {STAGED} SELECT s.*, CASE WHEN f.source_system_identifier IS NULL THEN 'INSERT'
    ELSE 'UPDATE' END AS merge_type
    FROM stage s LEFT JOIN before f ON f.source_system_identifier = s.source_system_identifier""",
)
def join_stage_to_fact(spark: SparkSession, sf: str) -> DataFrame:
    return merge.join_stage_to_fact(_conformed(spark, sf, False), _fact(spark, sf))


@check(
    "fact_scd2_merge",
    f"""WITH {STAGED}
    SELECT b.*, s.source_system_identifier IS NULL AS is_active,
           TIMESTAMP '2025-01-01' AS start_date,
           CASE WHEN s.source_system_identifier IS NULL THEN {o.OPEN_END}
                ELSE TIMESTAMP '{c.AS_OF}' END AS end_date
    FROM before b LEFT JOIN stage s ON s.source_system_identifier = b.source_system_identifier
    UNION ALL
    SELECT s.*, TRUE, TIMESTAMP '{c.AS_OF}', {o.OPEN_END} FROM stage s""",
)
def fact_scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge.fact_scd2_merge(_fact(spark, sf), _conformed(spark, sf, False), AS_OF)


@check(
    "update_from_keys",
    f"""WITH {MERGE} SELECT s.* REPLACE (s.is_active AND k.{KEY} IS NULL AS is_active,
    CASE WHEN s.is_active AND k.{KEY} IS NOT NULL THEN TIMESTAMP '{c.AS_OF}' ELSE s.end_date END AS end_date)
    FROM store s LEFT JOIN (SELECT {KEY} FROM classified WHERE merge_type = 'UPDATE') k
    ON k.{KEY} = s.{KEY}""",
)
def update_from_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = merge.affected_keys(classified(spark, sf), KEY)
    return merge.update_from_keys(store(spark, sf), keys, KEY, AS_OF)


@check(
    "affected_keys",
    f"WITH {MERGE} SELECT {KEY} FROM classified WHERE merge_type = 'UPDATE'",
)
def affected_keys(spark: SparkSession, sf: str) -> DataFrame:
    return merge.affected_keys(classified(spark, sf), KEY)


@check(
    "scalar_subquery_join",
    f"SELECT dag_run_id, run_key FROM ({c.runs(True)}) r WHERE source_id = 3",
)
def scalar_subquery_join(spark: SparkSession, sf: str) -> DataFrame:
    runs = c.carrier(spark, sf, c.runs)
    mine = audit.of_source(runs, seeds.sources(spark), "CLIENT_GAMMA")
    return mine.select("dag_run_id", "run_key")


# -- merges --------------------------------------------------------------------


@check("merge_classify", f"WITH {MERGE} SELECT {SHOWN}, merge_type FROM classified")
def merge_classify(spark: SparkSession, sf: str) -> DataFrame:
    return classified(spark, sf).selectExpr(*SHOWN.split(", "), "merge_type")


@check(
    "merge_counts",
    f"""WITH {MERGE} SELECT count(*) FILTER (merge_type = 'INSERT') AS insert_count,
    count(*) FILTER (merge_type = 'UPDATE') AS update_count,
    count(*) FILTER (merge_type = 'DUPLICATE') AS duplicate_count FROM classified""",
)
def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_counts(classified(spark, sf))


APPLIED = f"""
    applied AS (
        SELECT s.* REPLACE (s.is_active AND k.{KEY} IS NULL AS is_active,
               CASE WHEN s.is_active AND k.{KEY} IS NOT NULL THEN TIMESTAMP '{c.AS_OF}'
                    ELSE s.end_date END AS end_date)
        FROM store s LEFT JOIN (SELECT {KEY} FROM classified WHERE merge_type = 'UPDATE') k
             ON k.{KEY} = s.{KEY}
        UNION ALL
        SELECT serial_number, interaction_id, lnd_hash_key, support_category, rating, 1,
               CAST(3 AS BIGINT), TRUE, TIMESTAMP '{c.AS_OF}', {o.OPEN_END}
        FROM classified WHERE merge_type <> 'DUPLICATE')"""


def _applied(spark: SparkSession, sf: str) -> DataFrame:
    batch = classified(spark, sf).withColumns(
        {"prs_record_id": F.col("serial_number"), "hash_key": F.col("lnd_hash_key")}
    )
    return merge.scd2_apply(store(spark, sf), fn.tag_run(batch, 1, 3), KEY, AS_OF)


@check("scd2_apply", f"WITH {MERGE}, {APPLIED} SELECT * FROM applied")
def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _applied(spark, sf)


@check(
    "cdc_extract",
    f"""WITH {MERGE}, {APPLIED} SELECT prs_record_id AS cdc_record_id, interaction_id,
    support_category, rating, source_id, dag_run_id, start_date
    FROM applied WHERE is_active AND dag_run_id = 3""",
)
def cdc_extract(spark: SparkSession, sf: str) -> DataFrame:
    return merge.cdc_extract(_applied(spark, sf), 3)


# -- history -------------------------------------------------------------------

_OP = "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END"


@check(
    "history_from_changes",
    f"""SELECT user_id, event_id AS seq, value, dml_operation, ts AS start_date,
    CASE WHEN dml_operation = 'DELETE' THEN ts ELSE coalesce(following, {o.OPEN_END}) END AS end_date,
    dml_operation <> 'DELETE' AND following IS NULL AS is_active
    FROM (SELECT *, {_OP} AS dml_operation,
                 lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following
          FROM events) e""",
)
def history_from_changes(spark: SparkSession, sf: str) -> DataFrame:
    changes = c.table(spark, sf, "events").selectExpr(
        "user_id", "event_id AS seq", "value", f"{_OP} AS op", "ts AS op_ts"
    )
    return history.history_from_changes(changes, "user_id")


@check(
    "history_increment",
    f"""SELECT user_id, event_id AS seq, value, dml_operation, ts AS start_date,
    CASE WHEN dml_operation = 'DELETE' THEN ts ELSE coalesce(following, {o.OPEN_END}) END AS end_date,
    dml_operation <> 'DELETE' AND following IS NULL AS is_active
    FROM (SELECT *, {_OP} AS dml_operation,
                 lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following
          FROM events) e""",
)
def history_increment(spark: SparkSession, sf: str) -> DataFrame:
    """All events in three batches; updates come last, most of them late."""
    changes = c.table(spark, sf, "events").selectExpr(
        "user_id", "event_id AS seq", "value", f"{_OP} AS op", "ts AS op_ts"
    )
    done = history.history_from_changes(changes.where("op = 'DELETE'"), "user_id")
    for kind in ("INSERT", "UPDATE"):
        done = history.history_increment(done, changes.where(F.col("op") == kind), "user_id")
    return done


@check(
    "scd1_upsert",
    """SELECT c_custkey, CASE WHEN n > 0 THEN newest ELSE c_mktsegment END AS c_mktsegment
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n,
         arg_max(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) AS newest
         FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""",
)
def scd1_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Customers take the priority of their latest order; the others keep their segment."""
    table = c.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    changes = c.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        F.struct("o_orderdate", "o_orderkey").alias("at"),
    )
    return audit.scd1_upsert(table, changes, "c_custkey", "at")


# -- set operations ------------------------------------------------------------


@check("distinct_lookup", "SELECT DISTINCT p_type FROM part")
def distinct_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return conform.distinct_lookup(c.table(spark, sf, "part"), "p_type")


@check("distinct", "SELECT DISTINCT l_shipdate FROM lineitem")
def distinct(spark: SparkSession, sf: str) -> DataFrame:
    return conform.distinct_lookup(c.table(spark, sf, "lineitem"), "l_shipdate")


@check(
    "fact_all_sources",
    f"WITH {o.DIMS} " + " UNION ALL BY NAME ".join(o.conformed(x, o.latest(x)) for x in o.RAW),
)
def fact_all_sources(spark: SparkSession, sf: str) -> DataFrame:
    dims = seeds.dimensions(spark)
    stores = [
        (latest_store(c.table(spark, sf, "events"), c.alpha, ALPHA), ALPHA),
        (latest_store(c.table(spark, sf, "orders"), c.beta, BETA), BETA),
        (gamma_store(spark, sf), GAMMA),
    ]
    return conform.fact_all_sources(
        *[conform.conform(merge.cdc_extract(store, 1), spec, dims) for store, spec in stores]
    )
