"""Support data derived from the given tables, for exercising the operators.

Each carrier is one SELECT over whole tables, written so that both Spark and the
oracle can run it; only date formatting differs. The given tables are not support
data, so names, statuses and defects (unknown agents, unreadable dates, missing
answers) are assigned from their columns. Modulo is used only to pick a value for a
row, never to pick rows.

* document feed  <- ``events``:   the same user and props key come again as updates
* message feed   <- ``orders``:   a customer's orders of one priority share a key
* object feed    <- ``lineitem``: order and line number repeat; one object per month
* run log        <- ``orders``
* fact           <- ``lineitem``
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ALPHA_DOCUMENT, BETA_RECORD, GAMMA_OBJECT
from tidemark.sources import seeds
from tidemark.sources.documents import land_documents

# Batches are cut at these moments; everything is in one batch or the other.
EVENT_CUT = "2024-01-16 00:00:00"
ORDER_CUT = "1998-07-01 00:00:00"
SHIP_CUT = "1998-07-01 00:00:00"
LATER_OFFSETS = 1_000_000_000_000
AS_OF = "2026-01-01 00:00:00"

_STRFTIME = {
    "dd/MM/yyyy HH:mm:ss": "%d/%m/%Y %H:%M:%S",
    "yyyyMMddHHmmss": "%Y%m%d%H%M%S",
    "MMddyyyyHHmmss": "%m%d%Y%H%M%S",
    "yyyy/MM/dd HH:mm:ss": "%Y/%m/%d %H:%M:%S",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(expr: str, layout: str, duck: bool) -> str:
    if duck:
        return f"strftime({expr}, '{_STRFTIME[layout]}')"
    return f"date_format({expr}, '{layout}')"


def pick(index: str, values: list[str], otherwise: str = "NULL") -> str:
    whens = " ".join(
        f"WHEN {i} THEN '{v}'" for i, v in enumerate(value.replace("'", "''") for value in values)
    )
    return f"CASE {index} {whens} ELSE {otherwise} END"


def clock(seconds: str) -> str:
    """Whole seconds as H:MM:SS."""
    h, m, s = (
        f"CAST(FLOOR(({seconds}) / 3600.0) AS INT)",
        f"CAST(FLOOR((({seconds}) % 3600) / 60.0) AS INT)",
        f"CAST(({seconds}) % 60 AS INT)",
    )
    two = "lpad(CAST({} AS STRING), 2, '0')"
    return f"CAST({h} AS STRING) || ':' || {two.format(m)} || ':' || {two.format(s)}"


INCIDENT = [
    "RESOLVED",
    "PENDING RESOLUTION",
    "PENDING CUSTOMER UPDATE",
    "WORK IN PROGRESS",
    "TRANSFERRED TO ANOTHER QUEUE",
]
SOLUTION = ["SELF-HELP OPTION", "SUPPORT TEAM INTERVENTION"]


def _dim(block: dict[str, str], source: str) -> list[str]:
    return seeds.names(block[source])


ALPHA_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"


def alpha(duck: bool = False) -> str:
    """Raw documents, one per event; ``ts`` is kept to cut batches by."""
    area = pick("k % 11", _dim(seeds.SUPPORT_AREAS, "CLIENT_ALPHA"))
    agent = pick("user_id % 11", _dim(seeds.AGENTS, "CLIENT_ALPHA"), "'NOBODY'")
    kind = pick("event_id % 10", _dim(seeds.CUSTOMER_TYPES, "CLIENT_ALPHA"))
    return f"""
    SELECT event_id AS serial_number, user_id * 100 + k AS interaction_id,
           {area} AS support_category, {agent} AS agent_pseudo_name,
           CASE WHEN k % 23 = 0 THEN '32/13/2024 00:00:00'
                ELSE {text("ts", "dd/MM/yyyy HH:mm:ss", duck)} END AS contact_date,
           CASE event_type WHEN 'error' THEN 'DROPPED' WHEN 'signup' THEN 'TRANSFERRED'
                ELSE 'COMPLETED' END AS interaction_status,
           CASE WHEN event_type IN ('click', 'view') THEN 'CHAT' ELSE 'CALL' END AS interaction_type,
           {kind} AS type_of_customer,
           CAST(FLOOR(value * 10) AS INT) AS interaction_duration,
           CAST(FLOOR(value * 10) AS INT) + k AS total_time,
           {pick("k % 5", INCIDENT)} AS status_of_customer_incident,
           CASE event_type WHEN 'purchase' THEN 'YES' WHEN 'click' THEN 'no' WHEN 'view' THEN 'Yes'
                WHEN 'signup' THEN 'NO' ELSE 'UNKNOWN' END AS resolved_in_first_contact,
           {pick("k % 2", SOLUTION)} AS solution_type,
           CAST(event_id % 10 + 1 AS INT) AS rating, ts
    FROM (SELECT *, {ALPHA_K} AS k FROM events) e"""


BETA_NUMBER = "o_custkey * 5 + CAST(substr(o_orderpriority, 1, 1) AS INT)"
BETA_OFFSET = f"""CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN o_orderkey
                ELSE o_orderkey + {LATER_OFFSETS} END"""


def beta(duck: bool = False) -> str:
    """Message fields, one message per order; ``sent`` is kept to cut batches by."""
    area = pick("o_orderkey % 11", _dim(seeds.SUPPORT_AREAS, "CLIENT_BETA"))
    agent = pick("o_custkey % 11", _dim(seeds.AGENTS, "CLIENT_BETA"), "'NOBODY'")
    kind = pick("o_orderkey % 10", _dim(seeds.CUSTOMER_TYPES, "CLIENT_BETA"))
    return f"""
    SELECT {BETA_OFFSET} AS topic_offset,
           CAST({BETA_NUMBER} AS STRING)
               AS support_identifier,
           {area} AS contact_regarding, {agent} AS agent_code,
           {text("o_orderdate", "yyyyMMddHHmmss", duck)} AS date_of_interaction,
           CASE o_orderstatus WHEN 'O' THEN 'INTERACTION COMPLETED' WHEN 'F' THEN 'CUSTOMER DROPPED'
                ELSE 'TRANSFERRED' END AS status_of_interaction,
           CASE WHEN o_totalprice < 200000 THEN 'CALL' ELSE 'CHAT' END AS type_of_interaction,
           {kind} AS customer_type,
           {clock("CAST(FLOOR(o_totalprice) AS BIGINT) % 7200 + 10")} AS contact_duration,
           CASE WHEN o_orderkey % 13 = 0 THEN '1:00' ELSE {clock("o_custkey % 900")} END
               AS after_contact_work_time,
           {pick("o_orderkey % 5", INCIDENT)} AS incident_status,
           CASE o_orderstatus WHEN 'O' THEN 'TRUE' WHEN 'F' THEN 'false' ELSE 'True' END
               AS first_contact_solve,
           {pick("o_orderkey % 2", SOLUTION)} AS type_of_resolution,
           CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE CAST(o_orderkey % 5 + 1 AS STRING) END
               AS support_rating,
           {text("o_orderdate", "yyyy/MM/dd HH:mm:ss", duck)} AS time_stamp,
           o_orderdate AS sent
    FROM orders"""


# Row order inside an object: every remaining column, so that no two rows tie.
GAMMA_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


GAMMA_SEQ = "CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS BIGINT)"
GAMMA_NUMBER = "l_orderkey * 8 + l_linenumber"
GAMMA_TICKET = f"CAST({GAMMA_NUMBER} AS STRING)"


def gamma(duck: bool = False) -> str:
    """Object rows, one per line item, with the month as sequence number."""
    area = pick("l_partkey % 11", _dim(seeds.SUPPORT_AREAS, "CLIENT_GAMMA"))
    agent = pick("l_suppkey % 11", _dim(seeds.AGENTS, "CLIENT_GAMMA"), "'NOBODY'")
    kind = pick("l_partkey % 10", _dim(seeds.CUSTOMER_TYPES, "CLIENT_GAMMA"))
    rating = pick("l_partkey % 5", ["WORST", "BAD", "NEUTRAL", "GOOD", "BEST"])
    return f"""
    SELECT {GAMMA_SEQ} AS file_seq,
           {GAMMA_TICKET} AS ticket_identifier,
           {area} AS support_category, {agent} AS agent_name,
           {text("l_shipdate", "MMddyyyyHHmmss", duck)} AS date_of_call,
           CASE WHEN l_linestatus = 'O' THEN 'COMPLETED' ELSE 'DROPPED' END AS call_status,
           CASE l_returnflag WHEN 'A' THEN 'CALL' WHEN 'N' THEN 'CHAT' ELSE 'EMAIL' END AS call_type,
           {kind} AS type_of_customer,
           CAST(CAST(l_quantity AS INT) * 10 AS STRING) AS duration,
           CASE WHEN l_partkey % 19 = 0 THEN 'n/a' ELSE CAST(l_suppkey % 300 AS STRING) END AS work_time,
           {pick("l_suppkey % 5", INCIDENT)} AS ticket_status,
           CASE WHEN l_linestatus = 'O' THEN '1' WHEN l_returnflag = 'A' THEN NULL ELSE '0' END
               AS resolved_in_first_contact,
           {pick("l_partkey % 2", SOLUTION)} AS resolution_category,
           CASE WHEN l_suppkey % 29 = 0 THEN 'best' ELSE {rating} END AS rating,
           {", ".join(GAMMA_ORDER)}
    FROM lineitem"""


RUN_STATUS = """CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'PROCESSING - PRS TO CDC'
                ELSE 'FAILED - LND TO PRS' END"""


def runs(duck: bool = False) -> str:
    """One run per order. Unfinished runs have no counts."""
    gap = "to_seconds(CAST(o_custkey % 7200 AS INT))" if duck else (
        "make_dt_interval(0, 0, 0, CAST(o_custkey % 7200 AS INT))"
    )
    share = "CAST(FLOOR((o_orderkey % 500) / 2.0) AS BIGINT)"
    done = "CASE WHEN o_orderstatus <> 'O' THEN {} END"
    return f"""
    SELECT o_orderkey AS dag_run_id, 'run-' || CAST(o_orderkey AS STRING) AS run_key,
           CAST(o_custkey % 4 AS INT) AS source_id, {RUN_STATUS} AS dag_run_status,
           o_orderdate AS run_start_date, o_orderdate + {gap} AS run_end_date,
           {done.format("o_custkey % 1000 + o_orderkey % 500 + o_orderkey % 7")} AS batch_count,
           {done.format("o_custkey % 1000")} AS insert_count,
           {done.format("o_orderkey % 500")} AS update_count,
           {done.format("o_orderkey % 7")} AS duplicate_count,
           {done.format(f"o_custkey % 1000 + {share}")} AS valid_count,
           o_orderkey AS source_checkpoint
    FROM orders"""


def facts(duck: bool = False) -> str:
    """Fact versions with dimension ids; some ids and sources have no dimension row."""
    month = "INTERVAL 30 DAY" if duck else "INTERVAL '30' DAY"
    return f"""
    SELECT CAST(l_suppkey % 4 AS INT) AS source_id, l_orderkey * 8 + l_linenumber AS source_record_id,
           'F-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
               AS source_system_identifier,
           CAST(l_suppkey % 31 AS INT) AS agent_id, l_shipdate AS interaction_date,
           CAST(l_partkey % 31 AS INT) AS support_area_id,
           CASE WHEN l_linestatus = 'O' THEN 'COMPLETED' ELSE 'DROPPED' END AS interaction_status,
           CASE l_returnflag WHEN 'A' THEN 'CALL' ELSE 'CHAT' END AS interaction_type,
           CAST(l_orderkey % 31 AS INT) AS customer_type_id,
           CAST(l_quantity AS INT) * 10 AS handle_time, CAST(l_suppkey % 300 AS INT) AS work_time,
           l_returnflag = 'A' AS first_contact_resolution,
           {pick("l_suppkey % 5", INCIDENT)} AS query_status,
           {pick("l_partkey % 2", SOLUTION)} AS solution_type,
           CAST(l_partkey % 5 + 1 AS INT) AS customer_rating,
           l_orderkey AS dag_run_id, l_returnflag <> 'R' AS is_valid,
           l_linestatus = 'O' AS is_active, l_shipdate AS start_date,
           CASE WHEN l_linestatus = 'O' THEN TIMESTAMP '9999-12-31 23:59:59'
                ELSE l_shipdate + {month} END AS end_date
    FROM lineitem"""


_BASE = {alpha: "events", beta: "orders", gamma: "lineitem", runs: "orders", facts: "lineitem"}


def _spark(expr: str) -> str:
    return expr.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")


def derive(rows: DataFrame, sql: Callable[..., str], *kept: str) -> DataFrame:
    """Run one of the SELECTs above in Spark over rows of its table, with further columns of
    theirs in ``kept``."""
    base = _BASE[sql]
    shown, rest = sql().split("\n    FROM ", 1)
    rest = f"FROM {rest}".replace(f"FROM {base}", f"FROM {{{base}}}")
    query = _spark(f"{', '.join([shown, *kept])} {rest}")
    return rows.sparkSession.sql(query, **{base: rows})


def ranked(rows: DataFrame, sql: Callable[..., str]) -> DataFrame:
    """Rows of a table with the ``number`` that their document's or message's key is made of, and
    what ranks them within it: ``at`` and for messages the ``created`` text."""
    key, at, *created = {
        alpha: (f"user_id * 100 + {ALPHA_K}", "event_id"),
        beta: (BETA_NUMBER, BETA_OFFSET, text("o_orderdate", "yyyy/MM/dd HH:mm:ss", False)),
    }[sql]
    more = [f"{_spark(e)} AS {n}" for e, n in zip((key, at, *created), ("number", "at", "created"))]
    return rows.selectExpr("*", *more)


def carrier(spark: SparkSession, sf_dir: str, sql: Callable[..., str]) -> DataFrame:
    """Run one of the SELECTs above in Spark."""
    return derive(table(spark, sf_dir, _BASE[sql]), sql)


def gamma_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the object and ticket that ``gamma`` gives them.

    What moves or sorts all rows does so with these, and derives the texts afterwards: they
    follow from the row, and are several times as wide.
    """
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr("*", f"{GAMMA_SEQ} AS file_seq", f"{GAMMA_TICKET} AS ticket_identifier")


# -- raw formats ---------------------------------------------------------------


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite", span: int = 50_000) -> None:
    """Documents as JSON, with the field names the producer uses, by ranges of serial numbers."""
    lower = {n.lower(): n for n in ALPHA_DOCUMENT.names}
    named = docs.withColumns(
        {
            "_id": F.concat_ws("-", "serial_number", "interaction_id"),
            "record_id": F.col("interaction_id"),
        }
    )
    land_documents(named.select(*[F.col(c).alias(n) for c, n in lower.items()]), path, span, mode)


def as_messages(records: DataFrame) -> DataFrame:
    """Message rows ``(offset, value)`` with one XML record each."""
    def element(name: str):
        escaped = F.replace(F.col(name.lower()), F.lit("&"), F.lit("&amp;"))
        return F.concat(F.lit(f"<{name}>"), F.coalesce(escaped, F.lit("")), F.lit(f"</{name}>"))

    body = F.concat(F.lit("<RECORD>"), *[element(n) for n in BETA_RECORD.names], F.lit("</RECORD>"))
    return records.select(F.col("topic_offset").alias("offset"), body.alias("value"))


def write_messages(messages: DataFrame, path: str, most: int = 100_000) -> None:
    """Messages as Parquet, at most ``most`` a file: a file of many, well compressed, would be
    one row group and so one task's parsing."""
    messages.write.mode("append").option("maxRecordsPerFile", most).parquet(path)


OBJECT_FORMAT = "%10d_client_gamma_support_data_20240101_000000.csv.gz"


def object_rows(lines: DataFrame) -> DataFrame:
    """Rows of ``gamma_lines`` as raw object rows, in the order of the objects and their rows.

    Lines are range-partitioned over object and row order, so a large object becomes
    several part files in order instead of one task's work. The texts are derived where they
    are written: the pass that samples the ranges and the shuffle do without them.
    """
    # Not nullable and first in the sort: otherwise the writer sorts by object again,
    # and an unstable second sort would lose the row order.
    name = F.coalesce(F.format_string(OBJECT_FORMAT, "file_seq"), F.lit(""))
    moved = lines.withColumn("object", name).drop("file_seq", "ticket_identifier")
    placed = moved.repartitionByRange("object", *GAMMA_ORDER).sortWithinPartitions("object", *GAMMA_ORDER)
    columns = [F.col(n.lower()).alias(n) for n in GAMMA_OBJECT.names]
    return derive(placed, gamma, "object").select(*columns, "object")


def write_objects(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows of ``gamma_lines`` as gzip pipe CSV, one object per sequence number."""
    (
        object_rows(lines)
        .write.partitionBy("object")
        .mode(mode)
        .option("sep", "|")
        .option("header", True)
        .option("quoteAll", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("compression", "gzip")
        .csv(path)
    )
