"""Sources (S), new-data probes (I) and sinks (K)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks import carriers as c
from tidemark.checks import oracle as o
from tidemark.checks.registry import check
from tidemark.functions.values import empty_to_null, rename_columns
from tidemark.operators import audit, conform, history, keys
from tidemark.schemas import BETA_RECORD
from tidemark.session import work_folder
from tidemark.sources import layouts, objects, sinks, tables, topic
from tidemark.sources import documents as docs
from tidemark.sources import seeds

ALPHA_FIELDS = ", ".join(["serial_number", *o.HASHED["alpha"]])
BETA_FIELDS = ", ".join(["topic_offset", *o.HASHED["beta"]])
GAMMA_FIELDS = ", ".join(["file_seq", *o.HASHED["gamma"]])
SEQ_CUT = 42  # object number of the last month before SHIP_CUT


def cut(column: str, moment: str) -> str:
    return f"{column} < timestamp_ntz'{moment}'"


def _last(df: DataFrame, where: str, column: str) -> int:
    """Checkpoint a first batch would leave behind."""
    return df.where(where).agg(F.max(column)).first()[0]


@check(
    "scan_documents_since",
    f"""WITH a AS ({o.RAW["alpha"]})
    SELECT {ALPHA_FIELDS} FROM a
    WHERE serial_number > (SELECT max(serial_number) FROM a WHERE {o.FIRST["alpha"]})""",
)
def scan_documents_since(spark: SparkSession, sf: str) -> DataFrame:
    feed = c.carrier(spark, sf, c.alpha)
    path = work_folder(spark, "documents")
    c.write_documents(feed, path)
    checkpoint = _last(feed, cut("ts", c.EVENT_CUT), "serial_number")
    rows = rename_columns(docs.scan_documents_since(spark, path, checkpoint))
    return rows.selectExpr(ALPHA_FIELDS.split(", "))


def _xml_sql() -> str:
    parts = [
        f"'<{n}>' || coalesce(replace({n.lower()}, '&', '&amp;'), '') || '</{n}>'"
        for n in BETA_RECORD.names
    ]
    return "'<RECORD>' || " + " || ".join(parts) + " || '</RECORD>'"


@check(
    "scan_topic_since",
    f"""WITH b AS ({o.RAW["beta"]})
    SELECT topic_offset AS "offset", {_xml_sql()} AS value FROM b
    WHERE topic_offset > (SELECT max(topic_offset) FROM b WHERE {o.FIRST["beta"]})""",
)
def scan_topic_since(spark: SparkSession, sf: str) -> DataFrame:
    feed = c.carrier(spark, sf, c.beta)
    path = work_folder(spark, "topic")
    c.as_messages(feed).write.parquet(path)
    return topic.scan_topic_since(
        spark, path, _last(feed, cut("sent", c.ORDER_CUT), "topic_offset")
    )


# Three partitions with interleaved offsets.
_SPLIT_SQL = "CAST(topic_offset % 3 AS INTEGER) AS partition, topic_offset // 3 AS \"offset\""
_LOADED_SQL = f"""b AS ({o.RAW["beta"]}),
    loaded AS (SELECT topic_offset % 3 AS p, max(topic_offset // 3) AS o FROM b WHERE {o.FIRST["beta"]} GROUP BY 1)"""


def split_topic(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[int, int]]:
    """All messages in three partitions, and the checkpoint that the first half leaves."""
    feed = c.carrier(spark, sf, c.beta)
    place = [(F.col("topic_offset") % 3).cast("int").alias("partition"), F.expr("topic_offset div 3").alias("offset")]
    loaded = topic.next_positions(feed.where(cut("sent", c.ORDER_CUT)).select(*place))
    messages = c.as_messages(feed).withColumnRenamed("offset", "topic_offset").select(*place, "value")
    return messages, {r.partition: r.position for r in loaded.collect()}


@check(
    "scan_topic_partitions",
    f"""WITH {_LOADED_SQL}
    SELECT {_SPLIT_SQL}, {_xml_sql()} AS value FROM b
    LEFT JOIN loaded ON p = topic_offset % 3 WHERE o IS NULL OR topic_offset // 3 > o""",
)
def scan_topic_partitions(spark: SparkSession, sf: str) -> DataFrame:
    messages, checkpoints = split_topic(spark, sf)
    path = work_folder(spark, "topic-partitions")
    messages.write.parquet(path)
    return topic.scan_partitions_since(spark, path, checkpoints)


@check(
    "topic_partition_lag",
    f"""WITH {_LOADED_SQL}
    SELECT CAST(topic_offset % 3 AS INTEGER) AS partition, coalesce(any_value(o), -1) AS loaded,
           max(topic_offset // 3) + 1 AS high, max(topic_offset // 3) - coalesce(any_value(o), -1) AS waiting
    FROM b LEFT JOIN loaded ON p = topic_offset % 3 GROUP BY topic_offset % 3""",
)
def topic_partition_lag(spark: SparkSession, sf: str) -> DataFrame:
    return topic.partition_lag(*split_topic(spark, sf))


@check(
    "scan_csv_objects_since",
    f"""SELECT {GAMMA_FIELDS} FROM ({o.RAW["gamma"]}) g WHERE file_seq > {SEQ_CUT}""",
)
def scan_csv_objects_since(spark: SparkSession, sf: str) -> DataFrame:
    path = work_folder(spark, "objects")
    c.write_objects(c.gamma_lines(spark, sf), path)
    rows = objects.scan_csv_objects_since(spark, path, SEQ_CUT)
    return rows.selectExpr(GAMMA_FIELDS.split(", "))


@check("parse_xml_records", f"SELECT {BETA_FIELDS} FROM ({o.RAW['beta']}) b")
def parse_xml_records(spark: SparkSession, sf: str) -> DataFrame:
    parsed = topic.parse_xml_records(c.as_messages(c.carrier(spark, sf, c.beta)))
    return parsed.drop(topic.CORRUPT)


@check("empty_to_null", f"SELECT {GAMMA_FIELDS} FROM ({o.RAW['gamma']}) g")
def empty_to_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = c.carrier(spark, sf, c.gamma).selectExpr(GAMMA_FIELDS.split(", "))
    return empty_to_null(rows.na.fill(""))


@check(
    "jdbc_subquery_scan",
    """SELECT o_custkey, count(*) AS orders_held, max(o_orderkey) AS newest
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey""",
)
def jdbc_subquery_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The subquery over stored tables; no database is at hand to connect to."""
    return tables.subquery_scan(
        spark,
        "SELECT o_custkey, count(*) AS orders_held, max(o_orderkey) AS newest"
        " FROM {orders} WHERE o_orderstatus <> 'P' GROUP BY o_custkey",
        orders=c.table(spark, sf, "orders"),
    )


def _nations(spark: SparkSession, sf: str) -> DataFrame:
    return c.table(spark, sf, "nation").selectExpr(
        "n_nationkey AS source_id", "n_name AS source_name", "n_regionkey <> 0 AS is_active"
    )


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return c.table(spark, sf, "customer").selectExpr(
        "c_nationkey AS source_id", "c_custkey", "c_name", "c_mktsegment", "c_acctbal > 0 AS is_active"
    )


@check(
    "active_lookup_values",
    """SELECT DISTINCT c_mktsegment FROM customer WHERE c_acctbal > 0 AND c_nationkey =
    (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7' AND n_regionkey <> 0)""",
)
def active_lookup_values(spark: SparkSession, sf: str) -> DataFrame:
    return conform.active_lookup_values(
        _customers(spark, sf), _nations(spark, sf), "NATION_7", "c_mktsegment"
    )


@check(
    "lookup_dictionary",
    """SELECT c_custkey, c_name FROM customer
    WHERE c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7')""",
)
def lookup_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return conform.lookup_dictionary(
        _customers(spark, sf), _nations(spark, sf), "NATION_7", "c_custkey", "c_name"
    )


@check(
    "seed_dimension",
    """SELECT s_suppkey, s_name, n_nationkey AS source_id
    FROM supplier LEFT JOIN nation ON n_name = 'NATION_' || CAST(s_nationkey AS VARCHAR)""",
)
def seed_dimension(spark: SparkSession, sf: str) -> DataFrame:
    rows = c.table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "s_name", "'NATION_' || s_nationkey AS source_name"
    )
    return seeds.seed_dimension(rows, _nations(spark, sf))


# -- new-data probes -----------------------------------------------------------


@check(
    "current_checkpoint",
    f"""SELECT coalesce(max(source_checkpoint), 0) AS checkpoint
    FROM ({c.runs(True)}) r WHERE source_id = 2""",
)
def current_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return audit.current_checkpoint(
        c.carrier(spark, sf, c.runs), seeds.sources(spark), "CLIENT_BETA"
    )


@check(
    "has_new_documents",
    f"""WITH a AS ({o.RAW["alpha"]}) SELECT count(*) > 0 AS has_new FROM a
    WHERE serial_number > (SELECT max(serial_number) FROM a WHERE {o.FIRST["alpha"]})""",
)
def has_new_documents(spark: SparkSession, sf: str) -> DataFrame:
    feed = c.carrier(spark, sf, c.alpha)
    return docs.has_new_documents(feed, _last(feed, cut("ts", c.EVENT_CUT), "serial_number"))


@check(
    "has_topic_lag",
    f"""WITH b AS ({o.RAW["beta"]}) SELECT max(topic_offset) + 1 >
    (SELECT max(topic_offset) FROM b WHERE {o.FIRST["beta"]}) + 10 AS has_new FROM b""",
)
def has_topic_lag(spark: SparkSession, sf: str) -> DataFrame:
    feed = c.carrier(spark, sf, c.beta).withColumn("offset", F.col("topic_offset"))
    return topic.has_topic_lag(feed, _last(feed, cut("sent", c.ORDER_CUT), "topic_offset"))


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    """Object names as a listing would return them, numbered from the name."""
    name = F.format_string(c.OBJECT_FORMAT, "file_seq")
    listed = c.carrier(spark, sf, c.gamma).select(name.alias("file_name")).distinct()
    return listed.withColumn("file_seq", objects.object_sequence(F.col("file_name")))


@check(
    "has_new_objects",
    f"SELECT max(file_seq) > {SEQ_CUT} AS has_new FROM ({o.RAW['gamma']}) g",
)
def has_new_objects(spark: SparkSession, sf: str) -> DataFrame:
    return objects.has_new_objects(_listing(spark, sf), SEQ_CUT)


@check(
    "order_files_by_sequence",
    f"""SELECT DISTINCT file_seq, lpad(CAST(file_seq AS VARCHAR), 10, ' ')
    || '_client_gamma_support_data_20240101_000000.csv.gz' AS file_name FROM ({o.RAW["gamma"]}) g""",
)
def order_files_by_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return objects.order_files_by_sequence(_listing(spark, sf))


@check(
    "next_checkpoint",
    f"SELECT max(topic_offset) AS next_checkpoint FROM ({o.RAW['beta']}) b",
)
def next_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return audit.next_checkpoint(c.carrier(spark, sf, c.beta), "topic_offset")


# -- layouts -------------------------------------------------------------------


@check(
    "routed_fact",
    f"""WITH {o.DIMS} SELECT f.* FROM ({c.facts(True)}) f JOIN src USING (source_id)
    WHERE source_name = 'CLIENT_BETA'""",
)
def routed_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The facts of one source, found through the sources dimension in a routed layout."""
    path, facts = work_folder(spark, "routed"), c.carrier(spark, sf, c.facts)
    layouts.write_routed(facts, path)
    one = seeds.sources(spark).where("source_name = 'CLIENT_BETA'")
    return layouts.of_sources(layouts.read_routed(spark, path, facts.schema), one)


_EVENT_VERSIONS = """SELECT user_id, event_id AS seq, value, ts AS start_date,
    coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '9999-12-31 23:59:59') AS end_date
    FROM events"""


def event_versions(spark: SparkSession, sf: str) -> DataFrame:
    changes = c.table(spark, sf, "events").selectExpr(
        "user_id", "event_id AS seq", "value", "'UPDATE' AS op", "ts AS op_ts"
    )
    versions = history.history_from_changes(changes, "user_id")
    return versions.select("user_id", "seq", "value", "start_date", "end_date")


@check(
    "versions_at_moments",
    f"""WITH v AS ({_EVENT_VERSIONS}), m AS (
    SELECT min(ts) + (max(ts) - min(ts)) / 4 AS a, min(ts) + (max(ts) - min(ts)) / 2 AS b, max(ts) AS c FROM events),
    t AS (SELECT 0 AS moment, date_trunc('second', a) AS held FROM m UNION ALL SELECT 1, date_trunc('second', b) FROM m
          UNION ALL SELECT 2, date_trunc('second', c) FROM m)
    SELECT moment, v.* FROM v JOIN t ON start_date <= held AND end_date > held""",
)
def versions_at_moments(spark: SparkSession, sf: str) -> DataFrame:
    """The versions in force at three moments, from a layout by the month of their end."""
    path, versions = work_folder(spark, "by-end"), event_versions(spark, sf)
    layouts.write_by_end(versions, path)
    low, high = c.table(spark, sf, "events").agg(F.min("ts"), F.max("ts")).first()
    moments = [(low + (high - low) / part).replace(microsecond=0) for part in (4, 2, 1)]
    laid = layouts.read_by_end(spark, path, versions.schema)
    found = [
        layouts.versions_at(laid, at).withColumn("moment", F.lit(i)) for i, at in enumerate(moments)
    ]
    return objects.union_files(*found)


@check(
    "interval_lookup",
    """SELECT e.event_id, e.user_id, e.ts, p.value AS purchase_value
    FROM events e ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p
    ON e.user_id = p.user_id AND e.ts >= p.ts""",
)
def interval_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with its user's last purchase as of then."""
    events = c.table(spark, sf, "events")
    changes = events.where("event_type = 'purchase'").selectExpr(
        "user_id", "event_id AS seq", "value AS purchase_value", "'UPDATE' AS op", "ts AS op_ts"
    )
    versions = history.history_from_changes(changes, "user_id")
    shown = events.select("event_id", "user_id", "ts")
    return layouts.interval_lookup(shown, versions, "user_id", "ts", ["purchase_value"])


TASK_ROWS = 4_000_000


@check(
    "dense_surrogate_key",
    """SELECT batch, count(*) AS records, CASE batch WHEN 0 THEN 1 ELSE (SELECT count(*) FROM lineitem) + 1 END AS first_id,
    CASE batch WHEN 0 THEN count(*) ELSE (SELECT count(*) FROM lineitem) + count(*) END AS last_id, count(*) AS ids
    FROM (SELECT 0 AS batch FROM lineitem UNION ALL SELECT 1 FROM orders) b GROUP BY batch""",
)
def dense_surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of two written batches: they follow each other without a gap."""
    out, last = [], 0
    for batch, name in enumerate(("lineitem", "orders")):
        path = work_folder(spark, "numbered")
        stored = c.table(spark, sf, name)
        rows = stored.repartition(7 + stored.count() // TASK_ROWS)
        keys.surrogate_key(rows.select(F.lit(batch).alias("batch")), "id", last).write.parquet(path)
        dense = keys.dense_key(spark.read.parquet(path), "id", last)
        figures = keys.id_figures(dense, "batch", "id")
        out.append(figures)
        last = figures.first()["last_id"]
    return objects.union_files(*out)


# -- sinks ---------------------------------------------------------------------


@check("sink_overwrite", "SELECT * FROM orders")
def sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded twice: the second load replaces the first."""
    path = work_folder(spark, "landing")
    rows = c.table(spark, sf, "orders")
    for _ in range(2):
        sinks.sink_overwrite(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@check(
    "sink_append",
    """SELECT event_id, user_id, event_type, value, CAST(day(ts) AS BIGINT) AS dag_run_id FROM events""",
)
def sink_append(spark: SparkSession, sf: str) -> DataFrame:
    """Every run's rows arrive twice, as after a retry, and are there once."""
    path = work_folder(spark, "appended")
    rows = c.table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "event_type", "value", "CAST(day(ts) AS BIGINT) AS dag_run_id"
    )
    for _ in range(2):
        sinks.sink_append(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@check(
    "route_partition",
    f"""SELECT source_system_identifier, source_id,
    CASE source_id WHEN 1 THEN 'alpha' WHEN 2 THEN 'beta' WHEN 3 THEN 'gamma' ELSE 'default' END
    AS partition_name FROM ({c.facts(True)}) f""",
)
def route_partition(spark: SparkSession, sf: str) -> DataFrame:
    fact = c.carrier(spark, sf, c.facts)
    return fact.select(
        "source_system_identifier", "source_id", sinks.route_partition().alias("partition_name")
    )


@check("union_files", "SELECT event_id, ts, user_id, event_type, value FROM events")
def union_files(spark: SparkSession, sf: str) -> DataFrame:
    """Feed parts with their columns in different order, put back together."""
    rows = c.table(spark, sf, "events").drop("props")
    kinds = ["click", "view"]
    rest = rows.where(~F.col("event_type").isin(kinds)).select(*reversed(rows.columns))
    return objects.union_files(*[rows.where(F.col("event_type") == k) for k in kinds], rest)
