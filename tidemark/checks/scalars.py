"""Projections and scalar functions (P)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.checks import carriers as c
from tidemark.checks import oracle as o
from tidemark.checks.registry import check
from tidemark.feeds import ALPHA, BETA, GAMMA, FeedSpec
from tidemark.operators import conform as conforming
from tidemark.operators.dedup import dedup_by_rank, dedup_first_seen
from tidemark.operators.keys import surrogate_key as add_key
from tidemark.operators.merge import cdc_extract
from tidemark.sources.seeds import dimensions

AS_OF = datetime(2026, 1, 1)


def alpha(spark: SparkSession, sf: str) -> DataFrame:
    return c.carrier(spark, sf, c.alpha)


def beta(spark: SparkSession, sf: str) -> DataFrame:
    return c.carrier(spark, sf, c.beta)


def gamma(spark: SparkSession, sf: str) -> DataFrame:
    return c.carrier(spark, sf, c.gamma)


@check("rename_columns", "SELECT * FROM orders")
def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = c.table(spark, sf, "orders")
    return fn.rename_columns(orders.toDF(*[n.upper() for n in orders.columns]))


@check(
    "row_hash",
    f"SELECT serial_number, {o.md5_of(o.HASHED['alpha'])} AS hash_key FROM ({o.RAW['alpha']}) a",
)
def row_hash(spark: SparkSession, sf: str) -> DataFrame:
    columns = list(ALPHA.hash_columns)
    return alpha(spark, sf).select("serial_number", fn.row_hash(columns).alias("hash_key"))


@check(
    "source_identifier",
    f"""SELECT serial_number, 'CLIENT_ALPHA-' || CAST(interaction_id AS VARCHAR)
    AS source_system_identifier FROM ({o.RAW["alpha"]}) a""",
)
def source_identifier(spark: SparkSession, sf: str) -> DataFrame:
    name = fn.source_identifier("CLIENT_ALPHA", "interaction_id")
    return alpha(spark, sf).select("serial_number", name.alias("source_system_identifier"))


@check(
    "parse_ts_dmy",
    f"""SELECT serial_number, try_strptime(contact_date, '%d/%m/%Y %H:%M:%S') AS parsed
    FROM ({o.RAW["alpha"]}) a""",
)
def parse_ts_dmy(spark: SparkSession, sf: str) -> DataFrame:
    return alpha(spark, sf).select("serial_number", fn.parse_ts_dmy("contact_date").alias("parsed"))


@check(
    "parse_ts_compact",
    f"""SELECT topic_offset, try_strptime(date_of_interaction, '%Y%m%d%H%M%S') AS parsed
    FROM ({o.RAW["beta"]}) b""",
)
def parse_ts_compact(spark: SparkSession, sf: str) -> DataFrame:
    parsed = fn.parse_ts_compact("date_of_interaction")
    return beta(spark, sf).select("topic_offset", parsed.alias("parsed"))


@check(
    "parse_ts_mdy_compact",
    f"""SELECT ticket_identifier, try_strptime(date_of_call, '%m%d%Y%H%M%S') AS parsed
    FROM ({o.RAW["gamma"]}) g""",
)
def parse_ts_mdy_compact(spark: SparkSession, sf: str) -> DataFrame:
    parsed = fn.parse_ts_mdy_compact("date_of_call")
    return gamma(spark, sf).select("ticket_identifier", parsed.alias("parsed"))


@check(
    "parse_ts_created",
    f"""SELECT topic_offset, try_strptime(time_stamp, '%Y/%m/%d %H:%M:%S') AS parsed
    FROM ({o.RAW["beta"]}) b""",
)
def parse_ts_created(spark: SparkSession, sf: str) -> DataFrame:
    return beta(spark, sf).select("topic_offset", fn.parse_ts_created("time_stamp").alias("parsed"))


@check(
    "normalise_boolean",
    f"""SELECT 'alpha' AS feed, CAST(interaction_id AS VARCHAR) AS id,
    {o.words("resolved_in_first_contact", "YES", "NO")} AS answer FROM ({o.RAW["alpha"]}) a
    UNION ALL SELECT 'beta', support_identifier, {o.words("first_contact_solve", "TRUE", "FALSE")}
    FROM ({o.RAW["beta"]}) b
    UNION ALL SELECT 'gamma', ticket_identifier, {o.words("resolved_in_first_contact", "1", "0")}
    FROM ({o.RAW["gamma"]}) g""",
)
def normalise_boolean(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        ("alpha", alpha, "interaction_id", "resolved_in_first_contact", "YES", "NO"),
        ("beta", beta, "support_identifier", "first_contact_solve", "TRUE", "FALSE"),
        ("gamma", gamma, "ticket_identifier", "resolved_in_first_contact", "1", "0"),
    ]
    frames = [
        rows(spark, sf).select(
            F.lit(feed).alias("feed"),
            F.col(key).cast("string").alias("id"),
            fn.normalise_boolean(column, yes, no).alias("answer"),
        )
        for feed, rows, key, column, yes, no in parts
    ]
    return conforming.fact_all_sources(*frames)


@check(
    "cast_numeric",
    f"""SELECT ticket_identifier, TRY_CAST(duration AS INT) AS duration,
    TRY_CAST(work_time AS INT) AS work_time FROM ({o.RAW["gamma"]}) g""",
)
def cast_numeric(spark: SparkSession, sf: str) -> DataFrame:
    numbers = [fn.cast_numeric(n).alias(n) for n in ("duration", "work_time")]
    return gamma(spark, sf).select("ticket_identifier", *numbers)


@check(
    "duration_to_seconds",
    f"""SELECT topic_offset, {o.seconds("contact_duration")} AS handled,
    {o.seconds("after_contact_work_time")} AS worked FROM ({o.RAW["beta"]}) b""",
)
def duration_to_seconds(spark: SparkSession, sf: str) -> DataFrame:
    return beta(spark, sf).select(
        "topic_offset",
        fn.duration_to_seconds("contact_duration").alias("handled"),
        fn.duration_to_seconds("after_contact_work_time").alias("worked"),
    )


@check(
    "work_time_from_total",
    f"""SELECT serial_number, total_time - interaction_duration AS work_time
    FROM ({o.RAW["alpha"]}) a""",
)
def work_time_from_total(spark: SparkSession, sf: str) -> DataFrame:
    worked = fn.work_time_from_total("total_time", "interaction_duration")
    return alpha(spark, sf).select("serial_number", worked.alias("work_time"))


@check(
    "rating_halve",
    f"""SELECT serial_number, CASE WHEN rating % 2 = 0 THEN CAST(rating // 2 AS INT)
    ELSE CAST(rating // 2 + 1 AS INT) END AS customer_rating FROM ({o.RAW["alpha"]}) a""",
)
def rating_halve(spark: SparkSession, sf: str) -> DataFrame:
    return alpha(spark, sf).select("serial_number", fn.rating_halve("rating").alias("customer_rating"))


@check(
    "rating_from_label",
    f"""SELECT ticket_identifier, rating, {o._CONFORM["gamma"]["customer_rating"]} AS customer_rating
    FROM ({o.RAW["gamma"]}) g""",
)
def rating_from_label(spark: SparkSession, sf: str) -> DataFrame:
    score = fn.rating_from_label("rating")
    return gamma(spark, sf).select("ticket_identifier", "rating", score.alias("customer_rating"))


def gamma_first(spark: SparkSession, sf: str) -> DataFrame:
    """The first object row of each ticket, found among the line items, which are narrower.

    What is sorted before and after the shuffle is a ticket's number and what orders its rows.
    The object follows from the first of these, so it need not be compared.
    """
    lines = c.table(spark, sf, "lineitem").selectExpr(f"{c.GAMMA_NUMBER} AS l_linenumber", *c.GAMMA_ORDER)
    first = dedup_first_seen(lines, "l_linenumber", tuple(c.GAMMA_ORDER))
    return c.derive(first.withColumn("l_orderkey", F.lit(0).cast("bigint")), c.gamma)


# How rows stand within their key, but for the hash that decides between equal ones.
_RANK = {
    c.alpha: lambda: [F.desc("at")],
    c.beta: lambda: [fn.parse_ts_created("created").desc_nulls_last(), F.desc("at")],
}


def latest_rows(rows: DataFrame, sql: Callable[..., str], spec: FeedSpec) -> DataFrame:
    """The latest document or message of each key, found among the rows of the table.

    These are sorted and shuffled, with no text but their own; the raw row follows from them. The
    hash is made only where a key has several rows of equal rank.
    """
    by_key = Window.partitionBy("number")
    top = c.ranked(rows, sql).withColumn("_rank", F.rank().over(by_key.orderBy(*_RANK[sql]())))
    tied = top.where("_rank = 1").select(
        "number", F.struct(*rows.columns).alias("_row"), *rows.columns, F.count("*").over(by_key).alias("_copies")
    )
    hashed = F.when(F.col("_copies") > 1, fn.row_hash(list(spec.hash_columns)))
    judged = c.derive(tied, sql, "number", "_row", "_copies").select("number", "_row.*", hashed.alias("_hash"))
    return c.derive(dedup_by_rank(judged, "number", [F.desc("_hash")]).select(rows.columns), sql)


def typed_store(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """One active version per key, as the versioned store would hold it after run 1."""
    hashed = rows.withColumn("hash_key", fn.row_hash(list(spec.hash_columns)))
    return _as_stored(dedup_by_rank(hashed, spec.natural_key, [r() for r in spec.rank]), spec)


def latest_store(rows: DataFrame, sql: Callable[..., str], spec: FeedSpec) -> DataFrame:
    """The same for a table's rows, which have not been through a file."""
    kept = latest_rows(rows, sql, spec)
    return _as_stored(kept.withColumn("hash_key", fn.row_hash(list(spec.hash_columns))), spec)


def gamma_store(spark: SparkSession, sf: str) -> DataFrame:
    """The same for object rows, which have not been through a file."""
    kept = gamma_first(spark, sf)
    return _as_stored(kept.withColumn("hash_key", fn.row_hash(list(GAMMA.hash_columns))), GAMMA)


def _as_stored(kept: DataFrame, spec: FeedSpec) -> DataFrame:
    number = F.col(spec.natural_key).cast("bigint")
    stored = fn.tag_run(
        conforming.type_landing(kept, spec).withColumns(
            {
                "prs_record_id": number,
                "source_system_identifier": fn.source_identifier(spec.source, spec.natural_key),
            }
        ),
        {"CLIENT_ALPHA": 1, "CLIENT_BETA": 2, "CLIENT_GAMMA": 3}[spec.source],
        1,
    )
    return fn.scd_defaults(stored, AS_OF)


def _conform_sql(feed: str) -> str:
    return f"WITH {o.DIMS} {o.conformed(feed, o.latest(feed))}"


@check("conform_alpha", _conform_sql("alpha"))
def conform_alpha(spark: SparkSession, sf: str) -> DataFrame:
    store = latest_store(c.table(spark, sf, "events"), c.alpha, ALPHA)
    return conforming.conform_alpha(cdc_extract(store, 1), dimensions(spark))


@check("conform_beta", _conform_sql("beta"))
def conform_beta(spark: SparkSession, sf: str) -> DataFrame:
    store = latest_store(c.table(spark, sf, "orders"), c.beta, BETA)
    return conforming.conform_beta(cdc_extract(store, 1), dimensions(spark))


@check("conform_gamma", _conform_sql("gamma"))
def conform_gamma(spark: SparkSession, sf: str) -> DataFrame:
    store = gamma_store(spark, sf)
    return conforming.conform_gamma(cdc_extract(store, 1), dimensions(spark))


@check(
    "tag_run",
    "SELECT event_id, 1 AS source_id, CAST(7 AS BIGINT) AS dag_run_id FROM events",
)
def tag_run(spark: SparkSession, sf: str) -> DataFrame:
    return fn.tag_run(c.table(spark, sf, "events").select("event_id"), 1, 7)


@check(
    "scd_defaults",
    f"""SELECT event_id, TRUE AS is_active, TIMESTAMP '{c.AS_OF}' AS start_date,
    {o.OPEN_END} AS end_date FROM events""",
)
def scd_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return fn.scd_defaults(c.table(spark, sf, "events").select("event_id"), AS_OF)


@check(
    "surrogate_key",
    "SELECT count(*) AS rows_numbered, count(*) AS distinct_ids, TRUE AS all_above FROM lineitem",
)
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    """The ids themselves follow the file layout; what must hold is checked over all rows."""
    last = 1000
    numbered = add_key(c.table(spark, sf, "lineitem"), "record_id", last)
    per_id = numbered.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("rows_numbered"),
        F.count(F.lit(1)).alias("distinct_ids"),
        (F.min("record_id") > last).alias("all_above"),
    )


@check(
    "coalesce_metrics",
    f"""SELECT dag_run_id, coalesce(batch_count, 0) AS batch_count,
    coalesce(insert_count, 0) AS insert_count, coalesce(update_count, 0) AS update_count,
    coalesce(duplicate_count, 0) AS duplicate_count, coalesce(valid_count, 0) AS valid_count
    FROM ({c.runs(True)}) r""",
)
def coalesce_metrics(spark: SparkSession, sf: str) -> DataFrame:
    names = ["batch_count", "insert_count", "update_count", "duplicate_count", "valid_count"]
    return c.carrier(spark, sf, c.runs).select("dag_run_id", *fn.coalesce_metrics(names))


@check(
    "interval_epoch_seconds",
    f"""SELECT dag_run_id, CAST(epoch(run_end_date - run_start_date) AS DOUBLE) AS run_duration_sec
    FROM ({c.runs(True)}) r""",
)
def interval_epoch_seconds(spark: SparkSession, sf: str) -> DataFrame:
    length = fn.interval_epoch_seconds(fn.run_duration())
    return c.carrier(spark, sf, c.runs).select("dag_run_id", length.alias("run_duration_sec"))


@check(
    "run_duration",
    f"""SELECT dag_run_id, run_start_date + (run_end_date - run_start_date) AS ends_again,
    (run_end_date - run_start_date) > INTERVAL 1 HOUR AS over_an_hour FROM ({c.runs(True)}) r""",
)
def run_duration(spark: SparkSession, sf: str) -> DataFrame:
    """Shown through what the interval does; engines print intervals differently."""
    runs = c.carrier(spark, sf, c.runs).withColumn("d", fn.run_duration())
    return runs.select(
        "dag_run_id",
        (F.col("run_start_date") + F.col("d")).alias("ends_again"),
        (F.col("d") > F.expr("INTERVAL '1' HOUR")).alias("over_an_hour"),
    )
