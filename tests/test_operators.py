from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.values import scd_defaults
from tidemark.operators import audit, conform, dedup, filters, history, keys, merge, quality, reporting
from tidemark.schemas import RUN_HISTORY, RUN_LOG
from tests.helpers import OPEN, T1, T2, T3, rows


# -- dedup ---------------------------------------------------------------------


def test_latest_by_serial(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 12, "b"), (2, 11, "c")], "interaction_id int, serial_number int, v string"
    )
    assert rows(dedup.dedup_latest_by_serial(df)) == [(1, 12, "b"), (2, 11, "c")]


def test_latest_by_created_prefers_readable_times_then_offset(spark):
    df = spark.createDataFrame(
        [
            (1, "2024/01/01 03:00:00", 5, "a"),
            (1, "2024/01/01 03:00:00", 7, "b"),
            (1, None, 9, "c"),
            (1, "not a time", 11, "d"),
        ],
        "support_identifier int, time_stamp string, topic_offset bigint, v string",
    )
    assert rows(dedup.dedup_latest_by_created(df), "topic_offset", "v") == [(7, "b")]


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame(
        [(None, 1), (None, 2), (5, 3)], "interaction_id int, serial_number int"
    )
    assert rows(dedup.dedup_latest_by_serial(df)) == [(5, 3), (None, 2)]


# -- merge ---------------------------------------------------------------------


def _store(spark):
    return spark.createDataFrame(
        [],
        "prs_record_id bigint, k int, hash_key string, is_active boolean,"
        " start_date timestamp_ntz, end_date timestamp_ntz",
    )


def _apply(spark, store, landed, as_of, first_id):
    landing = spark.createDataFrame(landed, "k int, hash_key string")
    classified = merge.merge_classify(landing, store, "k")
    kinds = {r["k"]: r["merge_type"] for r in classified.collect()}
    numbered = keys.surrogate_key(classified.drop("prs_record_id"), "prs_record_id", first_id)
    after = merge.scd2_apply(
        store, numbered.withColumnRenamed("lnd_hash_key", "hash_key"), "k", as_of
    )
    frozen = spark.createDataFrame(after.collect(), store.schema)
    return frozen, kinds, tuple(merge.merge_counts(classified).first())


def test_scd2_over_three_batches(spark):
    store = _store(spark)
    store, kinds, counts = _apply(spark, store, [(1, "x"), (2, "y")], T1, 0)
    assert kinds == {1: "INSERT", 2: "INSERT"} and counts == (2, 0, 0)

    second = [(1, "x"), (2, "z"), (3, "w")]
    store, kinds, counts = _apply(spark, store, second, T2, 100)
    assert kinds == {1: "DUPLICATE", 2: "UPDATE", 3: "INSERT"} and counts == (1, 1, 1)
    active = rows(filters.filter_active(store), "k", "hash_key")
    assert active == [(1, "x"), (2, "z"), (3, "w")]
    closed = rows(store.where("NOT is_active"), "k", "hash_key", "start_date", "end_date")
    assert closed == [(2, "y", T1, T2)]

    again, kinds, counts = _apply(spark, store, second, T3, 200)
    assert counts == (0, 0, 3) and rows(again) == rows(store)

    store, kinds, _ = _apply(spark, store, [(2, "y")], T3, 300)
    assert kinds == {2: "UPDATE"}
    assert rows(store.where("NOT is_active"), "k", "hash_key", "start_date", "end_date") == [
        (2, "y", T1, T2),
        (2, "z", T2, T3),
    ]
    assert rows(filters.filter_active(store), "k", "hash_key") == [(1, "x"), (2, "y"), (3, "w")]


def test_null_key_is_always_an_insert(spark):
    store = scd_defaults(
        spark.createDataFrame([(1, None, "h")], "prs_record_id bigint, k int, hash_key string"), T1
    )
    landing = spark.createDataFrame([(None, "h")], "k int, hash_key string")
    assert rows(merge.merge_classify(landing, store, "k"), "merge_type") == [("INSERT",)]


def test_fact_merge_closes_matches_and_appends_everything(spark):
    stage_schema = "source_system_identifier string, v int, is_valid boolean"
    fact = scd_defaults(
        spark.createDataFrame([("A-1", 1, True), ("A-2", 2, True)], stage_schema), T1
    )
    stage = spark.createDataFrame([("A-2", 3, False), ("A-3", 4, True)], stage_schema)
    after = merge.fact_scd2_merge(fact, stage, T2)
    assert rows(after, "source_system_identifier", "v", "is_active", "end_date") == [
        ("A-1", 1, True, OPEN),
        ("A-2", 2, False, T2),
        ("A-2", 3, True, OPEN),
        ("A-3", 4, True, OPEN),
    ]


def test_cdc_takes_only_this_runs_active_rows(spark):
    store = spark.createDataFrame(
        [(1, 1, True, "h", T1, OPEN), (2, 2, True, "h", T2, OPEN), (3, 2, False, "h", T1, T2)],
        "prs_record_id bigint, dag_run_id bigint, is_active boolean, hash_key string,"
        " start_date timestamp_ntz, end_date timestamp_ntz",
    )
    cdc = merge.cdc_extract(store, 2)
    assert cdc.columns == ["cdc_record_id", "dag_run_id", "start_date"]
    assert rows(cdc, "cdc_record_id") == [(2,)]


# -- validation and errors -----------------------------------------------------

_STAGE = (
    "dag_run_id bigint, source_id int, source_system_identifier string,"
    " source_record_id bigint, is_valid boolean"
)


def _errors(spark, before, stage, as_of, **options):
    after = quality.error_history(before, spark.createDataFrame(stage, _STAGE), as_of, **options)
    return spark.createDataFrame(after.collect(), before.schema)


def test_error_history(spark):
    empty = scd_defaults(quality.error_rows(spark.createDataFrame([], _STAGE)), T1).limit(0)
    one = _errors(spark, empty, [(1, 1, "A-1", 10, False), (1, 1, "A-2", 11, True)], T1)
    assert rows(one, "source_system_identifier", "error_type", "error_description", "is_active") == [
        ("A-1", "INVALID", "A REQUIRED COLUMN IS NULL", True)
    ]
    two = _errors(spark, one, [(2, 1, "A-1", 20, False)], T2)
    assert rows(two, "source_record_id", "is_active", "end_date") == [
        (10, False, T2),
        (20, True, OPEN),
    ]
    healed = [(3, 1, "A-1", 30, True)]
    assert rows(_errors(spark, two, healed, T3)) == rows(two)
    resolved = _errors(spark, two, healed, T3, resolve=True)
    assert rows(resolved, "is_active") == [(False,), (False,)]


def test_validate_required(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (1, None)], "a int, b string")
    checked = quality.validate_required(df, ["a", "b"])
    assert rows(checked, "is_valid") == [(False,), (False,), (True,)]


def test_constraint_audits(spark):
    df = spark.createDataFrame([(1, None), (1, "b"), (3, "c")], "k int, v string")
    assert rows(quality.check_not_null(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    assert rows(quality.check_unique(df, "k")) == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.check_foreign_key(df, "k", parent, "id")) == [(3, 1)]
    spans = spark.createDataFrame([(T1, T2), (T2, T1), (T1, T1)], "a timestamp_ntz, b timestamp_ntz")
    assert rows(quality.check_interval_order(spans, "a", "b")) == [(T2, T1)]


# -- history -------------------------------------------------------------------


def _history(spark, changes, **options):
    df = spark.createDataFrame(changes, "k int, op string, op_ts timestamp_ntz, seq int, v string")
    versions = history.history_from_changes(df, "k", **options)
    return rows(versions, "k", "v", "dml_operation", "start_date", "end_date", "is_active")


def test_history_of_insert_update_delete(spark):
    changes = [(1, "INSERT", T1, 1, "a"), (1, "UPDATE", T2, 2, "b")]
    assert _history(spark, changes) == [
        (1, "a", "INSERT", T1, T2, False),
        (1, "b", "UPDATE", T2, OPEN, True),
    ]
    changes.append((1, "DELETE", T3, 3, "b"))
    assert _history(spark, changes) == [
        (1, "a", "INSERT", T1, T2, False),
        (1, "b", "DELETE", T3, T3, False),
        (1, "b", "UPDATE", T2, T3, False),
    ]


def test_history_does_not_depend_on_the_chunk(spark):
    """Many changes of a busy key, some at the same moment, in chunks of any width."""
    changes = [
        (i % 3 if i % 2 else 0, "UPDATE", datetime(2026, 1, 1, i // 50, (i * 7) % 60), i, str(i))
        for i in range(400)
    ]
    whole = _history(spark, changes, chunk_seconds=10**9)
    for width in (1, 60, 3600):
        assert _history(spark, changes, chunk_seconds=width) == whole
    assert sum(v[-1] for v in whole) == 3


# -- run log -------------------------------------------------------------------


def test_run_log_open_is_idempotent(spark, dims):
    log = spark.createDataFrame([], RUN_LOG)
    arrivals = spark.createDataFrame(
        [("r1", "CLIENT_BETA", T1), ("r1", "CLIENT_BETA", T2), ("r2", "CLIENT_GAMMA", T2)],
        "run_key string, source_name string, run_start_date timestamp_ntz",
    )
    opened = audit.run_log_open(log, arrivals, dims["sources"])
    frozen = spark.createDataFrame(opened.collect(), RUN_LOG)
    assert rows(frozen, "run_key", "source_id", "dag_run_status", "run_start_date") == [
        ("r1", 2, "STARTED", T1),
        ("r2", 3, "STARTED", T2),
    ]
    again = audit.run_log_open(frozen, arrivals, dims["sources"])
    assert rows(again, "dag_run_id", "run_key") == rows(frozen, "dag_run_id", "run_key")
    assert len({r[0] for r in rows(frozen, "dag_run_id")}) == 2


def test_scd1_upsert_last_write_wins(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame(
        [(2, "x", 5), (2, None, 7), (3, "n", 1)], "k int, v string, at int"
    )
    assert rows(audit.scd1_upsert(table, changes, "k", "at")) == [(1, "a"), (2, None), (3, "n")]


def test_status_trail():
    assert audit.run_status_trail(0) == ["STARTED"]
    assert audit.run_status_trail(5)[-2:] == [
        "PROCESSING - ALL LOADING STAGES COMPLETED",
        "SUCCESS",
    ]
    assert audit.run_status_trail(0, failed=True)[-1] == "FAILED - SOURCE TO LND"
    assert audit.run_status_trail(3, failed=True)[-1] == "FAILED - CDC TO PRE-DM"
    assert audit.run_status_trail(5, failed=True)[-1] == "FAILED - FINALIZE DAG RUN"


def test_checkpoint_is_taken_before_duplicates_go(spark):
    batch = spark.createDataFrame([(1, 5), (1, 9), (2, 7)], "k int, pos bigint")
    assert rows(audit.next_checkpoint(batch, "pos")) == [(9,)]
    assert rows(audit.next_checkpoint(batch.limit(0), "pos")) == [(0,)]


# -- keys ----------------------------------------------------------------------


def test_surrogate_keys_are_unique_and_above_the_last(spark):
    numbered = keys.surrogate_key(spark.range(0, 5000, numPartitions=7), "rid", 50)
    ids = [r[0] for r in rows(numbered, "rid")]
    assert len(set(ids)) == 5000 and min(ids) == 51


# -- reporting -----------------------------------------------------------------


def test_run_pages(spark):
    history_rows = [
        (i, "alpha", 1, i, datetime(2026, 1, 1, 0, i), None, 1.0, "Completed", None, None)
        for i in range(12)
    ]
    runs = spark.createDataFrame(history_rows, RUN_HISTORY)
    assert [r.run_id for r in reporting.latest_n_runs(runs, "alpha", 5).collect()] == [11, 10, 9, 8, 7]
    assert reporting.latest_n_runs(runs, "alpha", 7).count() == 7
    assert reporting.latest_n_runs(runs, "alpha", 10).count() == 10


def test_views_show_zero_for_missing_metrics(spark, dims):
    run = [(1, "k", 1, "SUCCESS", T1, T2) + (None,) * 8, (2, "f", 1, "FAILED - X", T1, T2) + (None,) * 8]
    view = reporting.data_metrics_view(spark.createDataFrame(run, RUN_LOG), dims["sources"])
    got = view.collect()
    assert len(got) == 1 and got[0].batch_count == 0 and got[0].run_duration_sec == 0.0


def test_lookups(spark, dims):
    agents = conform.lookup_dictionary(
        dims["agents"], dims["sources"], "CLIENT_GAMMA", "agent_id", "pseudo_code"
    )
    assert agents.count() == 10 and ("ATHOMAS" in {r.pseudo_code for r in agents.collect()})
    assert rows(agents.agg(F.min("agent_id"), F.max("agent_id"))) == [(21, 30)]
    inactive = dims["sources"].withColumn("is_active", F.lit(False))
    none = conform.active_lookup_values(dims["agents"], inactive, "CLIENT_GAMMA", "pseudo_code")
    assert none.count() == 0
