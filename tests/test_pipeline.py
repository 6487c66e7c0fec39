"""The batch pipeline over real raw files: three feeds, crashes, retries, replays."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.feeds import ALPHA, BETA, GAMMA
from tidemark.functions.values import rename_columns
from tidemark.operators.filters import filter_active
from tidemark.operators.reporting import customer_support_fact_view, data_metrics_view
from tidemark.plans import ingest
from tidemark.plans.state import FeedState
from tidemark.sources import objects, topic
from tidemark.sources.documents import scan_documents_since
from tests.helpers import (
    OPEN,
    T1,
    T2,
    T3,
    document,
    message,
    rows,
    ticket,
    write_documents,
    write_object,
)


def alpha(spark, folder, state):
    return rename_columns(scan_documents_since(spark, str(folder), ingest.scan_since(state, -1)))


FIRST = [document(1, 1), document(2, 2), document(3, 3, AGENT_PSEUDO_NAME="GHOST"), document(4, 1, RATING=3)]
SECOND = [
    document(5, 2, INTERACTION_STATUS="DROPPED"),
    document(6, 4, CONTACT_DATE=None),
    document(7, 1, RATING=3),  # the same content as stored: a duplicate
    document(8, 3, AGENT_PSEUDO_NAME="GHOST", RATING=1),
]


@pytest.fixture
def run_alpha(spark, dims, tmp_path):
    state = FeedState(spark, str(tmp_path / "state"), "CLIENT_ALPHA", buckets=4)
    folder = tmp_path / "docs"

    def step(name, docs, as_of):
        if docs:
            write_documents(folder, name, docs)
        return ingest.ingest_batch(state, ALPHA, alpha(spark, folder, state), dims, name, as_of)

    if not folder.exists():
        folder.mkdir()
    return state, step


def test_two_document_batches(spark, dims, run_alpha):
    state, step = run_alpha
    one = step("run-1", FIRST, T1)
    assert (one.batch_count, one.insert_count, one.valid_count, one.checkpoint) == (3, 3, 2, 4)
    two = step("run-2", SECOND, T2)
    assert (two.batch_count, two.insert_count, two.update_count, two.duplicate_count) == (4, 1, 2, 1)
    assert two.valid_count == 1 and two.checkpoint == 8

    fact = ingest.fact_versions(state)
    shown = ["source_system_identifier", "interaction_status", "is_valid", "is_active", "start_date", "end_date"]
    assert rows(fact, *shown) == [
        ("CLIENT_ALPHA-1", "COMPLETED", True, True, T1, OPEN),
        ("CLIENT_ALPHA-2", "COMPLETED", True, False, T1, T2),
        ("CLIENT_ALPHA-2", "DROPPED", True, True, T2, OPEN),
        ("CLIENT_ALPHA-3", "COMPLETED", False, False, T1, T2),
        ("CLIENT_ALPHA-3", "COMPLETED", False, True, T2, OPEN),
        ("CLIENT_ALPHA-4", "COMPLETED", False, True, T2, OPEN),
    ]
    first = fact.where("source_system_identifier = 'CLIENT_ALPHA-1'").first()
    assert (first.handle_time, first.work_time, first.customer_rating) == (120, 30, 2)
    assert first.interaction_date == datetime(2021, 1, 1)
    assert (first.agent_id, first.support_area_id, first.customer_type_id) == (1, 1, 3)

    assert rows(ingest.stage_rows(state)) == rows(fact.drop("is_active", "start_date", "end_date"))

    errors = ingest.error_versions(state)
    assert rows(errors, "source_system_identifier", "is_active", "end_date") == [
        ("CLIENT_ALPHA-3", False, T2),
        ("CLIENT_ALPHA-3", True, OPEN),
        ("CLIENT_ALPHA-4", True, OPEN),
    ]
    for table, key in ((fact, "fact_id"), (errors, "data_error_id")):
        assert table.count() == table.select(key).distinct().count()
    stored = ingest.persisted_versions(state, ALPHA)
    assert stored.count() == stored.select("prs_record_id").distinct().count() == 6
    joined = fact.join(stored, fact.source_record_id == stored.prs_record_id)
    assert joined.where(fact.source_system_identifier != stored.source_system_identifier).count() == 0
    assert joined.count() == fact.count()

    metrics = data_metrics_view(ingest.run_log(state), dims["sources"])
    assert rows(metrics, "dag_run_id", "batch_count", "insert_count", "update_count", "valid_count") == [
        (1, 3, 3, 0, 2),
        (2, 4, 1, 2, 1),
    ]
    view = customer_support_fact_view(fact, dims, T3)
    assert rows(view, "source_system_identifier", "pseudo_code", "support_area_name") == [
        ("CLIENT_ALPHA-1", "JDOE", "ORDER ISSUES"),
        ("CLIENT_ALPHA-2", "JDOE", "ORDER ISSUES"),
    ]


def test_replayed_and_empty_batches_change_nothing(run_alpha):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    before = rows(ingest.fact_versions(state))
    assert step("run-1", [], T2).replayed
    assert step("run-2", [], T2).seq == 0
    assert rows(ingest.fact_versions(state)) == before and state.latest().seq == 1


def test_an_older_run_key_is_not_applied_again(run_alpha):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    assert step("run-2", SECOND, T2).seq == 2
    after = rows(ingest.fact_versions(state))
    again = step("run-1", [document(8, 1, RATING=5)], T3)
    assert again == ingest.BatchResult(1, checkpoint=state.latest().source_checkpoint, replayed=True)
    assert rows(ingest.fact_versions(state)) == after and state.latest().seq == 2


def test_a_published_number_is_refused(run_alpha):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    with pytest.raises(RuntimeError, match="already published"):
        state.publish(state.commits(), 1, "other")


def test_redelivered_batch_is_all_duplicates(run_alpha):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    before = rows(ingest.fact_versions(state))
    again = [d | {"serial_number": d["serial_number"] + 10} for d in FIRST]
    result = step("run-2", again, T2)
    assert (result.insert_count, result.update_count, result.duplicate_count) == (0, 0, 3)
    assert rows(ingest.fact_versions(state)) == before
    assert state.latest().source_checkpoint == 14


@pytest.mark.parametrize(
    "broken", ["landing_to_persisted", "stage_to_fact", "finalise"]
)
def test_a_crash_at_any_stage_is_invisible_and_repeatable(run_alpha, monkeypatch, broken):
    """The stage does its work and then dies, which is the worst moment for a retry."""
    state, step = run_alpha
    step("run-1", FIRST, T1)
    before = rows(ingest.fact_versions(state)), rows(ingest.error_versions(state))
    whole = getattr(ingest._Run, broken)

    def dies(self, *args):
        if broken != "finalise":
            whole(self, *args)
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest._Run, broken, dies)
        with pytest.raises(RuntimeError) as failure:
            step("run-2", SECOND, T2)
    if broken != "finalise":
        assert failure.value.status.startswith("FAILED - ")
    assert state.latest().seq == 1
    assert (rows(ingest.fact_versions(state)), rows(ingest.error_versions(state))) == before

    result = step("run-2", [], T2)
    assert (result.insert_count, result.update_count, result.duplicate_count) == (1, 2, 1)
    fact = ingest.fact_versions(state)
    assert fact.count() == 6 and filter_active(fact).count() == 4


def test_sweep_removes_only_superseded_buckets(run_alpha):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    step("run-2", SECOND, T2)
    before = rows(ingest.fact_versions(state)), rows(ingest.error_versions(state))
    assert state.sweep(state.latest()) > 0
    assert (rows(ingest.fact_versions(state)), rows(ingest.error_versions(state))) == before
    assert state.sweep(state.latest()) == 0


def test_documents_without_a_key_stay_inserts(run_alpha):
    state, step = run_alpha
    step("run-1", [document(1, None, RATING=2), document(2, 5)], T1)
    result = step("run-2", [document(3, None, RATING=2)], T2)
    assert (result.insert_count, result.update_count, result.duplicate_count) == (1, 0, 0)


def test_message_feed(spark, dims, tmp_path):
    state = FeedState(spark, str(tmp_path / "state"), "CLIENT_BETA", buckets=4)
    path = str(tmp_path / "topic")

    def deliver(start, values):
        messages = [(start + i, v) for i, v in enumerate(values)]
        spark.createDataFrame(messages, "offset bigint, value string").write.mode("append").parquet(path)

    def step(name, as_of):
        batch = topic.parse_xml_records(
            topic.scan_topic_since(spark, path, ingest.scan_since(state, -1))
        )
        return ingest.ingest_batch(state, BETA, batch, dims, name, as_of)

    late, early = "2024/01/01 09:00:00", "2024/01/01 08:00:00"
    deliver(0, [message(1, TIME_STAMP=late), message(1, SUPPORT_RATING="1", TIME_STAMP=early), message(2)])
    one = step("b1", T1)
    assert (one.batch_count, one.insert_count, one.checkpoint) == (2, 2, 2)
    assert rows(ingest.fact_versions(state), "source_system_identifier", "customer_rating", "handle_time", "work_time") == [
        ("CLIENT_BETA-1", 4, 120, 65),
        ("CLIENT_BETA-2", 4, 120, 65),
    ]
    # A re-emission differs in its time stamp, which is hashed: an update.
    deliver(3, [message(2, TIME_STAMP="2024/02/01 00:00:00"), "broken message", message(3, CONTACT_DURATION="1:00")])
    two = step("b2", T2)
    assert (two.insert_count, two.update_count, two.duplicate_count, two.valid_count) == (1, 1, 0, 1)
    assert two.checkpoint == 5
    rejected = spark.read.parquet(state.batch_path(2, "rejected"))
    assert rows(rejected) == [(4, "broken message")]


def test_object_feed(spark, dims, tmp_path):
    state = FeedState(spark, str(tmp_path / "state"), "CLIENT_GAMMA", buckets=4)
    folder = tmp_path / "objects"

    def step(name, as_of):
        batch = objects.scan_csv_objects_since(spark, str(folder), ingest.scan_since(state, 0))
        return ingest.ingest_batch(state, GAMMA, batch, dims, name, as_of)

    write_object(folder, 1, [ticket("1"), ticket("2", RATING="best")])
    write_object(folder, 2, [ticket("1", RATING="WORST")])
    one = step("g1", T1)
    assert (one.batch_count, one.valid_count, one.checkpoint) == (2, 1, 2)
    write_object(folder, 10, [ticket("1", RATING="WORST"), ticket("3", RESOLVED_IN_FIRST_CONTACT=None)])
    two = step("g2", T2)
    assert (two.insert_count, two.update_count, two.checkpoint) == (1, 1, 10)
    assert rows(filter_active(ingest.fact_versions(state)), "source_system_identifier", "customer_rating", "is_valid") == [
        ("CLIENT_GAMMA-1", 1, True),
        ("CLIENT_GAMMA-2", None, False),
        ("CLIENT_GAMMA-3", 5, False),
    ]


def test_batch_cost_does_not_depend_on_history(run_alpha, spark):
    """A batch reads the buckets its keys fall into and never the closed versions."""
    state, step = run_alpha
    step("run-1", [document(i, i) for i in range(1, 41)], T1)
    step("run-2", [document(100 + i, i, RATING=1) for i in range(1, 41)], T2)
    commit = state.latest()
    touched = next(iter(commit.buckets))[1]
    read = state.active(commit, ingest.FACT, ingest.FACT_SCHEMA, {touched}).inputFiles()
    assert read and all(f"slot={touched}/" in f for f in read)
    step("run-3", [document(200, 1, RATING=2)], T3)
    after = state.latest().buckets
    moved = [k for k, seq in after.items() if seq == 3 and k[0] == ingest.FACT]
    assert len(moved) == 1
    assert filter_active(ingest.fact_versions(state)).agg(F.count_distinct("source_system_identifier"), F.count(F.lit(1))).first()[:] == (40, 40)


def test_another_bucket_count_is_refused(spark, run_alpha, tmp_path):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    other = FeedState(spark, str(tmp_path / "state"), "CLIENT_ALPHA", buckets=8)
    with pytest.raises(ValueError, match="4 buckets"):
        other.latest()
    assert FeedState(spark, str(tmp_path / "state"), "CLIENT_ALPHA", buckets=4).latest().seq == 1


def test_unreadable_keys_stay_apart(spark, dims, run_alpha, tmp_path):
    state, _ = run_alpha
    write_documents(tmp_path / "docs", "one", FIRST)
    rows = alpha(spark, tmp_path / "docs", state)
    first = rows.limit(1)
    keys = ["abc", "xyz", "12x", "7", "7", None, None]
    batch = first.drop("interaction_id").crossJoin(spark.createDataFrame([(k,) for k in keys], "interaction_id string"))
    landed = ingest.land(batch.select(rows.columns), ALPHA)
    assert sorted(str(r.interaction_id) for r in landed.collect()) == ["7", "None", "None", "None", "None"]


def test_rebucketing_keeps_every_row(spark, run_alpha, dims, tmp_path):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    before = rows(ingest.fact_versions(state)), rows(ingest.error_versions(state))
    stored = rows(ingest.persisted_versions(state, ALPHA))
    other = state.rebucket(7, T2)
    with pytest.raises(ValueError, match="7 buckets"):
        state.latest()
    assert (rows(ingest.fact_versions(other)), rows(ingest.error_versions(other))) == before
    assert rows(ingest.persisted_versions(other, ALPHA)) == stored
    assert rows(ingest.run_log(other), "run_key") == [("run-1",)]
    write_documents(tmp_path / "docs", "run-2", SECOND)
    two = ingest.ingest_batch(other, ALPHA, alpha(spark, tmp_path / "docs", other), dims, "run-2", T3)
    assert (two.seq, two.insert_count, two.update_count, two.duplicate_count) == (3, 1, 2, 1)
    fact = ingest.fact_versions(other)
    assert fact.count() == 6 and filter_active(fact).count() == 4
    assert other.sweep(other.latest()) > 0 and ingest.fact_versions(other).count() == 6


def test_an_empty_feed_can_be_rebucketed(spark, tmp_path):
    state = FeedState(spark, str(tmp_path / "state"), "CLIENT_ALPHA", buckets=4).rebucket(9, T1)
    assert state.latest().seq == 0 and state.bucket_count == 9


def test_failed_and_unfinished_runs_are_in_the_log(run_alpha, monkeypatch):
    state, step = run_alpha
    step("run-1", FIRST, T1)
    with monkeypatch.context() as patch:
        patch.setattr(ingest._Run, "finalise", lambda *args: 1 / 0)
        with pytest.raises(ingest.StageFailed):
            step("run-2", SECOND, T2)
        patch.setattr(ingest._Run, "cdc_to_stage", lambda self: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            step("killed", [], T2)
    shown = ["run_key", "dag_run_status", "dag_run_id", "batch_count"]
    assert rows(ingest.run_log(state), *shown) == [
        ("killed", "STARTED", None, None),
        ("run-1", "SUCCESS", 1, 3),
        ("run-2", "FAILED - FINALIZE DAG RUN", None, None),
    ]
    assert [r.status for r in ingest.failed_trail(state).where("run_key = 'run-2'").orderBy("seq").collect()][-1] == "FAILED - FINALIZE DAG RUN"
    step("run-2", [], T2)
    assert rows(ingest.run_log(state).where("run_key = 'run-2'"), *shown) == [("run-2", "SUCCESS", 2, 4)]


def test_what_a_dead_batch_left_is_not_published_by_another(run_alpha, monkeypatch):
    """The dead batch closed an error version; the batch that gets its number has no errors."""
    state, step = run_alpha
    step("run-1", FIRST, T1)
    with monkeypatch.context() as patch:
        patch.setattr(ingest._Run, "finalise", lambda *args: 1 / 0)
        with pytest.raises(ingest.StageFailed):
            step("run-2", [document(5, 3, AGENT_PSEUDO_NAME="GHOST", RATING=1)], T2)
    step("run-3", [document(6, 3)], T2)
    errors = ingest.error_versions(state)
    assert rows(errors, "source_system_identifier", "is_active") == [("CLIENT_ALPHA-3", True)]
