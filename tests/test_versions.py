"""Append-only feeds: the cases of the bucketed feed, two writers, and what a batch writes."""

from __future__ import annotations

import random
import threading
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import OPEN, T1, T2, T3, document, rows, ticket, write_documents, write_object
from tests.test_pipeline import (  # noqa: F401  the same cases, over the fixture below
    FIRST,
    SECOND,
    alpha,
    test_a_crash_at_any_stage_is_invisible_and_repeatable,
    test_a_published_number_is_refused,
    test_an_older_run_key_is_not_applied_again,
    test_failed_and_unfinished_runs_are_in_the_log,
    test_two_document_batches,
    test_what_a_dead_batch_left_is_not_published_by_another,
)
from tidemark.feeds import ALPHA, GAMMA
from tidemark.functions.values import rename_columns
from tidemark.operators.versions import active_of, current_of, versions_at_read
from tidemark.plans import ingest
from tidemark.plans.state import FeedState
from tidemark.plans.versions import AlreadyPublished, VersionLog
from tidemark.sources.objects import number_object_rows
from tidemark.sources.sinks import create_absent, read_text
from tidemark.streaming import ingest as streaming


@pytest.fixture
def run_alpha(spark, dims, tmp_path):
    state = VersionLog(spark, str(tmp_path / "state"), "CLIENT_ALPHA")
    folder = tmp_path / "docs"
    folder.mkdir()

    def step(name, docs, as_of):
        if docs:
            write_documents(folder, name, docs)
        return ingest.ingest_batch(state, ALPHA, alpha(spark, folder, state), dims, name, as_of)

    return state, step


def size_of(folder: str) -> int:
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_a_batch_writes_what_it_changes(run_alpha):
    """One percent of the keys: a few percent of the bytes, and nothing written before is touched."""
    state, step = run_alpha
    step("run-1", [document(i, i) for i in range(1, 20_001)], T1)
    first = {t: size_of(state.batch_path(1, t)) for t in ("persisted", "fact")}
    before = {f: f.stat().st_mtime_ns for f in Path(state.batch_path(1, "")).rglob("*.parquet")}
    step("run-2", [document(30_000 + i, i * 100, RATING=1) for i in range(1, 201)], T2)
    second = {t: size_of(state.batch_path(2, t)) for t in ("persisted", "fact")}
    assert all(second[t] < 0.15 * first[t] for t in first), (first, second)
    assert before == {f: f.stat().st_mtime_ns for f in before}
    fact = ingest.fact_versions(state)
    assert fact.count() == 20_200 and fact.where("is_active").count() == 20_000


@pytest.mark.parametrize("winner", ["inner", "outer"])
def test_of_two_writers_one_is_refused(spark, dims, run_alpha, tmp_path, monkeypatch, winner):
    """Both work on batch 2 at once. One publishes before the other: either may come first."""
    state, step = run_alpha
    step("run-1", FIRST, T1)
    write_documents(tmp_path / "docs", "new", SECOND)
    other = VersionLog(spark, str(tmp_path / "state"), "CLIENT_ALPHA")
    batch, publish, inner = alpha(spark, tmp_path / "docs", state), VersionLog.publish, []

    def second_writer():
        try:
            inner.append(ingest.ingest_batch(other, ALPHA, batch, dims, "run-2b", T3))
        except ingest.StageFailed as refused:
            inner.append(refused.__cause__)

    def meets(self, run, seq, key):
        if self is state and winner == "inner":
            second_writer()
        publish(self, run, seq, key)
        if self is state and winner == "outer":
            monkeypatch.setattr(VersionLog, "publish", publish)

    if winner == "inner":
        monkeypatch.setattr(VersionLog, "publish", meets)
        with pytest.raises(ingest.StageFailed) as refused:
            ingest.ingest_batch(state, ALPHA, batch, dims, "run-2a", T2)
        assert isinstance(refused.value.__cause__, AlreadyPublished) and inner[0].seq == 2
    else:  # the other has done all its work when the first one publishes
        def outer(self, run, seq, key):
            if self is other:
                inner.append(ingest.ingest_batch(state, ALPHA, batch, dims, "run-2a", T2))
            publish(self, run, seq, key)

        monkeypatch.setattr(VersionLog, "publish", outer)
        with pytest.raises(ingest.StageFailed) as refused:
            ingest.ingest_batch(other, ALPHA, batch, dims, "run-2b", T3)
        assert isinstance(refused.value.__cause__, AlreadyPublished)
    assert state.latest().seq == 2
    began = T3 if winner == "inner" else T2
    fact = ingest.fact_versions(state)
    assert fact.count() == 6 and {r.start_date for r in fact.collect()} == {T1, began}
    # The refused one tries again: its rows are old news now.
    again = ingest.ingest_batch(state, ALPHA, alpha(spark, tmp_path / "docs", state), dims, "run-2a", T3)
    assert again.seq in (0, 2)


def test_a_file_is_made_once(spark, tmp_path):
    path, told = str(tmp_path / "log" / "000001.json"), []
    writers = [threading.Thread(target=lambda i=i: told.append((create_absent(spark, path, f"writer {i}"), i))) for i in range(8)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    (won,) = [i for made, i in told if made]
    assert read_text(spark, path) == f"writer {won}"
    assert not list((tmp_path / "log").glob("*.part"))


def log_of(seed):
    rng, out = random.Random(seed), []
    for run in range(1, 8):
        for _ in range(rng.randint(0, 12)):
            out.append((rng.choice(["a", "b", "c", None]), run, rng.randint(0, 99)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ends_follow_from_the_log(spark, seed):
    began = lambda run: datetime(2026, 1, 1) + timedelta(days=run)
    made = log_of(seed)
    log = spark.createDataFrame([(k, r, began(r), v) for k, r, v in made], "version_key string, dag_run_id bigint, start_date timestamp_ntz, v int")
    want = []
    for key, run, v in made:
        later = [r for k, r, _ in made if key is not None and k == key and r > run]
        want.append((key, run, v, began(min(later)) if later else OPEN, not later))
    got = versions_at_read(log).select("version_key", "dag_run_id", "v", "end_date", "is_active")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert active_of(log).count() == sum(w[-1] for w in want)
    keys = spark.createDataFrame([("a",), ("a",), (None,), ("zzz",)], "version_key string")
    newest = max((r for k, r, _ in made if k == "a"), default=None)
    assert [r.dag_run_id for r in current_of(log, keys).collect()] == ([newest] if newest else [])


def test_meeting_a_few_keys_does_not_shuffle_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(50_000).selectExpr(
        "cast(id as string) version_key", "1L dag_run_id", "id v", "repeat('x', 50) body"
    ).write.parquet(path)
    keys = spark.range(100).selectExpr("cast(id as string) version_key")
    met = current_of(spark.read.parquet(path).select("version_key", "dag_run_id", "v"), keys)
    assert met.count() == 100
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan and "body" not in plan


def drain(spark, state, folder, checkpoint, dims):
    return streaming.stream_ingest(
        streaming.document_stream(spark, str(folder)), rename_columns, state, ALPHA, dims, checkpoint, [T1, T2, T3].__getitem__
    ).awaitTermination()


def test_a_fresh_checkpoint_folder_loses_and_doubles_nothing(spark, dims, tmp_path):
    state = VersionLog(spark, str(tmp_path / "stream"), "CLIENT_ALPHA")
    write_documents(tmp_path / "docs", "one", FIRST)
    drain(spark, state, tmp_path / "docs", str(tmp_path / "c1"), dims)
    write_documents(tmp_path / "docs", "two", SECOND)
    drain(spark, state, tmp_path / "docs", str(tmp_path / "c2"), dims)  # both files are batch 0 now
    drain(spark, state, tmp_path / "docs", str(tmp_path / "c3"), dims)  # nothing is new
    assert rows(ingest.run_log(state), "dag_run_id", "run_key", "insert_count", "update_count", "duplicate_count") == [
        (1, "CLIENT_ALPHA-0", 3, 0, 0),
        (2, "CLIENT_ALPHA-1", 1, 2, 1),
    ]
    assert ingest.fact_versions(state).count() == 6


def test_objects_stream_and_go_on_after_a_crash(spark, dims, tmp_path, monkeypatch):
    state = VersionLog(spark, str(tmp_path / "state"), "CLIENT_GAMMA")

    def go():
        streaming.stream_ingest(
            streaming.object_stream(spark, str(tmp_path / "objects")), number_object_rows, state, GAMMA, dims,
            str(tmp_path / "checkpoint"), [T1, T2, T3].__getitem__,
        ).awaitTermination()

    write_object(tmp_path / "objects", 1, [ticket("1"), ticket("2", RATING="best")])
    write_object(tmp_path / "objects", 2, [ticket("1", RATING="WORST")])
    go()
    write_object(tmp_path / "objects", 10, [ticket("1", RATING="WORST"), ticket("3", RESOLVED_IN_FIRST_CONTACT=None)])
    whole = streaming.ingest_batch
    with monkeypatch.context() as patch:
        patch.setattr(streaming, "ingest_batch", lambda *args: (whole(*args), 1 / 0))
        with pytest.raises(Exception, match="division by zero"):
            go()
    go()
    assert rows(ingest.run_log(state), "dag_run_id", "insert_count", "update_count") == [(1, 2, 0), (2, 1, 1)]
    assert state.latest().source_checkpoint == 10
    assert rows(ingest.fact_versions(state).where("is_active"), "source_system_identifier", "customer_rating") == [
        ("CLIENT_GAMMA-1", 1), ("CLIENT_GAMMA-2", None), ("CLIENT_GAMMA-3", 5),
    ]


def test_changed_rows_are_read_where_the_batch_stored_them(spark, dims, tmp_path):
    """They are not written a second time, and a single bucket is not asked for by hash."""
    logged, bucketed = VersionLog(spark, str(tmp_path / "a"), "CLIENT_ALPHA"), FeedState(spark, str(tmp_path / "b"), "CLIENT_ALPHA")
    for state in (logged, bucketed):
        for name, docs, as_of in (("one", FIRST, T1), ("two", SECOND, T2)):
            write_documents(tmp_path / name, name, docs)
            batch = rename_columns(spark.read.schema(ALPHA.raw).json(str(tmp_path / name)))
            ingest.ingest_batch(state, ALPHA, batch, dims, name, as_of)
    ids = ("fact_id", "source_record_id")
    assert rows(ingest.fact_versions(logged).drop(*ids)) == rows(ingest.fact_versions(bucketed).drop(*ids))
    assert len(list((tmp_path / "b").glob("*/batches/*/cdc"))) == 2
    assert not list((tmp_path / "a").glob("*/batches/*/cdc"))
    counted = spark.range(3).agg(ingest._slots(F.col("id") > 1, 1).alias("s"), ingest._slots(F.col("id") > 5, 1).alias("t"))
    assert tuple(counted.first()) == ([0], []) and "ObjectHashAggregate" not in counted._jdf.queryExecution().executedPlan().toString()
