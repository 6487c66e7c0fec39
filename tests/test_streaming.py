from __future__ import annotations

import pytest

from tidemark.feeds import ALPHA
from tidemark.functions.values import rename_columns
from tidemark.plans import ingest
from tidemark.plans.state import FeedState
from tidemark.streaming import ingest as streaming
from tests.helpers import T1, T2, T3, document, rows, write_documents
from tests.test_pipeline import FIRST, SECOND


def _drain(spark, dims, state, folder, prepare=rename_columns):
    return streaming.stream_ingest(
        streaming.document_stream(spark, str(folder)),
        prepare,
        state,
        ALPHA,
        dims,
        f"{state.folder}-checkpoint",
        [T1, T2, T3].__getitem__,
    )


def test_stream_equals_batches(spark, dims, tmp_path):
    state = FeedState(spark, str(tmp_path / "stream"), "CLIENT_ALPHA", buckets=4)
    batch_state = FeedState(spark, str(tmp_path / "batch"), "CLIENT_ALPHA", buckets=4)
    for name, docs, as_of in (("one", FIRST, T1), ("two", SECOND, T2)):
        write_documents(tmp_path / "docs", name, docs)
        _drain(spark, dims, state, tmp_path / "docs").awaitTermination()
        write_documents(tmp_path / name, name, docs)
        batch = rename_columns(spark.read.schema(ALPHA.raw).json(str(tmp_path / name)))
        ingest.ingest_batch(batch_state, ALPHA, batch, dims, name, as_of)
    _drain(spark, dims, state, tmp_path / "docs").awaitTermination()  # nothing new
    ids = ("fact_id", "source_record_id")
    streamed = ingest.fact_versions(state).drop(*ids)
    assert rows(streamed) == rows(ingest.fact_versions(batch_state).drop(*ids))
    assert rows(ingest.run_log(state), "dag_run_id", "run_key") == [
        (1, "CLIENT_ALPHA-0"),
        (2, "CLIENT_ALPHA-1"),
    ]


def test_batch_published_before_a_crash_is_not_applied_twice(spark, dims, tmp_path, monkeypatch):
    """The stream dies after publishing but before Spark records the batch as done."""
    state = FeedState(spark, str(tmp_path / "stream"), "CLIENT_ALPHA", buckets=4)
    write_documents(tmp_path / "docs", "one", [document(1, 1), document(2, 2)])
    whole = streaming.ingest_batch

    def dies_late(*args):
        whole(*args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(streaming, "ingest_batch", dies_late)
        with pytest.raises(Exception, match="driver lost"):
            _drain(spark, dims, state, tmp_path / "docs").awaitTermination()
    before = rows(ingest.fact_versions(state))
    assert len(before) == 2
    _drain(spark, dims, state, tmp_path / "docs").awaitTermination()
    assert rows(ingest.fact_versions(state)) == before and state.latest().seq == 1
