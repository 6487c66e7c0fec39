"""Invariants over random change batches."""

from __future__ import annotations

import tempfile
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.feeds import ALPHA
from tidemark.functions.values import rename_columns
from tidemark.operators.filters import filter_active
from tidemark.plans import ingest
from tidemark.plans.state import FeedState
from tidemark.schemas import ALPHA_DOCUMENT, REQUIRED_COLUMNS
from tests.helpers import document

_change = st.tuples(
    st.integers(1, 6),
    st.sampled_from([1, 2, 3]),
    st.sampled_from(["JDOE", "GHOST", None]),
)
_batches = st.lists(st.lists(_change, min_size=1, max_size=8), min_size=2, max_size=2)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(_batches)
def test_random_batches(spark, dims, batches):
    state = FeedState(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"), "CLIENT_ALPHA", buckets=2)
    serial, newest = 0, {}
    for number, changes in enumerate(batches):
        docs = []
        for interaction, rating, agent in changes:
            serial += 1
            docs.append(document(serial, interaction, RATING=rating, AGENT_PSEUDO_NAME=agent))
            newest[f"CLIENT_ALPHA-{interaction}"] = ((rating + 1) // 2, agent == "JDOE")
        raw = spark.createDataFrame(
            [tuple(d[n] for n in ALPHA_DOCUMENT.names) for d in docs], ALPHA_DOCUMENT
        )
        as_of = datetime(2026, 1, 1) + timedelta(days=number)
        result = ingest.ingest_batch(
            state, ALPHA, rename_columns(raw), dims, f"run-{number}", as_of
        )
        parts = result.insert_count + result.update_count + result.duplicate_count
        assert parts == result.batch_count == len({d["INTERACTION_ID"] for d in docs})
        again = ingest.ingest_batch(
            state, ALPHA, rename_columns(raw), dims, f"again-{number}", as_of
        )
        assert (again.insert_count, again.update_count) == (0, 0)

    fact = ingest.fact_versions(state)
    active = {
        r.source_system_identifier: (r.customer_rating, r.is_valid)
        for r in filter_active(fact).collect()
    }
    assert filter_active(fact).count() == len(active) and active == newest
    assert fact.where("end_date < start_date").count() == 0
    missing = F.greatest(*[F.col(c).isNull() for c in REQUIRED_COLUMNS])
    assert fact.where(missing == F.col("is_valid")).count() == 0
