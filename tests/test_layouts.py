"""Layouts that prune, lookups of versions in force, dense ids, topics of several partitions."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import OPEN, T1, T2, T3, message, rows
from tidemark.feeds import BETA_PARTITIONED
from tidemark.operators.history import history_from_changes
from tidemark.operators.keys import dense_key, surrogate_key
from tidemark.plans import ingest
from tidemark.plans.versions import VersionLog
from tidemark.sources import layouts, seeds, topic
from tidemark.streaming import ingest as streaming

START = datetime(2026, 1, 1)


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_filter_on_the_dimension_prunes_the_fact(spark, tmp_path):
    facts = spark.range(4000).selectExpr(
        "cast(nullif(id % 6, 5) as int) source_id", "id", "repeat('x', 20) body"
    )
    path = str(tmp_path / "fact")
    layouts.write_routed(facts, path)
    assert {p.name for p in (tmp_path / "fact").glob("partition_name=*")} == {
        f"partition_name={n}" for n in ("alpha", "beta", "gamma", "default")
    }
    routed = layouts.read_routed(spark, path, facts.schema)
    assert rows(routed.select(facts.columns).groupBy("source_id").count()) == rows(facts.groupBy("source_id").count())
    spark.range(1, 4).selectExpr(
        "cast(id as int) source_id", "element_at(array('CLIENT_ALPHA', 'CLIENT_BETA', 'CLIENT_GAMMA'), cast(id as int)) source_name"
    ).write.parquet(str(tmp_path / "sources"))
    named = spark.read.parquet(str(tmp_path / "sources")).where("source_name = 'CLIENT_BETA'")
    found = layouts.of_sources(routed, named)
    assert found.count() == facts.where("source_id = 2").count()
    text = plan(found)
    assert "dynamicpruning" in text
    read = [int(line.split(": ")[1]) for line in _metrics(found) if line.startswith("number of partitions read")]
    assert read == [1]


def _metrics(df) -> list[str]:
    """Metrics of the fact's scan after a run."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and "partition_name" in node.schemaString():
            metric = node.metrics().get("numPartitions")
            out.append(f"number of partitions read: {metric.get().value()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def versions(spark, seed=1, n=400):
    rng = random.Random(seed)
    made = [(rng.randint(1, 30), "UPDATE", START + timedelta(hours=rng.randint(0, 24 * 300)), i) for i in range(n)]
    return history_from_changes(spark.createDataFrame(made, "k bigint, op string, op_ts timestamp_ntz, seq bigint"), "k")


def test_a_past_moment_opens_what_ended_since(spark, tmp_path):
    whole, path = versions(spark), str(tmp_path / "v")
    layouts.write_by_end(whole, path)
    laid = layouts.read_by_end(spark, path, whole.schema)
    folders = {int(p.name.split("=")[1]) for p in (tmp_path / "v").glob("end_month=*")}
    for moment in (START + timedelta(days=40), START + timedelta(days=150), START + timedelta(days=299)):
        want = whole.where((F.col("start_date") <= F.lit(moment)) & (F.col("end_date") > F.lit(moment)))
        got = layouts.versions_at(laid, moment)
        assert rows(got) == rows(want) and got.count() == got.select("k").distinct().count()
        month = 100 * moment.year + moment.month
        scanned = [f for f in got.inputFiles()]
        opened = {int(f.split("end_month=")[1].split("/")[0]) for f in scanned}
        text = plan(got)
        assert f"(end_month#" in text and f">= {month})" in text and "PushedFilters: [IsNotNull(start_date)" in text
        assert any(f < month for f in folders) or moment < START + timedelta(days=60)
        assert opened >= {f for f in folders if f >= month}


def test_each_row_meets_the_version_in_force(spark):
    whole, rng = versions(spark, 2), random.Random(3)
    asked = [(i, rng.randint(1, 33), START + timedelta(hours=rng.randint(-20, 24 * 310))) for i in range(300)]
    frame = spark.createDataFrame(asked, "id bigint, k bigint, at timestamp_ntz")
    got = {r.id: r.seq for r in layouts.interval_lookup(frame, whole, "k", "at", ["seq"]).collect()}
    held = whole.collect()
    for i, k, at in asked:
        want = [v.seq for v in held if v.k == k and v.start_date <= at < v.end_date]
        assert [got[i]] == (want or [None])


def test_dense_ids_have_no_gaps_and_stay(spark, tmp_path):
    last, seen = 0, []
    for batch, n in enumerate((1000, 0, 37)):
        path = str(tmp_path / f"b{batch}")
        surrogate_key(spark.range(n).repartition(5), "record", last).write.parquet(path)
        ids = [r.record for r in dense_key(spark.read.parquet(path), "record", last).collect()]
        again = dense_key(spark.read.parquet(path).repartition(3), "record", last)
        assert sorted(ids) == list(range(last + 1, last + n + 1)) == sorted(r.record for r in again.collect())
        by_row = {r.id: r.record for r in again.collect()}
        assert by_row == {r.id: r.record for r in dense_key(spark.read.parquet(path), "record", last).collect()}
        seen, last = seen + ids, last + n
    assert len(seen) == len(set(seen)) == 1037


def test_each_partition_has_its_own_checkpoint(spark, tmp_path):
    messages = [(p, o, f"{p}-{o}") for p in (0, 1, 2) for o in range(4 * (p + 1))]
    path = str(tmp_path / "topic")
    frame = spark.createDataFrame(messages, "partition int, offset bigint, value string")
    frame.write.parquet(path)
    since = topic.scan_partitions_since(spark, path, {0: 3, 2: 9})
    assert sorted(r.value for r in since.collect()) == sorted(["2-10", "2-11"] + [f"1-{o}" for o in range(8)])
    assert "PushedFilters: [Or(" in plan(since)
    assert rows(topic.partition_lag(frame, {0: 3, 2: 9})) == [(0, 3, 4, 0), (1, -1, 8, 8), (2, 9, 12, 2)]
    assert rows(topic.has_partition_lag(frame, {0: 3, 2: 9}, 9)) == [(True,)]
    assert rows(topic.has_partition_lag(frame, {0: 3, 2: 9}, 10)) == [(False,)]
    assert rows(topic.has_partition_lag(frame.limit(0), {})) == [(False,)]
    assert json.loads(topic.starting_offsets("t", {0: 3}, [0, 1])) == {"t": {"0": 4, "1": -2}}
    assert topic.scan_partitions_since(spark, path, {}).count() == len(messages)


def test_a_stream_of_partitions_goes_on_where_each_stopped(spark, tmp_path):
    state, folder = VersionLog(spark, str(tmp_path / "state"), "CLIENT_BETA"), str(tmp_path / "topic")
    dims = seeds.dimensions(spark)

    def deliver(*found):
        made = [(p, o, message(key, **more)) for p, o, key, more in found]
        spark.createDataFrame(made, "partition int, offset bigint, value string").write.mode("append").parquet(folder)

    def drain(checkpoint):
        streaming.stream_ingest(
            streaming.partitioned_message_stream(spark, folder), topic.parse_xml_records, state, BETA_PARTITIONED, dims,
            str(tmp_path / checkpoint), [T1, T2, T3].__getitem__,
        ).awaitTermination()

    deliver((0, 0, 1, {}), (0, 1, 2, {}), (1, 7, 3, {}))
    drain("one")
    # Lower than the highest offset of all, and new in their partitions.
    deliver((0, 2, 1, {"TIME_STAMP": "2024/02/01 00:00:00"}), (2, 0, 4, {}))
    drain("two")
    assert state.latest().positions == {0: 2, 1: 7, 2: 0}
    assert rows(ingest.run_log(state), "dag_run_id", "insert_count", "update_count", "duplicate_count") == [
        (1, 3, 0, 0), (2, 1, 1, 0),
    ]
    assert rows(ingest.fact_versions(state), "source_system_identifier", "end_date") == [
        ("CLIENT_BETA-1", T2), ("CLIENT_BETA-1", OPEN), ("CLIENT_BETA-2", OPEN), ("CLIENT_BETA-3", OPEN), ("CLIENT_BETA-4", OPEN),
    ]
