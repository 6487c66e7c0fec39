"""What the plans must look like to hold up at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tidemark.checks import carriers as c
from tidemark.checks import merges, reports, scalars
from tidemark.checks.registry import QUERIES
from tidemark.feeds import ALPHA
from tidemark.operators import audit, conform, dedup, filters, merge, quality
from tidemark.plans.ingest import land
from tidemark.sources import seeds

DATA = "/root/testdata/sf0.001"
WRITING = ("scan_", "sink_", "ingest_", "replayed_", "stream_", "exactly_once", "cross_batch")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if not n.startswith(WRITING))
)
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(entry_point.queries()[name](spark, DATA))
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert banned not in text, banned


@pytest.mark.parametrize("name", ["dedup_latest_by_serial", "dedup_latest_by_created", "dedup_first_seen"])
def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, name):
    text = plan(entry_point.queries()[name](spark, DATA))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_landing_needs_one_shuffle(spark):
    text = plan(land(c.carrier(spark, DATA, c.alpha), ALPHA))
    assert text.count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(spark):
    lines = c.table(spark, DATA, "lineitem")
    text = plan(audit.table_count(lines, "l_returnflag = 'R'"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "ReadSchema: struct<l_returnflag:string>" in text
    events = c.table(spark, DATA, "events").select("event_id", "user_id")
    text = plan(filters.filter_beyond_checkpoint(events, "event_id", 500))
    assert "GreaterThan(event_id,500)" in text and "event_id:bigint,user_id:bigint>" in text


def test_small_dimensions_are_broadcast_by_their_size(spark, dims):
    cdc = merge.cdc_extract(scalars.typed_store(c.carrier(spark, DATA, c.alpha), ALPHA), 1)
    text = plan(conform.conform_alpha(cdc, dims))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 3


def test_a_small_landing_does_not_shuffle_the_store(spark, tmp_path):
    ids = F.col("id")
    active = spark.range(400_000).select(
        ids.alias("k"), ids.alias("prs_record_id"), F.sha2(ids.cast("string"), 256).alias("hash_key"), F.lit(True).alias("is_active")
    )
    active.write.parquet(str(tmp_path / "store"))
    spark.range(399_950, 400_050).select(ids.alias("k"), F.lit("h").alias("hash_key")).write.parquet(str(tmp_path / "landing"))
    store, landed = (spark.read.parquet(str(tmp_path / name)) for name in ("store", "landing"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        found = merge.merge_classify(landed, store, "k")
        assert found.groupBy("merge_type").count().collect()
        text = plan(found)
        counts = {r.merge_type: r["count"] for r in found.groupBy("merge_type").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin [k#" in text and "LeftSemi, BuildRight" in text
    assert counts == {"UPDATE": 50, "INSERT": 50}


def test_growing_lookups_are_not_forced_into_memory(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    try:
        for name in ("lookup_join", "star_join", "merge_classify", "join_stage_to_fact"):
            assert "SortMergeJoin" in plan(entry_point.queries()[name](spark, DATA)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_classification_reads_only_id_and_hash_of_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    merges.store(spark, DATA).write.parquet(path)
    stored = spark.read.parquet(path)
    text = plan(merge.merge_classify(merges.landing(spark, DATA), stored, merges.KEY))
    assert "struct<prs_record_id:bigint,interaction_id:bigint,hash_key:string,is_active:boolean>" in text


def test_top_k_does_not_sort_everything(spark):
    text = plan(reports.ten_latest_runs(spark, DATA))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_foreign_keys_are_counted_before_the_join(spark):
    lines, part = (c.table(spark, DATA, t) for t in ("lineitem", "part"))
    text = plan(quality.check_foreign_key(lines, "l_partkey", part, "p_partkey"))
    assert "LeftAnti" not in text and text.index("LeftOuter") < text.index("HashAggregate")


def test_history_windows_run_inside_chunks(spark):
    text = plan(entry_point.queries()["history_from_changes"](spark, DATA))
    windows = [line for line in text.splitlines() if "Window [lead(" in line]
    assert any("_chunk" in line.split("windowspecdefinition(")[1].split(",")[1] for line in windows)


def test_seeds_are_local_relations(spark):
    text = seeds.sources(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in text
