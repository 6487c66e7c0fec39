"""What object rows and dense ids must not cost as their tables grow."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tidemark.checks import carriers as c
from tidemark.checks import scalars
from tidemark.feeds import ALPHA, BETA, GAMMA
from tidemark.operators import keys
from tidemark.plans import ingest
from tidemark.plans.versions import VersionLog
from tidemark.schemas import GAMMA_OBJECT
from tidemark.sources import objects
from tidemark.streaming import ingest as streaming
from tests.helpers import T1, T2, rows, ticket, write_object
from tests.test_plans import DATA, plan


def test_ids_are_counted_exactly_and_not_moved_one_by_one(spark):
    ids = [(0, i) for i in [*range(1, 200), 7, 64, 1000]] + [(1, -1), (1, -64), (1, -65), (1, -1)]
    got = keys.id_figures(spark.createDataFrame(ids, "batch int, id bigint"), "batch", "id")
    assert rows(got) == [(0, 202, 1, 1000, 200), (1, 4, -65, -1, 3)]
    text = plan(entry_point.queries()["dense_surrogate_key"](spark, DATA))
    assert "count(distinct" not in text and "_bits" in text


@pytest.mark.parametrize("name", ["dedup_first_seen", "conform_gamma", "fact_all_sources"])
def test_object_texts_are_derived_after_the_shuffle(spark, name):
    text = plan(entry_point.queries()[name](spark, DATA))
    assert text.rindex("WORST") < text.rindex("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["dedup_first_seen", "conform_gamma", "fact_all_sources"])
def test_a_tickets_rows_are_sorted_by_number_and_order_alone(spark, name):
    text = plan(entry_point.queries()[name](spark, DATA))
    sorts = [line for line in text.splitlines() if "Sort [" in line and "l_shipdate" in line]
    assert sorts and all("l_linenumber" in line for line in sorts)
    assert not any("file_seq" in line or "ticket_identifier" in line for line in sorts)


@pytest.mark.parametrize("name", ["conform_alpha", "conform_beta"])
def test_document_and_message_texts_are_derived_after_the_shuffle(spark, name):
    found = plan(entry_point.queries()[name](spark, DATA))
    # Of the two derivations the lower one makes the hash of rows of equal rank.
    assert found.rindex("SELF-HELP") < found.index("Exchange hashpartitioning(number")
    whole = plan(entry_point.queries()["fact_all_sources"](spark, DATA))
    assert whole.count("Exchange hashpartitioning(number") == 2


def test_rows_of_one_rank_are_told_apart_by_their_hash(spark):
    at = datetime(2024, 1, 2, 3, 4, 5)
    events = [(7, at, 1, "click", 1.0, '{"k": 5}'), (7, at, 1, "view", 2.0, '{"k": 5}'), (6, at, 1, "error", 9.0, '{"k": 5}')]
    events += [(8, at, None, "view", 3.0, '{"k": 5}'), (9, None, 2, "view", None, '{"k": 6}')]
    orders = [(5, 1, "O", float(p), at.replace(microsecond=p), "1-URGENT") for p in (10, 20, 30)]
    orders += [(4, 2, "F", 1.0, None, "1-URGENT"), (3, 2, "F", 2.0, at, "1-URGENT"), (6, None, "P", 3.0, at, "2-HIGH")]
    for sql, spec, table, schema in (
        (c.alpha, ALPHA, events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        (c.beta, BETA, orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
         " o_orderdate timestamp_ntz, o_orderpriority string"),
    ):
        given = spark.createDataFrame(table, schema)
        want = scalars.typed_store(c.derive(given, sql), spec)
        got = scalars.latest_store(given, sql, spec)
        assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 3


def test_written_objects_derive_their_texts_after_the_shuffle(spark):
    text = plan(c.object_rows(c.gamma_lines(spark, DATA)))
    assert text.rindex("WORST") < text.index("Exchange rangepartitioning")


def test_an_objects_path_is_searched_at_its_end_and_for_one_condition(spark, tmp_path):
    write_object(tmp_path, 3, [ticket("1")])
    text = plan(objects.scan_csv_objects_since(spark, str(tmp_path), 1))
    # Once to filter, once to show, and once more where the scan lists its filters.
    assert text.count("regexp_extract") == text.count("substring_index") <= 3


def test_an_objects_number_is_found_once_a_file(spark, tmp_path):
    for number in (1, 2, 30):
        write_object(tmp_path, number, [ticket(str(10 * number + i)) for i in range(3)])
    (tmp_path / "notes.csv.gz").write_bytes(b"")
    got = objects.scan_csv_objects_since(spark, str(tmp_path), 1)
    text = plan(got)
    assert "regexp_extract" not in text and "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert rows(got, "file_seq", "ticket_identifier") == [(n, str(10 * n + i)) for n in (2, 30) for i in range(3)]
    assert rows(objects.scan_csv_objects_since(spark, str(tmp_path), 30)) == []


def test_a_streamed_objects_number_is_found_once_a_file(spark, dims, tmp_path):
    folder, state = str(tmp_path / "objects"), VersionLog(spark, str(tmp_path / "state"), "CLIENT_GAMMA")
    prepare = objects.number_by_listing(folder, lambda: ingest.scan_since(state, 0))
    plans = []

    def seen(batch):
        named = spark.read.schema(GAMMA_OBJECT).options(**objects.CSV_OPTIONS).csv(folder)
        plans.append(plan(prepare(named.select("*", F.col("_metadata.file_path").alias("file_name")))))
        return prepare(batch)

    for numbers in ((1, 2), (30,)):
        for number in numbers:
            write_object(tmp_path / "objects", number, [ticket(str(number % 2)), ticket(str(10 * number))])
        (tmp_path / "objects" / "notes.csv.gz").write_bytes(b"")
        stream = streaming.named_object_stream(spark, folder)
        streaming.stream_ingest(
            stream, seen, state, GAMMA, dims, str(tmp_path / "checkpoint"), [T1, T2].__getitem__
        ).awaitTermination()
    assert len(plans) == 2
    assert not any("regexp_extract" in text or "Exchange hashpartitioning" in text for text in plans)
    assert all("BroadcastHashJoin" in text for text in plans)
    assert state.latest().source_checkpoint == 30
    assert rows(ingest.run_log(state), "dag_run_id", "insert_count", "duplicate_count") == [(1, 4, 0), (2, 1, 1)]


def test_an_objects_number_stands_in_the_last_two_parts(spark):
    name = "%20%20%20%20%20%20%20%20%2042_client_gamma_support_data_20240101_000000.csv.gz"
    paths = {
        f"file:/a/b/{name}": 42,
        f"file:/a/object={name}/part-0.csv.gz": 42,
        name: 42,
        f"file:/a/{name}/b/part-0.csv.gz": None,
        f"file:/a/x{name}": None,
        "file:/a/notes.csv.gz": None,
    }
    got = spark.createDataFrame([(p,) for p in paths], "p string")
    found = got.select("p", objects.object_sequence(F.col("p"))).collect()
    assert {r[0]: r[1] for r in found} == paths


def test_messages_lie_in_files_of_bounded_length(spark, tmp_path):
    path = str(tmp_path / "topic")
    messages = spark.range(250).selectExpr("id AS offset", "'<RECORD></RECORD>' AS value").coalesce(1)
    for _ in range(2):
        c.write_messages(messages, path, most=100)
    assert len(list((tmp_path / "topic").glob("*.parquet"))) == 6
    assert spark.read.parquet(path).count() == 500
