"""Rows named by their ids as bits, and the batches and reads that lean on them."""

from __future__ import annotations

import random
import shutil
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.feeds import GAMMA
from tidemark.operators import marks
from tidemark.operators.versions import versions_at_read
from tidemark.plans import ingest, versions
from tidemark.plans.versions import VersionLog
from tidemark.sources import scan_csv_objects_since
from tidemark.sources.objects import number_by_listing
from tidemark.streaming import ingest as streaming
from tests.helpers import T1, T2, T3, rows, ticket, write_object
from tests.test_plans import plan

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def threshold(spark):
    """Sets what Spark takes for small enough to broadcast."""
    before = spark.conf.get(THRESHOLD)
    yield lambda size: spark.conf.set(THRESHOLD, size)
    spark.conf.set(THRESHOLD, before)


@pytest.mark.parametrize("size, several", [("10m", False), ("40k", True), ("9k", False), ("-1", False)])
def test_marked_rows_are_those_named(spark, tmp_path, threshold, size, several):
    draw = random.Random(7)
    ids = [*range(100), (5 << 33) + 3, (5 << 33) + 63, (1 << 62) + 1] + [draw.randrange(900_000) for _ in range(3000)]
    named = set(ids)
    threshold(size)
    path = str(tmp_path / "marks")
    marks.write_marks(spark.createDataFrame([(i,) for i in ids] + [(ids[0],), (None,)], "n bigint"), "n", path)
    found = marks.read_marks(spark, path)
    assert marks.count_marks(spark, path) == len(named) and (len(found) > 1) == several
    asked = [*ids[:200], *range(90, 110), (5 << 33) + 4, None, *[draw.randrange(900_000) for _ in range(2000)]]
    table = spark.createDataFrame([(i, "x") for i in asked], "n bigint, body string")
    got = marks.marked(table, "n", found, "hit")
    assert got.columns == ["n", "body", "hit"]
    assert rows(got) == sorted(((i, "x", i in named) for i in asked), key=repr)


def test_no_mark_names_nothing(spark, tmp_path):
    path = str(tmp_path / "marks")
    marks.write_marks(spark.range(0), "id", path)
    assert marks.count_marks(spark, path) == 0
    for found in (marks.read_marks(spark, path), []):
        assert rows(marks.marked(spark.range(3), "id", found, "hit")) == [(i, False) for i in range(3)]


ODD = [None, "", "x", "x", "y", " 7", "07", "7", "7.5"]


def objects(folder: Path, first: int, seed: int, changes: dict) -> None:
    """Three objects of tickets that come again, within an object and in others; some unreadable."""
    draw = random.Random(seed)
    for number in range(first, first + 3):
        drawn = [str(draw.randrange(40)) for _ in range(60)] + [draw.choice(ODD) for _ in range(12)]
        draw.shuffle(drawn)
        write_object(folder, number, [ticket(k, DURATION=str(draw.randrange(3)), **changes) for k in drawn])


def run_gamma(spark, dims, tmp_path):
    state = VersionLog(spark, str(tmp_path / "state"), GAMMA.source)

    def step(name, as_of, batch=None):
        if batch is None:
            batch = scan_csv_objects_since(spark, str(tmp_path / "objects"), ingest.scan_since(state, 0))
        return ingest.ingest_batch(state, GAMMA, batch, dims, name, as_of)

    return state, step


def landed(spark, state, seq):
    stored = spark.read.parquet(state.batch_path(seq, "landing"))
    assert stored.select(ingest.LANDING_ID).distinct().count() == stored.count()
    return rows(stored.drop(ingest.LANDING_ID))


def test_objects_land_as_ranked_rows_do(spark, dims, tmp_path, threshold):
    state, step = run_gamma(spark, dims, tmp_path)
    threshold("9k")  # marks are joined like any table
    objects(tmp_path / "objects", 1, 3, {})
    batch = scan_csv_objects_since(spark, str(tmp_path / "objects"), 0)
    step("one", T1)
    want = ingest.land(batch, GAMMA)
    assert landed(spark, state, 1) == rows(want)
    assert want.where("ticket_identifier is null").count() == 4  # none or empty, x, y and 7.5
    assert not any(Path(state.batch_path(1, name)).exists() for name in ("scanned", "firsts"))


@pytest.mark.parametrize("row_id", ["CAST(1 AS bigint)", "IF(row_id % 2 = 0, NULL, row_id)", "-row_id"])
def test_rows_of_one_or_no_place_are_ranked_one_by_one(spark, dims, tmp_path, row_id):
    state, step = run_gamma(spark, dims, tmp_path)
    objects(tmp_path / "objects", 1, 5, {})
    batch = scan_csv_objects_since(spark, str(tmp_path / "objects"), 0).withColumn("row_id", F.expr(row_id))
    step("one", T1, batch)
    got, want = landed(spark, state, 1), rows(ingest.land(batch, GAMMA))
    key = ("file_seq", "ticket_identifier")
    if "CAST" in row_id:  # which copy within a file is kept is open
        got = rows(spark.read.parquet(state.batch_path(1, "landing")), *key)
        want = rows(ingest.land(batch, GAMMA), *key)
    assert got == want


def test_places_follow_the_rank_without_gaps(spark):
    low = 1 << 33
    given = [(2, "b", low), (2, "b", low + 1), (2, "a", 3), (2, "a", 5), (1, "z", low + 2), (None, "a", 0), (2, "a", low + 3)]
    scanned = spark.createDataFrame(given, "file_seq bigint, file_name string, row_id bigint")
    want = [(None, "a", 0), (1, "z", low + 2), (2, "a", 3), (2, "a", 5), (2, "a", low + 3), (2, "b", low), (2, "b", low + 1)]
    got = ingest.with_place(scanned, GAMMA)
    assert [tuple(r) for r in got.orderBy("_place").select("file_seq", "file_name", "row_id").collect()] == want
    assert [r[0] for r in got.orderBy("_place").select("_place").collect()] == [0, 1, 2, 4, 5, 6, 7]
    assert ingest.with_place(scanned.withColumn("row_id", F.expr("nullif(row_id, 3)")), GAMMA) is None


def test_objects_are_landed_and_classified_where_they_lie(spark, dims, tmp_path, monkeypatch, threshold):
    """neither the rows that land nor those that meet no stored version are moved."""
    state, step = run_gamma(spark, dims, tmp_path)
    plans, write = {}, ingest.sink_overwrite

    def seen(df, path):
        plans[path.rsplit("/", 1)[1], state.latest().seq + 1] = plan(df)
        write(df, path)

    monkeypatch.setattr(ingest, "sink_overwrite", seen)
    objects(tmp_path / "objects", 1, 3, {})
    step("one", T1)
    objects(tmp_path / "objects", 4, 4, {"RATING": "BAD"})
    threshold("20k")
    step("two", T2)
    for number in (1, 2):
        assert "Exchange hashpartitioning" not in plans["landing", number] and "Window" not in plans["landing", number]
    assert "call_status" not in plans["met", 2]
    rest = plans["classified", 2].rsplit("\n      +- ", 1)[1]  # the last branch of the union
    assert "NOT" in rest and "_bits0" in rest and "Exchange hashpartitioning" not in rest
    found = pq.ParquetFile(next(Path(state.batch_path(2, "persisted")).glob("*.parquet"))).metadata
    assert found.row_group(0).column(0).compression == "ZSTD"


def test_streamed_objects_land_where_they_lie_and_as_batches_do(spark, dims, tmp_path, monkeypatch):
    """F2: a micro-batch's rows are not moved to land, and leave what a batch of them leaves."""
    batched, step = run_gamma(spark, dims, tmp_path)
    streamed = VersionLog(spark, str(tmp_path / "streamed"), GAMMA.source)
    folder, plans, write = str(tmp_path / "objects"), [], ingest.sink_overwrite

    def seen(df, path):
        if path.startswith(str(tmp_path / "streamed")) and path.endswith("landing"):
            plans.append(plan(df))
        write(df, path)

    monkeypatch.setattr(ingest, "sink_overwrite", seen)
    prepare = number_by_listing(folder, lambda: ingest.scan_since(streamed, 0))
    for number, as_of in enumerate((T1, T2)):
        objects(tmp_path / "objects", 1 + 3 * number, number, {"RATING": ["BAD", "BEST"][number]})
        step(str(number), as_of)
        streaming.stream_ingest(
            streaming.named_object_stream(spark, folder), prepare, streamed, GAMMA, dims,
            str(tmp_path / "checkpoint"), [T1, T2].__getitem__,
        ).awaitTermination()
        assert landed(spark, streamed, number + 1) == landed(spark, batched, number + 1)
    assert len(plans) == 2 and not any("Exchange hashpartitioning" in p or "Window" in p for p in plans)
    got, want = (ingest.fact_versions(s).drop("fact_id", "source_record_id") for s in (streamed, batched))
    assert rows(got) == rows(want) and want.where("NOT is_active").count() > 30


def test_ends_are_read_as_they_follow_from_the_log(spark, dims, tmp_path, monkeypatch):
    state, step = run_gamma(spark, dims, tmp_path)
    for number, (name, as_of) in enumerate((("one", T1), ("two", T2), ("three", T3))):
        objects(tmp_path / "objects", 1 + 3 * number, number, {"RATING": ["BAD", "BEST", "BAD"][number]})
        step(name, as_of)
    commit = state.latest()
    landing = spark.read.parquet(state.landings(commit)[-1])
    stored = ingest.persisted_schema(ingest.type_landing(landing, GAMMA))

    def read():
        for table, schema in ((ingest.FACT, ingest.FACT_SCHEMA), (ingest.PERSISTED, stored)):
            want = versions_at_read(state.log(commit, table, schema)).select(schema.names)
            got = state.table(commit, table, schema)
            assert got.columns == want.columns and got.dtypes == want.dtypes and rows(got) == rows(want)
            assert want.where("NOT is_active").count() > 30
        assert ingest.fact_versions(state).where("source_system_identifier = 'CLIENT_GAMMA' AND NOT is_active").count() > 0

    read()
    text = plan(state.table(commit, ingest.FACT, ingest.FACT_SCHEMA).where("source_system_identifier = 'CLIENT_GAMMA-1'"))
    assert "_bits0" in text
    monkeypatch.setattr(versions, "MOST_PARTS", 0)
    read()
    shutil.rmtree(state.batch_path(2, "closed"))  # as older code has left its batches
    read()
