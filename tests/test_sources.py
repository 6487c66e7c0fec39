from pathlib import Path

from pyspark.sql import functions as F

from tidemark.functions.values import rename_columns
from tidemark.operators.dedup import dedup_first_seen
from tidemark.schemas import ALPHA_DOCUMENT
from tidemark.sources import documents, objects, seeds, sinks, topic
from tests.helpers import document, message, rows, ticket, write_documents, write_object


def test_documents_since(spark, tmp_path):
    write_documents(tmp_path, "a", [document(1, 7), document(2, 8, RATING=None)])
    got = documents.scan_documents_since(spark, str(tmp_path), 1)
    assert got.schema == ALPHA_DOCUMENT
    assert rows(rename_columns(got), "serial_number", "interaction_id", "rating") == [(2, 8, None)]
    every = documents.scan_documents_since(spark, str(tmp_path), -1)
    assert rows(documents.has_new_documents(every, 1)) == [(True,)]
    assert rows(documents.has_new_documents(every, 2)) == [(False,)]


def test_documents_before_the_checkpoint_are_not_opened(spark, tmp_path):
    raw = spark.createDataFrame([tuple(document(i, i).get(n) for n in ALPHA_DOCUMENT.names) for i in range(100)], ALPHA_DOCUMENT)
    documents.land_documents(raw, str(tmp_path / "d"), 10)
    (tmp_path / "d" / "serial_until=9" / "broken.json").write_text("{\"serial_number\": 77}")
    write_documents(tmp_path / "d" / "loose", "b", [document(500, 1)])
    got = documents.scan_documents_since(spark, str(tmp_path / "d"), 74)
    # A file in a folder of lower numbers is not looked into; one without a range is.
    assert sorted(r.serial_number for r in got.collect()) == [*range(75, 100), 500]
    every = documents.scan_documents_since(spark, str(tmp_path / "d"), -1)
    assert every.count() == 102 and every.schema == ALPHA_DOCUMENT


def test_messages_from_offset_zero_and_blank_fields(spark, tmp_path):
    path = str(tmp_path / "topic")
    values = [
        message(1),
        message(2, AGENT_CODE=None, CUSTOMER_TYPE="   "),
        "<RECORD><SUPPORT_IDENTIFIER>3</SUPPORT_IDENTIFIER></RECORD>",
        "this is not xml",
    ]
    spark.createDataFrame(list(enumerate(values)), "offset bigint, value string").write.parquet(path)
    parsed = topic.parse_xml_records(topic.scan_topic_since(spark, path, -1))
    shown = ["topic_offset", "support_identifier", "agent_code", "customer_type", topic.CORRUPT]
    assert rows(parsed, *shown) == [
        (0, "1", "IGONZALEZ", "COMMUTER", None),
        (1, "2", None, None, None),
        (2, "3", None, None, None),
        (3, None, None, None, "this is not xml"),
    ]
    assert topic.scan_topic_since(spark, path, 1).count() == 2


def test_topic_lag_needs_more_than_the_minimum(spark):
    messages = spark.range(20).select(F.col("id").alias("offset"))
    assert rows(topic.has_topic_lag(messages, 9)) == [(True,)]
    assert rows(topic.has_topic_lag(messages, 10)) == [(False,)]
    assert rows(topic.has_topic_lag(messages.limit(0), 0)) == [(False,)]


def test_objects_keep_every_row_and_first_copy(spark, tmp_path):
    write_object(tmp_path, 1, [ticket("1", RATING="a"), ticket("2", RATING="b")])
    write_object(tmp_path, 2, [ticket("1", RATING="z"), ticket("3", RATING=None)])
    (tmp_path / "notes.csv.gz").write_bytes(b"")
    got = objects.scan_csv_objects_since(spark, str(tmp_path), 0)
    assert got.count() == 4
    kept = rows(dedup_first_seen(got), "ticket_identifier", "rating")
    assert kept == [("1", "a"), ("2", "b"), ("3", None)]
    later = objects.scan_csv_objects_since(spark, str(tmp_path), 1)
    assert rows(later, "ticket_identifier", "file_seq") == [("1", 2), ("3", 2)]


def test_older_objects_are_not_opened(spark, tmp_path):
    """The sequence filter works on names: an unreadable old object does no harm."""
    old = write_object(tmp_path, 1, [ticket("1")])
    old.write_bytes(b"this is not gzip")
    write_object(tmp_path, 12, [ticket("2")])
    got = objects.scan_csv_objects_since(spark, str(tmp_path), 1)
    assert rows(got, "ticket_identifier") == [("2",)]


def test_object_listing_goes_by_sequence_not_count(spark, tmp_path):
    for sequence in (3, 20):
        write_object(tmp_path, sequence, [ticket("1")])
    Path(tmp_path / "0000000099_other_data_20240101_120000.csv.gz").write_bytes(b"x")
    listed = objects.list_objects(spark, str(tmp_path))
    assert [r.file_seq for r in objects.order_files_by_sequence(listed).collect()] == [3, 20]
    assert rows(objects.has_new_objects(listed, 19)) == [(True,)]
    assert rows(objects.has_new_objects(listed, 20)) == [(False,)]


def test_append_is_safe_to_repeat(spark, tmp_path):
    path = str(tmp_path / "t")
    for run, rows_of_run in ((1, ["a", "b"]), (2, ["c"]), (2, ["c"])):
        df = spark.createDataFrame([(v, run) for v in rows_of_run], "v string, dag_run_id bigint")
        sinks.sink_append(df, path)
    assert rows(spark.read.parquet(path), "v") == [("a",), ("b",), ("c",)]


def test_partition_routing(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (0,), (4,), (None,)], "source_id int")
    got = {r[0]: r[1] for r in df.select("source_id", sinks.route_partition()).collect()}
    assert got == {1: "alpha", 2: "beta", 3: "gamma", 0: "default", 4: "default", None: "default"}


def test_seeds(spark, dims):
    assert [dims[n].count() for n in ("sources", "agents", "support_areas", "customer_types")] == [3, 30, 30, 30]
    areas = {r.support_area_id: (r.support_area_name, r.source_id) for r in dims["support_areas"].collect()}
    assert areas[1] == ("ORDER ISSUES", 1) and areas[30] == ("LOYALTY & RETENTIONS", 3)
    fields = seeds.field_dictionary(spark)
    assert rows(fields.groupBy("source_id").count()) == [(1, 14), (2, 14), (3, 13)]
    unknown = spark.createDataFrame([("x", "NOBODY")], "name string, source_name string")
    assert rows(seeds.seed_dimension(unknown, dims["sources"])) == [("x", None)]


def test_raw_documents_lie_in_compressed_files_of_bounded_length(spark, tmp_path):
    docs = spark.range(250).selectExpr("CAST(NULL AS bigint) AS serial_number", "repeat('x', 1000) AS body")
    documents.land_documents(docs.coalesce(1), str(tmp_path / "d"), 100)
    files = list((tmp_path / "d").glob("*/*.json.gz"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 25_000
    assert spark.read.json(str(tmp_path / "d")).count() == 250
