from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tests.helpers import OPEN, T1

GOLDEN = ["1", "ORDER ISSUES", "JDOE", "01/01/2021 00:00:00", "COMPLETED", "CALL", "PRIME MEMBER"]
GOLDEN += ["120", "150", "RESOLVED", "YES", "SELF-HELP OPTION", "9"]


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column).first()[0]


def hashed(spark, values, function):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    return df.select(function(names)).first()[0]


def test_row_hash_golden(spark):
    assert hashed(spark, GOLDEN, fn.row_hash) == "a561026f3381305bd1834c6d01f785ab"
    without = GOLDEN[:2] + [None] + GOLDEN[3:]
    assert hashed(spark, without, fn.row_hash) == "0551c6a6e9e726d14291a76e56691cbf"


def test_row_hash_skips_nulls_and_the_null_safe_one_does_not(spark):
    left, right = ["a", None, "b"], ["a", "b", None]
    assert hashed(spark, left, fn.row_hash) == hashed(spark, right, fn.row_hash)
    assert hashed(spark, left, fn.null_safe_hash) != hashed(spark, right, fn.null_safe_hash)
    assert hashed(spark, ["n"], fn.null_safe_hash) != hashed(spark, [None], fn.null_safe_hash)


@pytest.mark.parametrize(
    "function, text, expected",
    [
        (fn.parse_ts_dmy, "31/12/2021 23:04:05", datetime(2021, 12, 31, 23, 4, 5)),
        (fn.parse_ts_dmy, "32/13/2021 00:00:00", None),
        (fn.parse_ts_dmy, "2021-12-31 23:04:05", None),
        (fn.parse_ts_compact, "20211231230405", datetime(2021, 12, 31, 23, 4, 5)),
        (fn.parse_ts_compact, "2021123123040", None),
        (fn.parse_ts_mdy_compact, "12312021230405", datetime(2021, 12, 31, 23, 4, 5)),
        (fn.parse_ts_mdy_compact, "xx", None),
        (fn.parse_ts_created, "2024/01/02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        (fn.parse_ts_created, None, None),
    ],
)
def test_timestamps(spark, function, text, expected):
    assert one(spark, text, function("c")) == expected


def test_timestamps_ignore_the_session_zone(spark):
    """A wall-clock time that does not exist in the session zone is kept as written."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = one(spark, "20240310023000", fn.parse_ts_compact("c").cast("string"))
        assert text == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "text, seconds",
    [("0:02:00", 120), ("00:10:05", 605), ("1:00", None), ("x:y:z", None), (None, None)],
)
def test_duration(spark, text, seconds):
    assert one(spark, text, fn.duration_to_seconds("c")) == seconds


@pytest.mark.parametrize("rating, half", [(1, 1), (2, 1), (3, 2), (9, 5), (10, 5), (None, None)])
def test_rating_halve(spark, rating, half):
    assert one(spark, rating, fn.rating_halve("c"), "int") == half


@pytest.mark.parametrize(
    "label, score", [("WORST", 1), ("NEUTRAL", 3), ("BEST", 5), ("best", None), (None, None)]
)
def test_rating_from_label(spark, label, score):
    assert one(spark, label, fn.rating_from_label("c")) == score


@pytest.mark.parametrize("word, truth", [("yes", True), ("NO", False), ("maybe", None), (None, None)])
def test_boolean(spark, word, truth):
    assert one(spark, word, fn.normalise_boolean("c", "YES", "NO")) is truth


def test_numbers_and_identifiers(spark):
    assert one(spark, "12", fn.cast_numeric("c")) == 12
    assert one(spark, "n/a", fn.cast_numeric("c")) is None
    assert one(spark, 7, fn.source_identifier("CLIENT_ALPHA", "c"), "bigint") == "CLIENT_ALPHA-7"
    assert one(spark, None, fn.source_identifier("CLIENT_ALPHA", "c"), "bigint") == "CLIENT_ALPHA"


@pytest.mark.parametrize(
    "valid, inserted, updated, share",
    [(9, 8, 2, "90.00"), (0, 0, 0, "0.00"), (1, 3, 0, "33.33"), (2, 3, 0, "66.67")],
)
def test_validity(spark, valid, inserted, updated, share):
    df = spark.createDataFrame([(valid, inserted, updated)], "v bigint, i bigint, u bigint")
    got = df.select(fn.validity_percentage(F.col("v"), F.col("i"), F.col("u"))).first()[0]
    assert got == Decimal(share)


def test_durations_of_runs(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 1), datetime(2026, 1, 2, 1, 1, 1, 500000))],
        "run_start_date timestamp_ntz, run_end_date timestamp_ntz",
    )
    seconds = df.select(fn.interval_epoch_seconds(fn.run_duration())).first()[0]
    assert seconds == 86400 + 3661.5


def test_version_columns_and_empty_text(spark):
    df = fn.scd_defaults(spark.createDataFrame([("", 1)], "a string, b int"), T1)
    row = fn.empty_to_null(df).first()
    assert (row.a, row.b, row.is_active, row.start_date, row.end_date) == (None, 1, True, T1, OPEN)


def test_buckets_are_stable_and_in_range(spark):
    df = spark.range(1000).select(fn.bucket_of("id", 8).alias("b"))
    found = {r.b: r["count"] for r in df.groupBy("b").count().collect()}
    assert set(found) == set(range(8)) and max(found.values()) < 200
