"""Importance resampling towards a target, with exact sums over bit planes.

A document's features are its words and pairs of neighbouring words, hashed to ``BUCKETS``
buckets. Its bucket counts are kept as bit planes: bit b of plane i is bit i of the count of
bucket b. The gains of the buckets, floored to whole numbers, are bit planes too, one set for
the positive and one for the negative ones. The sum of the gains of a document's features is
then the sum over plane pairs of a power of two times the number of bits both planes have, in
whole numbers, so it does not depend on any order. The corpus counts come from the same planes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import ascii_lower, byte_set, crc32, pieces, words
from tidemark.llm.common import positions, stored

BUCKETS = 10_000
WORDS64 = -(-BUCKETS // 64)  # words of 64 bits in a plane
PLANE_BYTES = 8 * WORDS64
SCALE, LEAST_WORDS, PERCENT, SEED = 1000, 20, 25, 7
ROWS_AT_ONCE = 512
# The bytes of words: digits, small letters, and all that is not ASCII.
INSIDE = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = ascii_lower()
SPACE_CRC = np.frombuffer(b" ", np.uint8)


def _counts(piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys row * BUCKETS + bucket, how often each stands, and the words of each row."""
    row, start, length = words(piece, INSIDE)
    rows = piece.last - piece.first
    single = crc32(piece.data, start, length)
    same = row[1:] == row[:-1]
    spaced = crc32(SPACE_CRC, np.zeros(int(same.sum()), np.int64), np.ones(int(same.sum()), np.int64), single[:-1][same])
    pair = crc32(piece.data, start[1:][same], length[1:][same], spaced)
    if piece.goes_on:  # its first word has been counted
        row, single, pair_row = row[1:], single[1:], row[1:][same]
    else:
        pair_row = row[1:][same]
    keys = np.concatenate([row * BUCKETS + single % BUCKETS, pair_row * BUCKETS + pair % BUCKETS])
    found, count = np.unique(keys, return_counts=True)
    return found, count, np.bincount(row, minlength=rows)


def _planes(keys: np.ndarray, counts: np.ndarray, rows: int) -> list[bytes]:
    """The bit planes of each row, lowest first, as many as its largest count needs."""
    row = keys // BUCKETS
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, row, counts)
    height = np.array([int(m).bit_length() for m in most])
    packed = []
    for i in range(int(height.max(initial=0))):
        held = (counts >> i) & 1 == 1
        bits = np.zeros((rows, PLANE_BYTES * 8), np.uint8)
        bits[row[held], keys[held] % BUCKETS] = 1
        packed.append(np.packbits(bits, axis=1, bitorder="little"))
    return [b"".join(p[r].tobytes() for p in packed[: height[r]]) for r in range(rows)]


def _as_planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "text"]
        texts = batch.column("text")
        pending = None  # a text whose parts are still coming
        for piece in pieces(texts, INSIDE):
            piece.data = LOWER[piece.data]
            keys, counts, number = _counts(piece)
            if pending is not None and pending[0] == piece.first:
                keys, at = np.unique(np.concatenate([pending[2], keys]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([pending[3], counts])).astype(np.int64)
                number = number + pending[4]
            elif pending is not None:
                yield _row_batch(batch, names, *pending)
            pending = (piece.first, piece.last, keys, counts, number)
            if piece.last - piece.first > 1:
                yield _row_batch(batch, names, *pending)
                pending = None
        if pending is not None:
            yield _row_batch(batch, names, *pending)


def _row_batch(batch, names, first, last, keys, counts, number) -> pa.RecordBatch:
    part = batch.slice(first, last - first)
    planes = pa.array(_planes(keys, counts, last - first), pa.binary())
    return pa.RecordBatch.from_arrays(
        [*(part.column(n) for n in names), pa.array(number.astype(np.int64)), planes], [*names, "n_words", "planes"]
    )


def bit_planes(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs``' columns ``keep`` with n_words and planes, the bucket counts of the whole text."""
    kept = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    fields = [f"`{n}` {kept.schema[n].dataType.simpleString()}" for n in keep]
    return kept.mapInArrow(_as_planes, ", ".join([*fields, "n_words long", "planes binary"]))


def _stacks(planes: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows: the planes one below the other, the row of each and its power of two."""
    for first in range(0, len(planes), ROWS_AT_ONCE):
        held = [p.as_py() for p in planes.slice(first, ROWS_AT_ONCE)]
        height = np.array([len(p) // PLANE_BYTES for p in held])
        stack = np.frombuffer(b"".join(held), np.uint64).reshape(-1, WORDS64)
        power = np.arange(len(stack)) - np.repeat(np.cumsum(height) - height, height)
        yield stack, np.repeat(first + np.arange(len(held)), height), power


def _bucket_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for stack, _, power in _stacks(batch.column("planes")):
            for i in range(int(power.max(initial=-1)) + 1):
                bits = np.unpackbits(stack[power == i].view(np.uint8), axis=1, bitorder="little")
                total += bits.sum(axis=0, dtype=np.int64)[:BUCKETS] << i
    bucket = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], ["bucket", "n"])


def bucket_counts(planes: DataFrame) -> DataFrame:
    """(bucket, n) over all rows of ``planes``; each task passes on one row a bucket."""
    parts = planes.select("planes").mapInArrow(_bucket_sums, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, scale: int = SCALE) -> np.ndarray:
    """Each bucket's floored log ratio of its smoothed shares, in thousandths.

    The result has ``BUCKETS`` numbers, whatever the input.
    """
    spark = source.sparkSession
    every = spark.range(BUCKETS).select(F.col("id").alias("bucket"))
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left"
    ).fillna(0, ["s", "t"]).collect()
    all_s, all_t = sum(r.s for r in both), sum(r.t for r in both)
    out = np.zeros(BUCKETS, np.int64)
    for r in both:
        over = float(r.t + 1) * float(all_s + BUCKETS)
        out[r.bucket] = np.floor(scale * np.log(over / (float(r.s + 1) * float(all_t + BUCKETS))))
    return out


def gain_planes(values: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, plane) of the positive and of the negative gains."""
    out = []
    for sign in (1, -1):
        size = np.maximum(sign * values, 0)
        for i in range(int(size.max()).bit_length()):
            bits = np.zeros(PLANE_BYTES * 8, np.uint8)
            bits[:BUCKETS] = (size >> i) & 1
            out.append((sign << i if sign > 0 else -(1 << i), np.packbits(bits, bitorder="little").view(np.uint64)))
    return out


def gain_sums(planes: pa.Array, weighed: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Exact sum of gains of each row: AND, count bits, times powers of two."""
    total = np.zeros(len(planes), np.int64)
    for stack, row, power in _stacks(planes):
        sums = np.zeros(len(stack), np.int64)
        for factor, plane in weighed:
            sums += factor * np.bitwise_count(stack & plane).sum(axis=1, dtype=np.int64)
        np.add.at(total, row, sums << power)
    return total


def weights(planes: DataFrame, values: np.ndarray) -> DataFrame:
    """``planes`` with n_features and weight, the floored mean gain of a row's features."""
    weighed = gain_planes(values)
    names = [n for n in planes.columns if n != "planes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_words").to_numpy()
            features = n + np.maximum(n - 1, 0)
            mean = gain_sums(batch.column("planes"), weighed) // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(features), pa.array(mean)], [*names, "n_features", "weight"]
            )

    fields = [f"`{c}` {planes.schema[c].dataType.simpleString()}" for c in names]
    return planes.mapInArrow(run, ", ".join([*fields, "n_features long", "weight long"]))


def gumbel(doc_id: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """Floored Gumbel noise of a document, in thousandths, from a hash of its id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((head + 0.5) / 4294967296.0))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank.

    The ``percent`` of the documents with ``least_words`` or more that have the highest
    score are drawn and ranked from 1, ties to the smaller doc_id; all others have a null
    rank. A null or blank text has no features and weight 0. Rows that repeat a doc_id are
    weighed each for itself, and one of them is drawn before the other if both are; a null
    doc_id is noised as an empty one and comes after all others of its score. Without
    documents there are no rows, without a target every bucket is as rare there as another.
    Other columns are not looked at, and only the counts of the buckets pass the driver.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    planes = stored(
        bit_planes(ids, "doc_id").withColumn("row", F.monotonically_increasing_id()), "resample-planes"
    )
    wanted = bucket_counts(bit_planes(target.select("text")))
    values = gains(bucket_counts(planes), wanted)
    weighed = weights(planes, values)
    scored = weighed.select(
        "doc_id", "row", "n_words", "n_features", "weight",
        (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
        (F.col("n_words") < least_words).alias("short"),
    ).withColumns({"_down": -F.col("score"), "_no_id": F.col("doc_id").isNull()})
    placed = positions(scored, ["short", "_down", "_no_id", "doc_id", "row"], "resample-scored")
    able = placed.agg(F.count_if(~F.col("short")).alias("n")).first()["n"]
    drawn = F.col("pos") < able * percent // 100
    rank = F.when(drawn, F.col("pos") + 1).cast("long")
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
