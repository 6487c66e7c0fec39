"""Which rows of a stored table are named by their ids, told without moving the table.

Named ids are stored as bits, 32,768 ids a row. Where ids follow each other that is a bit for
each row of the table, in parts that Spark measures to be small enough for a broadcast each, so
the table's rows are neither shuffled nor sorted to learn whether they are named. No broadcast is
forced: a part that Spark does not take for small is joined like any other table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# An id is a chunk's number, a word's place in the chunk and a bit's place in the word.
_BITS, _WORDS = 6, 9
MOST_PARTS = 16
SCHEMA = "chunk bigint, bits array<bigint>"
_CHUNK_BYTES = (1 << _WORDS) * 8 + 64


def _chunk(id_: Column) -> Column:
    return F.shiftright(id_, _BITS + _WORDS)


def _place(id_: Column) -> Column:
    return F.shiftright(id_, _BITS).bitwiseAND(F.lit((1 << _WORDS) - 1)).cast("int")


def _bit(id_: Column) -> Column:
    return F.pmod(id_, F.lit(1 << _BITS)).cast("int")


def _part_bytes(spark: SparkSession) -> int:
    """Half of what Spark broadcasts; where it broadcasts nothing one part is as good as many."""
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return limit // 2 if limit > 0 else 1 << 30


def write_marks(ids: DataFrame, name: str, path: str) -> None:
    """Store the ids in column ``name`` as bits; NULL names nothing.

    Not compressed, so that a file's length, by which Spark measures it, is what it takes in
    memory.
    """
    id_ = F.col(name)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(id_))
    named = ids.where(id_.isNotNull())
    words = named.groupBy(F.shiftright(id_, _BITS).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    places = F.map_from_entries(
        F.collect_list(F.struct(F.col("_word").bitwiseAND(F.lit((1 << _WORDS) - 1)).cast("int"), "_bits"))
    )
    chunks = words.groupBy(F.shiftright("_word", _WORDS).alias("chunk")).agg(places.alias("_places"))
    every = F.sequence(F.lit(0), F.lit((1 << _WORDS) - 1))
    dense = F.transform(every, lambda i: F.coalesce(F.element_at("_places", i), F.lit(0).cast("bigint")))
    (
        chunks.select("chunk", dense.alias("bits"))
        .write.mode("overwrite")
        .option("compression", "uncompressed")
        .option("parquet.enable.dictionary", "false")
        .option("maxRecordsPerFile", max(1, _part_bytes(ids.sparkSession) // 2 // _CHUNK_BYTES))
        .parquet(path)
    )


def read_marks(spark: SparkSession, path: str) -> list[DataFrame]:
    """Stored marks as parts of bounded size. No chunk is in two of them.

    A row is looked up in one part after the other; marks of more than ``MOST_PARTS`` are one
    part, with which Spark joins the rows by chunk.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.parquet")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    most, room, parts = _part_bytes(spark), 0, []
    for status in found:
        if not parts or status.getLen() > room:
            parts.append([])
            room = most
        parts[-1].append(status.getPath().toString())
        room -= status.getLen()
    if len(parts) > MOST_PARTS:
        parts = [sum(parts, [])]
    return [spark.read.schema(SCHEMA).parquet(*files) for files in parts]


def count_marks(spark: SparkSession, path: str) -> int:
    """How many ids the marks below a path name."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    each = F.aggregate("bits", F.lit(0), lambda n, word: n + F.bit_count(word))
    return stored.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0]


def marked(rows: DataFrame, name: str, marks: list[DataFrame], shown: str) -> DataFrame:
    """``rows`` with a boolean ``shown``: does any of ``marks`` name the row's id in ``name``?"""
    id_, columns, named = F.col(name), rows.columns, F.lit(False)
    for number, part in enumerate(marks):
        chunk, bits = f"_chunk{number}", f"_bits{number}"
        part = part.select(F.col("chunk").alias(chunk), F.col("bits").alias(bits))
        rows = rows.join(part, _chunk(id_) == F.col(chunk), "left")
        bit = F.call_function("shiftrightunsigned", F.get(bits, _place(id_)), _bit(id_))
        named = named | F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return rows.select(*columns, named.alias(shown))
