"""What several operators share: tables, written intermediates, words, row positions."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_folder

SPACES = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there.

    So its shuffle files go when it is written, and not when the driver happens to collect
    its garbage.
    """
    spark = df.sparkSession
    path, before = work_folder(spark, purpose), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column, separators: str = SPACES) -> Column:
    """Words of a text in order; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def hashes(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.xxhash64(s))


def positions(df: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """``df`` with ``pos``: each row's place, from 0, in the order of ``keys``.

    Rows are range-partitioned and sorted once and written with their place in their
    partition; the driver sees one count per partition. A key that many rows share
    spreads over partitions if a later key tells its rows apart.
    """
    spark = df.sparkSession
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stored(laid.withColumn("_at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_at", 33).cast("int")
    starts, total = [], 0
    for part_no, count in sorted(rows.groupBy(part.alias("p")).count().collect()):
        starts.append((part_no, total))
        total += count
    offsets = spark.createDataFrame(starts or [(0, 0)], "_part int, _start long")
    return (
        rows.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn("pos", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_start", "_at")
    )


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (id, root) for each id in them.

    ``root`` is the smallest id reachable. Every round each id takes the smallest root
    among its neighbours and then its root's root, so that long chains halve; rounds end
    when no root changes. Each round is written, and the driver sees only a count.
    """
    both = stored(
        edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), purpose
    )
    roots = stored(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("root")), purpose)
    while True:
        near = (
            both.join(roots.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("root").alias("near"))
        )
        # A root also learns what the ids below it have found.
        told = (
            roots.join(near, "id")
            .groupBy(F.col("root").alias("id"))
            .agg(F.min("near").alias("told"))
        )
        better = (
            roots.join(near, "id")
            .join(told, "id", "left")
            .select("id", F.col("root").alias("old"), F.least("root", "near", "told").alias("mid"))
        )
        up = better.select(F.col("id").alias("mid"), F.col("mid").alias("up"))
        new = stored(
            better.join(up, "mid", "left").select("id", "old", F.least("mid", "up").alias("root")),
            purpose,
        )
        changed = new.where("old != root").limit(1).count()
        roots = new.drop("old")
        if not changed:
            return roots


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))


def table_of(counts: DataFrame, slots: int, kind: str) -> Column:
    """Rows (slot, value) as one array of ``slots`` numbers, 0 where there is no row.

    Its size is fixed by ``slots``, whatever the data: a scalar subquery that each task
    gets once. Element ``i`` is slot ``i - 1``.
    """
    spark = counts.sparkSession
    dense = (
        spark.range(slots).select(F.col("id").alias("slot")).join(counts, "slot", "left")
        .select("slot", F.coalesce(F.col("value"), F.lit(0)).cast(kind).alias("value"))
    )
    listed = dense.agg(F.sort_array(F.collect_list(F.struct("slot", "value"))).alias("all"))
    return listed.select(F.col("all.value").alias("all")).scalar()


SIEVE_BITS = 1 << 20


def sieve(keys: DataFrame, key: str) -> Column:
    """A bitmap of the keys' hashes, of fixed size, for ``passes``."""
    slot = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS))
    bits = keys.select(slot.alias("bit")).distinct()
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int")))
    grouped = bits.groupBy(F.floor(F.col("bit") / 64).alias("slot")).agg(mask.alias("value"))
    return table_of(grouped, SIEVE_BITS // 64, "long")


def passes(bitmap: Column, key: Column) -> Column:
    """False only for keys that are not among the sieve's keys."""
    slot = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS))
    word = F.get(bitmap, F.floor(slot / 64).cast("int"))
    return F.call_function("shiftright", word, (slot % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
