"""Shards of near-equal size: the smallest capacity for which contiguous cuts suffice.

Rows lie in the order of their group's key, and a group is never cut. For a capacity C the
greedy check fills one shard after the other up to C; C is feasible if all groups fit. The
search brackets the smallest feasible C, testing many capacities a round, so that a round
costs one small job per shard. Prefix sums stay distributed: a job answers "the furthest
group end not beyond x" for all x asked, and reads only groups near them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import positions, stored

CAPACITIES_A_ROUND = 64


def _furthest(ends: DataFrame, targets: list[int], largest: int) -> dict[int, int]:
    """For each target the largest group end not beyond it (0 if none)."""
    marks = sorted(set(targets))
    place = F.size(F.filter(F.array(*[F.lit(t) for t in marks]), lambda t: t < F.col("end")))
    found = (
        ends.where(f"end > {marks[0] - largest} and end <= {marks[-1]}")
        .groupBy(place.alias("place"))
        .agg(F.max("end").alias("end"))
        .collect()
    )
    by_place, best, answer = dict(found), 0, {}
    for place_no, mark in enumerate(marks):
        best = max(best, by_place.get(place_no, 0))
        answer[mark] = best
    return answer


def _greedy(ends: DataFrame, capacities: list[int], shards: int, largest: int) -> dict[int, list[int]]:
    """Cut positions that the greedy check makes for each capacity."""
    cuts = {c: [0] for c in capacities}
    for _ in range(shards):
        reach = _furthest(ends, [at[-1] + c for c, at in cuts.items()], largest)
        for c, at in cuts.items():
            at.append(max(at[-1], reach[at[-1] + c]))
    return cuts


def smallest_capacity(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The least largest-shard size, and the cuts of its greedy filling."""
    low = max(largest, -(-total // shards))
    high = -(-total // shards) + largest  # a shard below it leaves out less than one group
    best: list[int] | None = None
    while low < high or best is None:
        step = max(1, -(-(high - low) // CAPACITIES_A_ROUND))
        tried = sorted({*range(low, high, step), high})
        cuts = _greedy(ends, tried, shards, largest)
        fits = [c for c in tried if cuts[c][-1] == total]
        below = [c for c in tried if c < fits[0]]
        high, best = fits[0], cuts[fits[0]]
        low = below[-1] + 1 if below else high
    return high, best


def minimax_shards(rows: DataFrame, group: str, size: str, tie: str, shards: int) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards-1) and ``slot`` (from 0 in each shard).

    ``group`` is an orderable column without nulls, ``size`` a long of at least 0, ``tie``
    orders the rows of a group. Groups lie in the order of their keys; rows of a group stay
    together, so one huge group sets the capacity. Fewer groups than shards leave the last
    shards empty. An empty table gives no rows.
    """
    placed = positions(rows, [group, tie], "shard-rows")
    groups = placed.groupBy(group).agg(
        F.min("pos").alias("pos"), F.sum(size).alias("size"), F.max(size).alias("top")
    )
    chunk = F.floor(F.col("pos") / 65536).alias("chunk")
    groups = stored(groups.select(group, "pos", "size", chunk), "shard-groups")
    before = (
        groups.groupBy("chunk").agg(F.sum("size").alias("size"))
        # One row for each 65536 rows; chunks of chunks keep this window small as well.
        .withColumn("super", F.floor(F.col("chunk") / 65536))
    )
    supers, total = {}, 0
    for number, amount in sorted(before.groupBy("super").agg(F.sum("size")).collect()):
        supers[number] = total
        total += amount
    if not total:
        return placed.withColumn("shard", F.lit(0)).withColumn("slot", F.col("pos")).drop("pos")
    base = rows.sparkSession.createDataFrame(list(supers.items()), "super long, base long")
    in_super = Window.partitionBy("super").orderBy("chunk")
    before = before.join(base, "super").select(
        "chunk", (F.col("base") + F.sum("size").over(in_super) - F.col("size")).alias("before")
    )
    in_chunk = Window.partitionBy("chunk").orderBy("pos")
    ends = stored(
        groups.join(before, "chunk").select(
            group, "size", (F.col("before") + F.sum("size").over(in_chunk)).alias("end")
        ),
        "shard-ends",
    )
    largest = ends.agg(F.max("size")).first()[0]
    _, cuts = smallest_capacity(ends, total, largest, shards)
    inner = sorted({c for c in cuts[1:] if 0 < c < total})
    last_of = ends.where(F.col("end").isin(inner) & (F.col("size") > 0)).groupBy("end").agg(F.max(group)).collect()
    shard: Column = F.lit(0)
    for _, key in sorted(last_of):
        shard = shard + (F.col(group) > F.lit(key)).cast("int")
    sharded = placed.withColumn("shard", shard)
    first = F.lit(0).cast("long")
    for number, pos in sharded.groupBy("shard").agg(F.min("pos")).collect():
        first = F.when(F.col("shard") == number, F.lit(pos)).otherwise(first)
    return sharded.withColumn("slot", F.col("pos") - first).drop("pos")


def shard_documents(docs: DataFrame, shards: int = 8, order: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Size is the UTF-8 bytes of the text plus one. Documents with equal texts form a group,
    null texts another one; groups lie in the order of their texts' SHA-256, so a shard is
    as mixed as the whole. With ``order``, a long that differs from row to row, groups lie in
    the order of their first row instead: shards are consecutive ranges of a given order, and
    slots follow it. Repeated rows are placed each for itself. Other columns of ``docs`` are
    not looked at.
    """
    text = F.col("text").cast("binary")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("text_key"),
        *([] if order is None else [order.cast("long").alias("place")]),
    )
    if order is None:
        sharded = minimax_shards(rows, "text_key", "size", "doc_id", shards)
    else:
        # The first place of a text names it as well as its hash does.
        first = rows.groupBy("text_key").agg(F.min("place").alias("first"))
        rows = rows.join(first, "text_key").drop("text_key")
        sharded = minimax_shards(rows, "first", "size", "place", shards)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int"), F.col("slot").cast("long")
    )
