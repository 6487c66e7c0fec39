"""A training corpus from raw documents: filter, deduplicate, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept. Its result is
written as Parquet, and the next stage reads it. All but the last return the columns of
``docs``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.mixing import mix
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.quality import quality_scores
from tidemark.llm.sharding import shard_documents

QUALITY_THRESHOLD = 0.7
SHARDS = 8


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id is among those of ``gone``; a null matches a null."""
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone[gone.columns[0]]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Rows of one doc_id are judged together: the
    best counts; rows without doc_id likewise. Without labels of a bad class all stay."""
    scored = quality_scores(docs, table(spark, sf_dir, "labels"), QUALITY_THRESHOLD)
    poor = scored.groupBy(F.col("doc_id").alias(_free(docs, "_id"))).agg(F.max("predicted").alias("best"))
    return _without(docs, poor.where("best = 0").drop("best"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of smallest doc_id.

    Shingles are five words, the similarity 0.8. Of rows that repeat a doc_id one stays, that
    of the smallest text; rows without doc_id all stay.
    """
    found, name = near_duplicates(docs, width=5, percent=80), _free(docs, "_id")
    kept = found.where("kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    one = (
        docs.join(kept, docs["doc_id"] == kept[name])
        .groupBy("doc_id")
        .agg(F.min(F.struct(F.col("text").alias("text"), *(F.col(c) for c in rest if c != "text"))).alias("row"))
        .select("doc_id", "row.*")
    )
    return one.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with all rows of their doc_id; null and empty
    texts hold none. Without a benchmark all stay."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select(F.col("doc_id").alias(_free(docs, "_id"))).distinct())


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mix: sources have their target weights, to less than
    one block; one that has run dry leaves, and the others go on by their weights.

    Rows of one doc_id stand together, at the place of the first. The order is that of the
    rows in the files written, by which the next stage cuts its shards.
    """
    name, at = _free(docs, "_id"), _free(docs, "_at")
    places = mix(docs).groupBy(F.col("doc_id").alias(name)).agg(F.min("position").alias(at))
    placed = docs.join(places, docs["doc_id"].eqNullSafe(places[name]), "left")
    return placed.orderBy(at, F.xxhash64("text")).select(*(docs[c] for c in docs.columns))


def stored_order(docs: DataFrame) -> Column | None:
    """The place of each row in the files ``docs`` is read from, in the order of their numbers;
    None where it does not come from files."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return None
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).try_cast("long")
    return F.coalesce(part, F.lit(0)) * (1 << 40) + F.col("_metadata.row_index")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document.

    Shards are consecutive ranges of the mix, of near-equal bytes, and slots follow it, so
    that each shard, read in order, has the sources' target weights. Equal texts stand
    together, where the first of them does; a null text counts as an empty one with its own
    group. No documents give no rows.
    """
    return shard_documents(docs, SHARDS, stored_order(docs))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicate),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

# A trained classifier has no SQL form; tests hold run() against its single stages and the
# last two against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
