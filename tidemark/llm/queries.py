"""The registered queries of these operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import oracles
from tidemark.llm.ann import nearest
from tidemark.llm.common import table
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.line_dedup import line_report
from tidemark.llm.mixing import mix
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.pii import personal_data
from tidemark.llm.quality import quality_scores
from tidemark.llm.repair import all_repairs, damaged
from tidemark.llm.resample import resampled
from tidemark.llm.sharding import shard_documents
from tidemark.llm.toxicity import toxicity_scores
from tidemark.llm.url_filter import url_verdicts
from tidemark.llm.warc import archived_pages


def op1_nearest_neighbours(spark: SparkSession, data: str) -> DataFrame:
    found = nearest(table(spark, data, "embeddings"), F.col("vec_id") % 20 == 0, 20)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_mix_sources(spark: SparkSession, data: str) -> DataFrame:
    return mix(table(spark, data, "documents"))


def op3_shard_documents(spark: SparkSession, data: str) -> DataFrame:
    sharded = shard_documents(table(spark, data, "documents"), 8)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


def op4_line_dedup(spark: SparkSession, data: str) -> DataFrame:
    return line_report(table(spark, data, "documents"))


def op5_decontaminate(spark: SparkSession, data: str) -> DataFrame:
    return contaminated(table(spark, data, "documents"), table(spark, data, "benchmark"))


def op6_personal_data(spark: SparkSession, data: str) -> DataFrame:
    return personal_data(table(spark, data, "documents")).drop("text_key", "marks")


def op7_near_duplicates(spark: SparkSession, data: str) -> DataFrame:
    return near_duplicates(table(spark, data, "documents"), width=3, percent=85)


def op8_quality(spark: SparkSession, data: str) -> DataFrame:
    return quality_scores(table(spark, data, "documents"), table(spark, data, "labels"), 0.7)


def op9_warc(spark: SparkSession, data: str) -> DataFrame:
    return archived_pages(table(spark, data, "pages"))


def op10_url_verdicts(spark: SparkSession, data: str) -> DataFrame:
    return url_verdicts(table(spark, data, "pages"))


def op11_repair_conversations(spark: SparkSession, data: str) -> DataFrame:
    conversations = table(spark, data, "conversations")
    return all_repairs(conversations, damaged(conversations))


def op12_toxicity(spark: SparkSession, data: str) -> DataFrame:
    return toxicity_scores(table(spark, data, "documents"), table(spark, data, "labels"), 0.5)


def op13_resample(spark: SparkSession, data: str) -> DataFrame:
    drawn = resampled(table(spark, data, "documents"), table(spark, data, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours,
        op2_mix_sources,
        op3_shard_documents,
        op4_line_dedup,
        op5_decontaminate,
        op6_personal_data,
        op7_near_duplicates,
        op8_quality,
        op9_warc,
        op10_url_verdicts,
        op11_repair_conversations,
        op12_toxicity,
        op13_resample,
    )
}
ORACLES = oracles.SQL
