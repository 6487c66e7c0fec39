"""Reading a SQL subquery as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def subquery_scan(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run ``query`` over named DataFrames; ``{name}`` in the text stands for one.

    The query is planned with the rest of the job: filters and columns reach the scan.
    """
    return spark.sql(query, **tables)


def jdbc_subquery_scan(
    spark: SparkSession,
    url: str,
    query: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    pieces: int = 1,
    **options: str,
) -> DataFrame:
    """The same over a database connection.

    With ``split_on`` and ``bounds`` the read is cut into ``pieces`` ranges that run in
    parallel; without them a single task reads everything. Needs the database driver
    on the class path.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) src")
    if split_on and bounds:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", pieces)
        )
    return reader.options(**options).load()
