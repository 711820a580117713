"""Reading parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(table: DataFrame) -> DataFrame:
    """Rows dealt evenly over the cluster's cores, for costly work on each row.

    Spark chooses the number of tasks by size, so that of a large table no task holds
    more than it can work on in memory.
    """
    return table.hint("rebalance")
