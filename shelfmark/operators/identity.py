"""Keys: uniqueness checks and dense ids for new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A key's bucket is the first three hex digits of its hash: 4,096 buckets.
_BUCKET_DIGITS = 3


def duplicate_keys(table: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return table.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def check_unique(table: DataFrame, key: list[str]) -> None:
    broken = duplicate_keys(table, key).take(1)
    if broken:
        raise ValueError(f"duplicate key {broken[0].asDict()}")


def number_rows(keys: DataFrame, key: list[str], name: str, after: Column | int = 0) -> DataFrame:
    """Add ``name``: after + 1, after + 2, ... over unique ``keys``.

    Rows are numbered inside hash buckets of the key and shifted by the sizes
    of the buckets before, so no task sees all rows and a recomputed task gives
    the same numbers. The shift table has at most 4,096 rows.
    """
    bucketed = keys.withColumn(
        "_bucket", F.substring(F.md5(F.concat_ws("\x01", *[F.col(k).cast("string") for k in key])),
                               1, _BUCKET_DIGITS)
    )
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    shifts = sizes.select(
        "_bucket",
        (F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")).alias("_shift"),
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    after = after if isinstance(after, Column) else F.lit(after)
    return (
        bucketed.withColumn("_within", within)
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(name, (after + F.col("_shift") + F.col("_within")).cast("long"))
        .drop("_bucket", "_within", "_shift")
    )


#: Ids that are broadcast at most: 16 MB of numbers.
FEW_IDS = 2_000_000


def few_ids(ids: DataFrame) -> DataFrame:
    """Distinct ``ids``, one column of numbers, marked for broadcast where they are few.

    Rows that are thinned out by them then stay where they lie. More of them are left
    to Spark's choice of join. They are counted here, so they should be read from a table.
    """
    distinct = ids.distinct()
    return F.broadcast(distinct) if distinct.count() <= FEW_IDS else distinct


def highest_id(table: DataFrame) -> Column:
    """The largest stored id as a scalar subquery, 0 for an empty table."""
    return table.agg(F.coalesce(F.max("id"), F.lit(0)).alias("highest")).scalar()
