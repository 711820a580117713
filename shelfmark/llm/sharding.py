"""Shards of a shuffled table, by a two-pass external shuffle.

The first pass deals every record a bucket by a seeded hash, uniformly, and
writes it. Buckets are as many as keep each one small enough for memory. The
second pass brings each bucket together and puts it in the order of a Fisher-Yates
shuffle of its places. The buckets in turn are one random sequence of all records,
which is cut into shards whose row counts differ by one at most.

Only the order of a bucket, a row of whole numbers, is held at once; its records
are sorted, so long texts spill. Everything is a DataFrame function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.llm.frames import unused, written

#: Bytes of records that a bucket holds on average at most; each record counts ``_ROW`` bytes besides its text.
BUCKET_BYTES = 64 << 20
_ROW = 64
#: Buckets of a small table, so that all tasks have some.
LEAST_BUCKETS = 1024
#: Buckets whose starts are summed up in one task.
_GROUP = 4096
#: Buckets whose orders are drawn in one task; not Spark's choice, so that a seed gives the same order again.
_DRAWN_TOGETHER = 64


def record_size(text: str = "text") -> Column:
    """Bytes of a record: those of its text in UTF-8 (null: none), and one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _orders(buckets: DataFrame, count: int, seed: int) -> DataFrame:
    """``bucket, start, order``: where each bucket of ``buckets (bucket, n)`` begins, and its shuffled places.

    Starts are summed up within groups of buckets, and the groups by themselves.
    Spark's ``shuffle`` of an array is a seeded Fisher-Yates shuffle.
    """
    grouped = buckets.withColumn("part", F.floor(F.col("bucket") / _GROUP))
    parts = grouped.groupBy("part").agg(F.sum("n").alias("size"))
    shifts = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("shift"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("bucket")) - F.col("n")
    started = grouped.withColumn("within", within).join(shifts, "part").select(
        "bucket", "n", (F.col("shift") + F.col("within")).alias("start"))
    drawn = started.repartition(-(-count // _DRAWN_TOGETHER), "bucket").sortWithinPartitions("bucket")
    places = F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))
    return drawn.select("bucket", "start", F.shuffle(places, seed=seed).alias("order"))


def shuffled(
    docs: DataFrame, seed: int = 0, text: str = "text", name: str = "position",
    bucket_bytes: int = BUCKET_BYTES, least_buckets: int = LEAST_BUCKETS,
) -> DataFrame:
    """``docs`` with ``name``: the place of each record, from 0 without a gap, in a random order of all.

    The hash is taken of the seed and the record's place in the input, so that
    repeated rows, rows without an id and copies of one text are dealt evenly like
    all others. The same input files and seed give the same order. Null and empty
    texts are records like others, and an empty table gives an empty result. A
    column of ``docs`` that bears the name is replaced.
    """
    kept = docs.drop(name)
    place, bucket, rank, start, order = (unused(kept, n) for n in ("place", "bucket", "rank", "start", "order"))
    size = docs.agg(F.sum(record_size(text) + _ROW)).first()[0] or 0
    count = max(least_buckets, -(-size // bucket_bytes))
    # First pass: written, so that a lost executor can't deal a record anew.
    dealt = written(kept.withColumn(place, F.monotonically_increasing_id()).withColumn(
        bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(place)), F.lit(count))))
    sizes = dealt.groupBy(F.col(bucket).alias("bucket")).agg(F.count("*").alias("n"))
    orders = written(_orders(sizes, count, seed)).select(
        F.col("bucket").alias(bucket), F.col("start").alias(start), F.col("order").alias(order))
    # Second pass: each bucket in its shuffled order.
    ranked = dealt.withColumn(rank, F.row_number().over(Window.partitionBy(bucket).orderBy(place)))
    return ranked.join(orders, bucket).withColumn(
        name, F.col(start) + F.element_at(order, F.col(rank))
    ).select(*kept.columns, name)


def into_shards(docs: DataFrame, shards: int, seed: int = 0, text: str = "text", **options: int) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (from 0 without a gap in each shard).

    A shard is a run of the shuffled sequence; the numbers of rows differ by one
    at most. With fewer records than shards, some are empty. See ``shuffled`` for
    nulls, repeated rows and empty tables; columns that bear these names are replaced.
    """
    kept = docs.drop("shard", "slot")
    position, rows = unused(kept, "position"), docs.count()
    at = F.col(position)
    placed = shuffled(kept, seed, text, position, **options)
    whole = F.expr(f"`{position}` * {shards}L div {max(rows, 1)}L")
    return placed.withColumn("shard", whole.cast("int")).withColumn(
        "slot", at - F.expr(f"(cast(shard as bigint) * {rows}L + {shards - 1}L) div {shards}L")
    ).drop(position)


def write_shards(docs: DataFrame, folder: str, shards: int, seed: int = 0, text: str = "text", **options: int) -> None:
    """Write ``into_shards`` as Parquet, one folder ``shard=i`` each; rows of a file are in the order of ``slot``."""
    placed = into_shards(docs, shards, seed, text, **options)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
