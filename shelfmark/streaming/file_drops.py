"""Incremental indexing of scan tables that arrive over time."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.plans.indexing import run_index
from shelfmark.schemas import SCAN
from shelfmark.sources.repositories import latest_drop
from shelfmark.sources.store import TableStore


def index_file_drops(
    spark: SparkSession,
    store: TableStore,
    drops: str,
    metadata: Callable[[DataFrame], DataFrame],
    as_of: Callable[[int], datetime],
    progress: str,
    **options,
) -> StreamingQuery:
    """Index every parquet scan dropped into ``drops`` since the last call.

    ``metadata`` gives the repository metadata of a batch, ``as_of`` the time of
    a batch number. A batch that is replayed after a failure gives the same
    tables again, since the upsert is keyed. ``progress`` is the stream's own
    checkpoint folder.
    """

    def index(batch: DataFrame, number: int) -> None:
        scan = latest_drop(batch)
        run_index(store, scan, metadata(scan), as_of(number), **options)

    return (
        spark.readStream.schema(SCAN).parquet(drops)
        .withColumn("_dropped", F.col("_metadata.file_modification_time"))
        .writeStream.foreachBatch(index)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
