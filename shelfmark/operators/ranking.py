"""Top-k branches and their fusion."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.operators.fulltext import rank_order


def top_ranked(rows: DataFrame, order: list[Column], count: int) -> DataFrame:
    """The first ``count`` rows with their ``rank``.

    The limit comes first, so each task keeps ``count`` rows and the window
    over the whole set only ever sees ``count`` rows.
    """
    return rows.orderBy(*order).limit(count).withColumn(
        "rank", F.row_number().over(Window.orderBy(*order))
    )


def vectors_present(table: DataFrame) -> DataFrame:
    return table.where(F.col("embedding").isNotNull())


def distances(table: DataFrame, query_embedding: Sequence[float]) -> DataFrame:
    """``(id, distance)``: exact cosine distance of every stored vector.

    Computed on Arrow batches: measured several times as fast as higher-order
    functions, more so the longer the vectors. Each row is summed by itself, so
    equal vectors have equal distances wherever they lie.
    """
    query = np.asarray(query_embedding, dtype=np.float32).astype(np.float64)
    query_squared = float((query * query).sum())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            if (sizes != len(query)).any():
                raise ValueError(f"a stored vector differs from the query's {len(query)} dimensions")
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            rows = values.reshape(len(sizes), len(query))
            with np.errstate(divide="ignore", invalid="ignore"):
                similarity = (rows * query).sum(axis=1) / np.sqrt(
                    (rows * rows).sum(axis=1) * query_squared
                )
            distance = pa.array(1.0 - np.clip(similarity, -1.0, 1.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), distance], ["id", "distance"])

    return vectors_present(table).select("id", "embedding").mapInArrow(
        measure, "id long, distance double"
    )


def semantic_topk(table: DataFrame, query_embedding: Sequence[float], count: int) -> DataFrame:
    """``(id, distance, rank)`` of the nearest rows; NaN distances come last."""
    order = [F.col("distance").asc(), F.col("id").asc()]
    return top_ranked(distances(table, query_embedding), order, count)


def keyword_topk(scores: DataFrame, count: int) -> DataFrame:
    """``(id, score, rank)`` of the best ``(id, score)`` rows."""
    return top_ranked(scores, rank_order(), count)


def fuse(semantic: DataFrame, keyword: DataFrame, rrf_k: int = 60) -> DataFrame:
    """``(id, rrf_score)``: reciprocal ranks added over both branches."""
    s = semantic.select("id", F.col("rank").alias("semantic_rank"))
    k = keyword.select("id", F.col("rank").alias("keyword_rank"))

    def share(rank: str) -> Column:
        return F.coalesce(F.lit(1.0) / (F.lit(rrf_k) + F.col(rank)), F.lit(0.0))

    return s.join(k, "id", "full_outer").select(
        "id", (share("semantic_rank") + share("keyword_rank")).alias("rrf_score")
    )


def best_fused(fused: DataFrame, count: int) -> DataFrame:
    return fused.orderBy(F.col("rrf_score").desc(), F.col("id").asc()).limit(count)
