"""Exact nearest vectors without reading all of them: rows grouped around pivots.

Every vector belongs to the pivot at the least angle, and every group knows the
largest angle between its pivot and a member. Angles obey the triangle inequality,
so no member of a group is nearer to a query than the pivot's angle less that
radius. A search reads the nearest groups first; groups that can't hold a vector as
near as the last of the best found so far are never read. The result is that of a
scan of all rows. How many groups go unread depends on how the vectors cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from shelfmark.operators.ranking import distances, semantic_topk, vectors_present

#: Groups at most; their pivots and radii are what a search holds on the driver.
PIVOTS = 256
#: Rows without a direction, whose distance from everything is NaN.
NO_DIRECTION = -1
#: Angles are rounded; a group is left out only if it is farther by more than this.
_ROUNDING = 1e-6


def _directions(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero where there is no direction."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.where(np.isfinite(unit), unit, 0.0)


def choose_pivots(table: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Directions of ``count`` rows at most, drawn by a hash of their id."""
    drawn = vectors_present(table).orderBy(F.xxhash64("id"), "id").select("embedding").limit(count).collect()
    if not drawn:
        return np.zeros((0, 0))
    directions = _directions(np.array([r[0] for r in drawn], dtype=np.float64))
    return np.unique(directions[np.abs(directions).sum(axis=1) > 0], axis=0)


def grouped(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows of ``table (id, embedding, ...)`` that have a vector, with ``group`` and ``angle`` to its pivot."""
    present = vectors_present(table)
    schema = StructType([
        *present.schema.fields, StructField("group", IntegerType()), StructField("angle", DoubleType())])
    at = present.columns.index("embedding")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.array(batch.column(at).to_pylist(), dtype=np.float64).reshape(batch.num_rows, -1)
            group, angle = np.full(batch.num_rows, NO_DIRECTION), np.zeros(batch.num_rows)
            directions = _directions(vectors)
            known = np.abs(directions).sum(axis=1) > 0
            if known.any() and len(pivots):
                likeness = directions[known] @ pivots.T
                group[known] = likeness.argmax(axis=1)
                angle[known] = np.arccos(np.clip(likeness.max(axis=1), -1.0, 1.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(group, pa.int32()), pa.array(angle)], [*batch.schema.names, "group", "angle"])

    return present.mapInArrow(assign, schema)


def write_groups(table: DataFrame, folder: str, pivots: int = PIVOTS) -> None:
    """Write the rows of ``table (id, embedding, ...)`` by group, and the groups' pivots, radii and sizes.

    A large group is split over several files.
    """
    chosen = choose_pivots(table, pivots)
    rows = grouped(table, chosen)
    rows.hint("rebalance", F.col("group")).write.partitionBy("group").parquet(f"{folder}/vectors")
    spark = table.sparkSession
    listed = [(i, [float(v) for v in pivot]) for i, pivot in enumerate(chosen)]
    places = spark.createDataFrame(listed, "group int, pivot array<double>")
    written = spark.read.schema(rows.schema).parquet(f"{folder}/vectors")
    sizes = written.groupBy("group").agg(F.count("*").alias("rows"), F.max("angle").alias("radius"))
    sizes.join(places, "group", "left").write.parquet(f"{folder}/groups")


@dataclass(frozen=True)
class Nearest:
    """``rows (id, distance, rank)``, and how many stored rows were read for them, of how many."""

    rows: DataFrame
    read: int
    stored: int


def semantic_topk_pruned(spark: SparkSession, folder: str, query_embedding: Sequence[float], count: int) -> Nearest:
    """The ``count`` nearest rows of ``write_groups``, as ``semantic_topk`` finds them; ties go to the smaller id."""
    groups = spark.read.parquet(f"{folder}/groups").collect()
    stored = sum(g["rows"] for g in groups)
    query = _directions(np.asarray([query_embedding], dtype=np.float32).astype(np.float64))[0]
    nearest = {}
    for g in groups:
        if g["pivot"] is not None and query.any():
            if len(g["pivot"]) != len(query):
                raise ValueError(f"a stored vector differs from the query's {len(query)} dimensions")
            angle = float(np.arccos(np.clip(query @ np.asarray(g["pivot"]), -1.0, 1.0)))
            nearest[g["group"]] = max(0.0, angle - g["radius"])
        else:
            nearest[g["group"]] = np.inf  # without an angle: read only if the others don't fill the result
    sizes = {g["group"]: g["rows"] for g in groups}

    def rows_of(chosen: list[int]) -> DataFrame:
        table = spark.read.schema("id long, embedding array<float>, group int").parquet(f"{folder}/vectors")
        return table.where(F.col("group").isin(chosen) if chosen else F.lit(False))

    first, found = [], 0
    for group in sorted(nearest, key=lambda g: (nearest[g], g)):
        if found >= count:
            break
        first.append(group)
        found += sizes[group]
    chosen = first
    if found >= count and all(np.isfinite(nearest[g]) for g in first):
        best = distances(rows_of(first), query_embedding).orderBy("distance").limit(count)
        worst = best.agg(F.max("distance")).first()[0]
        reach = float(np.arccos(np.clip(1.0 - worst, -1.0, 1.0))) + _ROUNDING if count else -1.0
        chosen = [g for g in nearest if nearest[g] <= reach or g in first]
    return Nearest(
        semantic_topk(rows_of(chosen), query_embedding, count), sum(sizes[g] for g in chosen), stored)
