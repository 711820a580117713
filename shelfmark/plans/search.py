"""Hybrid search over files and functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfmark.functions.text import ENGLISH, Analyzer
from shelfmark.functions.vectors import hashed_vector_sql
from shelfmark.operators.fulltext import (
    keyword_scores,
    keyword_scores_from_postings,
    web_query,
)
from shelfmark.operators.ranking import best_fused, fuse, keyword_topk, semantic_topk


def query_embedding(spark: SparkSession, text: str, dimension: int = 64) -> list[float]:
    """The built-in embedding of a query text: one small job over one row."""
    row = spark.sql("SELECT :text AS text", args={"text": text})
    return row.select(F.expr(hashed_vector_sql("text", dimension))).first()[0]


def _filtered(table: DataFrame, **wanted) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            table = table.where(F.col(column) == value)
    return table


def _best(
    table: DataFrame,
    embedding: Sequence[float],
    query_text: str,
    match_count: int,
    rrf_k: int,
    analyzer: Analyzer,
    postings: DataFrame | None,
    postings_buckets: int | None,
    filters: dict,
) -> DataFrame:
    """``(id, rrf_score)`` of the best rows; both branches see the filters."""
    chosen = _filtered(table, **filters)
    query = web_query(table.sparkSession, query_text, analyzer)
    if postings is None or query.needs_all_rows:
        scores = keyword_scores(chosen, query)
    else:
        scores = keyword_scores_from_postings(_filtered(postings, **filters), query, postings_buckets)
    fused = fuse(
        semantic_topk(chosen, embedding, 2 * match_count),
        keyword_topk(scores, 2 * match_count),
        rrf_k,
    )
    return best_fused(fused, match_count)


#: Ids in one filter; a longer list is fetched in parts.
IDS_IN_A_FILTER = 1000


def _rows_by_id(table: DataFrame, ids: list[int]) -> DataFrame:
    """Rows with the given ids; each part of the list reaches a scan as a filter."""
    ordered = sorted(ids)
    parts = [ordered[i : i + IDS_IN_A_FILTER] for i in range(0, len(ordered), IDS_IN_A_FILTER)]
    if not parts:
        return table.where(F.lit(False))
    return reduce(DataFrame.union, [table.where(F.col("id").isin(p)) for p in parts])


def _fetch(table: DataFrame, best: DataFrame, fetch: str) -> DataFrame:
    """Rows of ``table`` for the ids of ``best``, which are ``match_count`` at most.

    "ids" runs the ranking now and hands its ids to the scan, which then reads
    the wide columns of few row groups. "join" stays lazy and reads the columns
    of all rows; Spark sees the size of the ranking and chooses the join.
    """
    if fetch not in ("ids", "join"):
        raise ValueError(f"unknown fetch mode {fetch!r}")
    if fetch == "ids":
        rows = best.collect()
        best = table.sparkSession.createDataFrame(rows, "id long, rrf_score double")
        table = _rows_by_id(table, [r["id"] for r in rows])
    return table.join(best, "id")


def _in_order(found: DataFrame, match_count: int) -> DataFrame:
    return found.orderBy(F.col("rrf_score").desc(), "id").limit(match_count)


def hybrid_search_files(
    files: DataFrame,
    query_embedding: Sequence[float],
    query_text: str,
    p_project_id: int | None = None,
    match_count: int = 10,
    rrf_k: int = 60,
    p_file_id: int | None = None,
    *,
    analyzer: Analyzer = ENGLISH,
    postings: DataFrame | None = None,
    postings_buckets: int | None = None,
    fetch: str = "ids",
) -> DataFrame:
    """``id, project_id, path, summary, rrf_score``, best first.

    ``files`` has ``id, project_id, path, summary, embedding, fts``.
    """
    best = _best(
        files, query_embedding, query_text, match_count, rrf_k, analyzer, postings, postings_buckets,
        {"project_id": p_project_id, "id": p_file_id},
    )
    found = _fetch(files.select("id", "project_id", "path", "summary"), best, fetch)
    return _in_order(found.select("id", "project_id", "path", "summary", "rrf_score"), match_count)


def hybrid_search_functions(
    functions: DataFrame,
    files: DataFrame,
    query_embedding: Sequence[float],
    query_text: str,
    p_project_id: int | None = None,
    match_count: int = 10,
    rrf_k: int = 60,
    *,
    analyzer: Analyzer = ENGLISH,
    postings: DataFrame | None = None,
    postings_buckets: int | None = None,
    fetch: str = "ids",
) -> DataFrame:
    """``id, file_id, project_id, path, name, summary, body, rrf_score``, best first.

    Bodies are read for the results only, found by their ids.
    """
    best = _best(
        functions, query_embedding, query_text, match_count, rrf_k, analyzer, postings, postings_buckets,
        {"project_id": p_project_id},
    )
    found = _fetch(functions.select("id", "file_id", "project_id", "name", "summary", "body"), best, fetch)
    owners = files.select("id", "path")
    if fetch == "ids":
        found_files = {r["file_id"] for r in found.select("file_id").collect()}
        owners = _rows_by_id(owners, list(found_files))
    joined = owners.withColumnRenamed("id", "file_id").join(found, "file_id").select(
        "id", "file_id", "project_id", "path", "name", "summary", "body", "rrf_score"
    )
    return _in_order(joined, match_count)


def format_results(results: DataFrame) -> DataFrame:
    """``rank, line, summary_line`` for display of a file search.

    Fixed values: the layout of both lines.
    """
    order = Window.orderBy(F.col("rrf_score").desc(), F.col("id").asc())
    return results.withColumn("rank", F.row_number().over(order)).select(
        "rank",
        F.format_string("%2d. [%.4f] (project %d) %s", "rank", "rrf_score", "project_id", "path")
        .alias("line"),
        F.when(
            F.col("summary") != "",
            F.concat(F.lit("    "), F.substring("summary", 1, 120), F.lit("...")),
        ).alias("summary_line"),
    )
