"""The two searches as SQL table functions with named and default arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfmark.functions.text import (
    ENGLISH,
    Analyzer,
    can_match_sql,
    evaluate_sql,
    hits_sql,
    web_query_sql,
)
from shelfmark.functions.vectors import cosine_distance_sql, squared_norm_sql, vector_literal


def _fused_sql(table: str, filters: str, analyzer: Analyzer) -> str:
    """Common table expressions ending in ``combined(id, score)``.

    LIMIT takes no argument, so the cuts are written as ``rank <= n``; Catalyst
    turns them into a top-n below the window. The query is parsed, and its
    vector's norm taken, in an aggregate over one row, so once. That single row meets the
    table as the condition of a join, since a function's arguments may not be
    used in a scalar subquery; no rows are multiplied.
    """
    return f"""
    query AS (
        SELECT first({web_query_sql('query_text', analyzer)}) AS clauses,
               first({squared_norm_sql('query_embedding')}) AS squared
    ),
    semantic AS (
        SELECT id, row_number() OVER (ORDER BY distance, id) AS rank
        FROM (SELECT f.id, {cosine_distance_sql('f.embedding', 'query_embedding', 'query.squared')} AS distance
              FROM {table} f JOIN query ON f.embedding IS NOT NULL WHERE {filters})
    ),
    found AS (
        SELECT f.id, {hits_sql('f.fts', 'query.clauses')} AS hits, query.clauses
        FROM {table} f JOIN query ON {can_match_sql('f.fts', 'query.clauses')}
        WHERE {filters}
    ),
    keyword AS (
        SELECT id, row_number() OVER (ORDER BY cast(result.score AS float) DESC, id) AS rank
        FROM (SELECT id, {evaluate_sql('hits', 'clauses')} AS result FROM found)
        WHERE result.matched
    ),
    combined AS (
        SELECT coalesce(s.id, k.id) AS id,
               coalesce(1.0D / (rrf_k + s.rank), 0.0D)
               + coalesce(1.0D / (rrf_k + k.rank), 0.0D) AS score
        FROM (SELECT * FROM semantic WHERE rank <= 2 * match_count) s
        FULL OUTER JOIN (SELECT * FROM keyword WHERE rank <= 2 * match_count) k ON s.id = k.id
    ),
    best AS (
        SELECT id, score FROM
        (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS place FROM combined)
        WHERE place <= match_count
    )"""


def create_file_search(
    spark: SparkSession, name: str, files: str, analyzer: Analyzer = ENGLISH
) -> None:
    """Create or replace the file search over the view ``files``."""
    filters = (
        "(p_project_id IS NULL OR f.project_id = p_project_id) "
        "AND (p_file_id IS NULL OR f.id = p_file_id)"
    )
    spark.sql(f"""
    CREATE OR REPLACE TEMPORARY FUNCTION {name}(
        query_embedding ARRAY<FLOAT>, query_text STRING, p_project_id BIGINT DEFAULT NULL,
        match_count INT DEFAULT 10, rrf_k INT DEFAULT 60, p_file_id BIGINT DEFAULT NULL)
    RETURNS TABLE (id BIGINT, project_id BIGINT, path STRING, summary STRING, rrf_score DOUBLE)
    RETURN WITH {_fused_sql(files, filters, analyzer)}
    SELECT /*+ BROADCAST(c) */ f.id, f.project_id, f.path, f.summary, c.score
    FROM best c JOIN {files} f ON f.id = c.id
    """)


def create_function_search(
    spark: SparkSession, name: str, functions: str, files: str, analyzer: Analyzer = ENGLISH, buckets: int | None = None
) -> None:
    """Create or replace the function search over two views.

    With ``buckets``, ``functions`` is a view of ``TableStore.rows``, in as many
    partitions: bodies are then read in the partitions of the results only, which
    Spark prunes by the winners' file ids. Without it, bodies of all rows are read.
    """
    if buckets is None:
        body, own = "f.body", "w.body"
        fetched = ""
    else:
        body, own = f"cast(pmod(xxhash64(f.file_id), {buckets}) AS INT) AS bucket", "b.body"
        fetched = f"JOIN {functions} b ON b.bucket = w.bucket AND b.id = w.id"
    filters = "(p_project_id IS NULL OR f.project_id = p_project_id)"
    spark.sql(f"""
    CREATE OR REPLACE TEMPORARY FUNCTION {name}(
        query_embedding ARRAY<FLOAT>, query_text STRING, p_project_id BIGINT DEFAULT NULL,
        match_count INT DEFAULT 10, rrf_k INT DEFAULT 60)
    RETURNS TABLE (id BIGINT, file_id BIGINT, project_id BIGINT, path STRING, name STRING,
                   summary STRING, body STRING, rrf_score DOUBLE)
    RETURN WITH {_fused_sql(functions, filters, analyzer)}
    , winners AS (
        SELECT /*+ BROADCAST(c) */ f.id, f.file_id, f.project_id, f.name, f.summary, {body}, c.score
        FROM best c JOIN {functions} f ON f.id = c.id
    )
    SELECT /*+ BROADCAST(w) */ w.id, w.file_id, w.project_id, p.path, w.name, w.summary, {own}, w.score
    FROM winners w JOIN {files} p ON p.id = w.file_id {fetched}
    """)


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")


def call(
    spark: SparkSession,
    name: str,
    query_embedding: Sequence[float],
    query_text: str,
    **arguments: int | None,
) -> DataFrame:
    """Call a search function with named arguments."""
    named = "".join(f", {key} => :{key}" for key in arguments)
    return spark.sql(
        f"SELECT * FROM {name}({vector_literal(query_embedding)}, :query_text{named})",
        args={"query_text": query_text, **arguments},
    )
