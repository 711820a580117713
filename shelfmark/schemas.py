"""Schemas of the three stored tables and of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in columns])


_LONG, _INT, _STRING, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()
_VECTOR, _LEXEMES = T.ArrayType(T.FloatType()), T.ArrayType(T.StringType())

PROJECTS = _fields(
    ("id", _LONG, False),
    ("name", _STRING, False),
    ("git_url", _STRING, False),
    ("language", _STRING, True),
    ("default_branch", _STRING, True),
    ("summary", _STRING, True),
    ("embedding", _VECTOR, True),
    ("last_updated", _TIME, True),
)
FILES = _fields(
    ("id", _LONG, False),
    ("project_id", _LONG, False),
    ("path", _STRING, False),
    ("checksum", _STRING, False),
    ("body", _STRING, True),
    ("summary", _STRING, True),
    ("embedding", _VECTOR, True),
    ("fts", _LEXEMES, True),
    ("last_updated", _TIME, True),
)
FUNCTIONS = _fields(
    ("id", _LONG, False),
    ("file_id", _LONG, False),
    ("project_id", _LONG, False),
    ("name", _STRING, False),
    ("signature", _STRING, True),
    ("start_line", _INT, False),
    ("end_line", _INT, False),
    ("body", _STRING, False),
    ("checksum", _STRING, False),
    ("summary", _STRING, True),
    ("embedding", _VECTOR, True),
    ("fts", _LEXEMES, True),
    ("last_updated", _TIME, True),
)
POSTINGS = _fields(
    ("term", _STRING, True), ("id", _LONG, True), ("project_id", _LONG, True), ("positions", T.ArrayType(_INT), True)
)
#: Stored beside the columns of projects: the digest of the last scan that all tables agree with, and its time.
SCAN_STATE = _fields(("scan_digest", _STRING, True), ("scanned_at", _TIME, True))
TABLES = {"projects": PROJECTS, "files": FILES, "functions": FUNCTIONS}
UNIQUE_KEYS = {
    "projects": ["git_url"],
    "files": ["project_id", "path"],
    "functions": ["file_id", "start_line"],
}

SCAN = _fields(
    ("git_url", _STRING, False), ("path", _STRING, False), ("content", T.BinaryType(), False)
)
METADATA = _fields(
    ("git_url", _STRING, False), ("symbolic_ref", _STRING, True), ("remote_text", _STRING, True)
)
