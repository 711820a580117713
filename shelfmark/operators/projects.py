"""Projects: primary language and registration."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.naming import counted_language, default_branch, repo_name
from shelfmark.operators.identity import highest_id, number_rows


def primary_language(listing: DataFrame) -> DataFrame:
    """``(git_url, language)``: the language with most files per repository.

    ``listing`` has ``git_url, path``. A tie goes to the language whose first
    path comes first. Repositories without a known suffix have no row.
    """
    counted = (
        listing.select("git_url", "path", counted_language(F.col("path")).alias("language"))
        .where(F.col("language").isNotNull())
        .groupBy("git_url", "language")
        .agg(F.count("*").alias("files"), F.min("path").alias("first_path"))
    )
    return counted.groupBy("git_url").agg(
        F.min_by("language", F.struct(-F.col("files"), F.col("first_path"))).alias("language")
    )


def register_projects(
    stored: DataFrame, metadata: DataFrame, listing: DataFrame, as_of: datetime
) -> DataFrame:
    """The next ``projects`` table after registering ``metadata``'s repositories.

    A known ``git_url`` keeps id, summary and embedding; its language may
    become NULL. Unmentioned projects stay as they are.
    """
    described = metadata.select(
        "git_url",
        repo_name(F.col("git_url")).alias("name"),
        default_branch(F.col("symbolic_ref"), F.col("remote_text")).alias("default_branch"),
    ).join(primary_language(listing), "git_url", "left")
    new_keys = metadata.select("git_url").join(stored.select("git_url"), "git_url", "left_anti")
    new_ids = number_rows(new_keys, ["git_url"], "new_id", highest_id(stored))
    incoming = described.join(new_ids, "git_url", "left").withColumn("_seen", F.lit(True)).alias("n")
    seen = F.col("n._seen").isNotNull()

    def latest(column: str):
        return F.when(seen, F.col(f"n.{column}")).otherwise(F.col(f"o.{column}")).alias(column)

    return stored.alias("o").join(incoming, F.expr("o.git_url = n.git_url"), "full_outer").select(
        F.coalesce("o.id", "n.new_id").alias("id"),
        latest("name"),
        F.coalesce("o.git_url", "n.git_url").alias("git_url"),
        latest("language"),
        latest("default_branch"),
        F.col("o.summary").alias("summary"),
        F.col("o.embedding").alias("embedding"),
        F.when(seen, F.lit(as_of)).otherwise(F.col("o.last_updated")).cast("timestamp")
        .alias("last_updated"),
    )


def project_digests(keys: DataFrame) -> DataFrame:
    """``project_id, digest, files`` of the scanned ``keys (project_id, path, checksum)``.

    The digest doesn't depend on the order of files: their number, and the sum of
    their hashes, added up by partial aggregation.
    """
    total = F.sum(F.xxhash64("path", "checksum").cast("decimal(38,0)"))
    return keys.groupBy("project_id").agg(
        F.concat_ws(":", F.count("*").cast("string"), total.cast("string")).alias("digest"), F.count("*").alias("files"))


#: Digest of a project without scanned files.
NO_FILES = "0:0"


def unchanged_projects(stored: DataFrame, scanned: DataFrame) -> DataFrame:
    """``project_id, unchanged`` of the projects in ``scanned (project_id, digest)``.

    ``stored`` has ``project_id, digest`` of the last scan that all tables agree
    with; a project without one has changed.
    """
    before = stored.select("project_id", F.col("digest").alias("_before"))
    return scanned.join(before, "project_id", "left").select(
        "project_id", F.coalesce(F.col("digest") == F.col("_before"), F.lit(False)).alias("unchanged"))


def indexable(projects: DataFrame) -> DataFrame:
    """Projects that have a language; the others are registered only."""
    return projects.where(F.col("language").isNotNull())


def delete_projects(
    projects: DataFrame, files: DataFrame, functions: DataFrame, removed: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop the projects in ``removed(id)`` with their files and functions."""
    gone = removed.select(F.col("id").alias("_gone"))
    kept_files = files.join(gone, F.col("project_id") == F.col("_gone"), "left_anti")
    gone_files = (
        files.join(gone, F.col("project_id") == F.col("_gone"), "left_semi")
        .select(F.col("id").alias("_gone_file"))
    )
    return (
        projects.join(gone, F.col("id") == F.col("_gone"), "left_anti"),
        kept_files,
        functions.join(gone_files, F.col("file_id") == F.col("_gone_file"), "left_anti"),
    )
