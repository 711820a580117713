"""The files table: selection, upsert, staleness, enrichment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.content import checksum
from shelfmark.functions.naming import indexed_language
from shelfmark.functions.text import ENGLISH, Analyzer, lexemes_sql
from shelfmark.operators.enrichment import Model, enrich, hashed_embedding, lead_summary
from shelfmark.operators.identity import highest_id, number_rows
from shelfmark.operators.projects import indexable
from shelfmark.schemas import FILES

KEY = ["project_id", "path"]
SLOTS = 32


def files_for_language(listing: DataFrame, projects: DataFrame) -> DataFrame:
    """Rows of ``listing`` whose exact suffix belongs to their project's language.

    Adds ``project_id`` and ``language``. Suffixes without a language are
    filtered before the join. Each project is dealt to ``SLOTS`` keys, so that the
    rows of a very large repository don't meet in one task.
    """
    known = listing.withColumn("_language", indexed_language(F.col("path"))).where(
        F.col("_language").isNotNull()
    )
    owners = indexable(projects).select(
        F.col("git_url"), F.col("id").alias("project_id"), F.col("language"),
        F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("_slot"),
    )
    return (
        known.withColumn("_slot", F.pmod(F.hash("path"), F.lit(SLOTS))).join(owners, ["git_url", "_slot"])
        .where(F.col("_language") == F.col("language"))
        .drop("_language", "_slot")
    )


def scanned_keys(scan: DataFrame, projects: DataFrame) -> DataFrame:
    """``project_id, git_url, path, checksum`` of the files to index; contents stay where they are."""
    listing = scan.select("git_url", "path", checksum(F.col("content")).alias("checksum"))
    return files_for_language(listing, projects).select("project_id", "git_url", "path", "checksum")


def file_states(stored: DataFrame, keys: DataFrame, **flags: Column) -> DataFrame:
    """``project_id, path, id, state, checksum, old_checksum`` of stored and scanned files.

    ``state`` is new, changed, same, or missing for files that the scan lacks.
    Only keys and checksums are joined, with ``flags`` of the stored rows; further
    columns of ``keys`` are kept.
    """
    old = stored.select(*KEY, "id", F.col("checksum").alias("old_checksum"), *[c.alias(n) for n, c in flags.items()])
    return keys.withColumn("_seen", F.lit(True)).join(old, KEY, "full_outer").withColumn(
        "state",
        F.when(F.col("id").isNull(), "new").when(F.col("_seen").isNull(), "missing")
        .when(F.col("checksum").eqNullSafe(F.col("old_checksum")), "same").otherwise("changed"),
    ).drop("_seen")


def with_new_ids(states: DataFrame, after: Column | int) -> DataFrame:
    """``states`` with ids for new files, counted on from ``after``."""
    new = number_rows(states.where("state = 'new'").drop("id"), KEY, "id", after)
    return states.where("state <> 'new'").unionByName(new)


def differing_files(stored: DataFrame, contents: DataFrame, states: DataFrame, on: list[str], analyzer: Analyzer = ENGLISH) -> DataFrame:
    """New and changed files with their new body, and ``_scanned`` and ``_old_checksum``.

    ``states`` has ids; ``contents`` has ``body`` and the key columns ``on``. Only
    contents of differing keys are joined with anything: the second phase of the
    upsert, after ``file_states``. Of stored rows, bodies are not read.
    """
    wanted = states.where(F.col("state").isin("new", "changed")).select(
        *dict.fromkeys([*KEY, *on]), "id", "state", "checksum", F.col("old_checksum").alias("_old_checksum"))
    old = stored.select("id", "summary", "embedding", F.col("fts").alias("_fts"), "last_updated")
    path_only = F.expr(lexemes_sql("concat(path, ' ')", analyzer))
    return contents.select(*on, "body").join(wanted, on).join(old, "id", "left").withColumn(
        "fts", F.when(F.col("state") == "new", path_only).otherwise(F.col("_fts"))
    ).withColumn("_scanned", F.lit(True)).select(*FILES.fieldNames(), "_scanned", "_old_checksum")


def merge_files(
    stored: DataFrame, scanned: DataFrame, as_of: datetime, analyzer: Analyzer = ENGLISH
) -> DataFrame:
    """The next files table, with ``_scanned`` and ``_old_checksum`` per row.

    ``scanned`` has ``project_id, path, checksum, body``. Keys and checksums are
    joined first; bodies of files that stay the same are not compared or moved by
    key again: stored rows only meet the state of their id, scanned bodies the
    keys that differ.
    """
    states = with_new_ids(file_states(stored, scanned.select(*KEY, "checksum")), highest_id(stored))
    incoming = differing_files(stored, scanned, states, KEY, analyzer)
    now = F.lit(as_of).cast("timestamp")
    staying = stored.join(
        states.where("state <> 'new'").select("id", "state"), "id"
    ).where("state <> 'changed'").withColumn("_scanned", F.col("state") == "same").select(
        *[F.when(F.col("_scanned"), now).otherwise(F.col(c)).alias(c) if c == "last_updated" else c
          for c in FILES.fieldNames()],
        "_scanned", F.col("checksum").alias("_old_checksum"),
    )
    return incoming.withColumn("last_updated", now).unionByName(staying)


def upsert_files(
    stored: DataFrame, scanned: DataFrame, as_of: datetime, analyzer: Analyzer = ENGLISH
) -> DataFrame:
    """Insert or update scanned files; files not scanned stay."""
    return merge_files(stored, scanned, as_of, analyzer).select(*FILES.fieldNames())


def is_stale(strict_compat: bool = False) -> Column:
    """Flag on ``merge_files`` rows: scanned, and unknown, unsummarised or changed.

    With ``strict_compat`` the checksum is compared after the upsert, where it
    never differs, so only missing summaries count.
    """
    missing = F.col("summary").isNull()
    changed = ~F.col("_old_checksum").eqNullSafe(F.col("checksum"))
    return F.col("_scanned") & (missing if strict_compat else missing | changed)


def stale_files(stored: DataFrame, scanned: DataFrame, strict_compat: bool = False) -> DataFrame:
    """Keys of the scanned files that need a summary."""
    old = stored.select(*KEY, F.col("checksum").alias("_old_checksum"), "summary",
                        F.lit(True).alias("_known"))
    joined = scanned.select(*KEY, "checksum").join(old, KEY, "left")
    stale = F.col("_known").isNull() | F.col("summary").isNull()
    if not strict_compat:
        stale = stale | ~F.col("_old_checksum").eqNullSafe(F.col("checksum"))
    return joined.where(stale).select(*KEY)


def enrich_files(
    files: DataFrame,
    stale: Column,
    as_of: datetime,
    summarize: Model | None = None,
    embed: Model | None = None,
    analyzer: Analyzer = ENGLISH,
) -> DataFrame:
    """Summarise and embed the ``stale`` rows of ``files``."""
    return enrich(
        files, stale, ["path", "body"], "path", as_of,
        summarize or lead_summary(8), embed or hashed_embedding(), analyzer,
    )


def add_column(table: DataFrame, name: str, data_type: str) -> DataFrame:
    """Add a nullable column, NULL in all present rows."""
    return table if name in table.columns else table.withColumn(name, F.lit(None).cast(data_type))


def stored_lookup(files: DataFrame, paths: DataFrame) -> DataFrame:
    """``(project_id, path, id, checksum, summary)`` of the given keys."""
    return files.select(*KEY, "id", "checksum", "summary").join(
        paths.select(*KEY), KEY, "left_semi"
    )
