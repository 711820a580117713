"""The functions table: extraction, delta, enrichment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.definitions import python_definitions_sql
from shelfmark.functions.fixed_values import DEFINITION_LANGUAGES
from shelfmark.functions.scripts import script_definitions_of
from shelfmark.functions.sqltext import let
from shelfmark.functions.text import ENGLISH, Analyzer, lexemes_sql
from shelfmark.operators.enrichment import Model, enrich, hashed_embedding, lead_summary
from shelfmark.operators.identity import highest_id, number_rows
from shelfmark.schemas import FUNCTIONS

KEY = ["file_id", "start_line"]
_CONTENT = ["name", "signature", "end_line", "body", "checksum"]


def supported(files: DataFrame) -> DataFrame:
    """Files in a language whose definitions are extracted."""
    return files.where(F.col("language").isin(*DEFINITION_LANGUAGES))


def extract_definitions(
    files: DataFrame, *keep: str, one_per_line: bool = False
) -> DataFrame:
    """One row per definition in ``files(file_id, language, body)``.

    Files are worked on where they are; nothing is shuffled. ``keep`` names
    further columns to carry along. With ``one_per_line`` only the last of
    several definitions on a line stays; they are neighbours in source order.
    """
    python = F.col("language") == "Python"
    script = F.when(~python, F.col("body"))  # Python files are not sent to the script scanner
    listed = supported(files).select(
        "file_id", *keep,
        F.when(python, F.expr(python_definitions_sql("body")))
        .otherwise(script_definitions_of(script, F.col("language"))).alias("_found"),
    )
    if one_per_line:
        listed = listed.withColumn("_found", F.expr(let(
            "every", "_found", "filter(every, (d, i) -> NOT get(every, i + 1).start_line <=> d.start_line)",
        )))
    # The outer form does not compute the array once more to filter by its size.
    return (
        listed.select("file_id", *keep, F.posexplode_outer("_found").alias("ordinal", "_d"))
        .where("ordinal IS NOT NULL")
        .select("file_id", *keep, "ordinal", "_d.*")
    )


def last_per_line(definitions: DataFrame) -> DataFrame:
    """Keep the last of several definitions that start on one line.

    The winner is found on the key and ordinal alone, with partial aggregation,
    so many copies of one key do not gather in one task.
    """
    winners = definitions.groupBy(*KEY).agg(F.max("ordinal").alias("ordinal"))
    return definitions.join(winners, [*KEY, "ordinal"], "left_semi")


def diff_functions(stored: DataFrame, definitions: DataFrame, scanned: DataFrame) -> DataFrame:
    """``(file_id, start_line, change)`` over the files in ``scanned(file_id)``.

    ``change`` is new, changed, unchanged or removed. Only keys and checksums
    are shuffled. ``definitions`` has one row per key.
    """
    old = (
        stored.select(*KEY, F.col("checksum").alias("_old"))
        .join(scanned.select("file_id").distinct(), "file_id", "left_semi")
    )
    new = definitions.select(*KEY, F.col("checksum").alias("_new"))
    return old.join(new, KEY, "full_outer").select(
        *KEY,
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") != F.col("_new"), "changed")
        .otherwise("unchanged")
        .alias("change"),
    )


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change").agg(F.count("*").alias("functions"))


def upserted_functions(
    old_ids: DataFrame, definitions: DataFrame, diff: DataFrame, after: Column | int, as_of: datetime,
    analyzer: Analyzer = ENGLISH,
) -> DataFrame:
    """The rows of new and changed functions.

    New ones get an id, counted on from ``after``; changed ones keep theirs, from
    ``old_ids (file_id, start_line, id)``, and lose summary and embedding.
    ``definitions`` also has ``project_id``.
    """
    new_ids = number_rows(diff.where(F.col("change") == "new").select(*KEY), KEY, "id", after)
    kept_ids = old_ids.select(*KEY, "id").join(
        diff.where(F.col("change") == "changed").select(*KEY), KEY, "left_semi"
    )
    written = definitions.join(new_ids.select(*KEY, "id").unionByName(kept_ids), KEY)
    return written.select(
        "id", "file_id", "project_id", "start_line", *_CONTENT,
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.expr(lexemes_sql("concat(name, ' ')", analyzer)).alias("fts"),
        F.lit(as_of).cast("timestamp").alias("last_updated"),
    ).select(*FUNCTIONS.fieldNames())


def carried_enrichment(old: DataFrame, new: DataFrame) -> DataFrame:
    """``file_id, start_line, summary, embedding, fts`` for functions that have only moved within their file.

    ``old`` are stored functions that go or change, ``new`` the definitions that
    come. Of equal bodies in a file, the first old one is matched with the first new
    one, and so on. Functions without a summary carry nothing.
    """
    place = F.row_number().over(Window.partitionBy("file_id", "checksum").orderBy("start_line"))
    before = old.select("file_id", "checksum", place.alias("_place"), "summary", "embedding", "fts")
    after = new.select("file_id", "checksum", "start_line", place.alias("_place"))
    return after.join(before.where("summary IS NOT NULL"), ["file_id", "checksum", "_place"]).select(
        *KEY, "summary", "embedding", "fts")


def with_carried(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """Function ``rows`` with what ``carried_enrichment`` found for them."""
    own = carried.select(*KEY, *[F.col(c).alias(f"_{c}") for c in ("summary", "embedding", "fts")], F.lit(True).alias("_moved"))
    joined = rows.join(own, KEY, "left")
    return joined.select(*[
        F.when(F.col("_moved"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in ("summary", "embedding", "fts") else c
        for c in rows.columns])


def apply_diff(
    stored: DataFrame,
    definitions: DataFrame,
    diff: DataFrame,
    as_of: datetime,
    analyzer: Analyzer = ENGLISH,
) -> DataFrame:
    """The next functions table: removed rows go, new and changed ones come, all others stay untouched."""
    gone = diff.where(F.col("change").isin("removed", "changed")).select(*KEY)
    kept = stored.join(gone, KEY, "left_anti").select(*FUNCTIONS.fieldNames())
    return kept.unionByName(
        upserted_functions(stored, definitions, diff, highest_id(stored), as_of, analyzer))


def _of_projects(rows: DataFrame, projects: DataFrame | None) -> DataFrame:
    """Rows of the given ``projects(id)``; of all where none are given."""
    if projects is None:
        return rows
    return rows.join(projects.select(F.col("id").alias("project_id")), "project_id", "left_semi")


def stale_functions(functions: DataFrame, files: DataFrame, projects: DataFrame | None = None) -> DataFrame:
    """Functions without a summary, with the path of their file, of the given ``projects(id)``."""
    return (
        _of_projects(functions.where(F.col("summary").isNull()), projects)
        .select("id", "file_id", "name", "body")
        .join(files.select(F.col("id").alias("file_id"), "path"), "file_id")
        .select("id", "path", "name", "body")
    )


def enrich_functions(
    functions: DataFrame,
    files: DataFrame,
    as_of: datetime,
    summarize: Model | None = None,
    embed: Model | None = None,
    analyzer: Analyzer = ENGLISH,
    projects: DataFrame | None = None,
) -> DataFrame:
    """Summarise and embed every function without a summary whose file exists.

    With ``projects(id)``, only functions of these. Only rows without a summary
    meet the files table; the others are passed through.
    """
    lacking = functions.where(F.col("summary").isNull())
    paths = _of_projects(files, projects).select(F.col("id").alias("file_id"), F.col("path").alias("_path"))
    enriched = enrich(
        lacking.join(paths, "file_id", "left"), F.col("_path").isNotNull(),
        ["_path", "name", "body"], "name", as_of,
        summarize or lead_summary(3), embed or hashed_embedding(), analyzer,
    )
    columns = functions.columns
    return functions.where(F.col("summary").isNotNull()).unionByName(enriched.select(*columns))
