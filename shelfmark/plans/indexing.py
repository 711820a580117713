"""One indexing run over any number of repositories."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.content import decode_lossy
from shelfmark.functions.naming import indexed_language
from shelfmark.functions.text import ENGLISH, Analyzer
from shelfmark.operators.definitions import (
    carried_enrichment,
    diff_counts,
    diff_functions,
    enrich_functions,
    extract_definitions,
    supported,
    upserted_functions,
    with_carried,
)
from shelfmark.operators.enrichment import Model
from shelfmark.operators.files import (
    differing_files,
    enrich_files,
    file_states,
    is_stale,
    scanned_keys,
    with_new_ids,
)
from shelfmark.operators.fulltext import changed_postings
from shelfmark.operators.identity import check_unique, few_ids, highest_id
from shelfmark.operators.projects import (
    NO_FILES,
    indexable,
    project_digests,
    register_projects,
    unchanged_projects,
)
from shelfmark.schemas import FILES, FUNCTIONS, UNIQUE_KEYS
from shelfmark.sources.store import POSTINGS, Run, TableStore


@dataclass(frozen=True)
class Report:
    version: int
    changes: dict[str, int]  # functions per kind of change, in changed files

    @property
    def upserted(self) -> int:
        return self.changes.get("new", 0) + self.changes.get("changed", 0)

    @property
    def deleted(self) -> int:
        return self.changes.get("removed", 0)


@dataclass(frozen=True)
class Models:
    summarize_file: Model | None = None
    summarize_function: Model | None = None
    embed: Model | None = None
    analyzer: Analyzer = ENGLISH


def run_index(
    store: TableStore,
    scan: DataFrame,
    metadata: DataFrame,
    as_of: datetime,
    *,
    strict_compat: bool = False,
    summarize_file: Model | None = None,
    summarize_function: Model | None = None,
    embed: Model | None = None,
    analyzer: Analyzer = ENGLISH,
    with_postings: bool = False,
    carry_enrichment: bool = False,
) -> Report:
    """Register, scan, enrich, extract and store what has changed.

    ``scan`` has ``git_url, path, content``, unique per ``git_url, path``;
    ``metadata`` has ``git_url, symbolic_ref, remote_text``. A project whose scan
    has the digest of its last one is not looked at further: neither its files nor
    its functions are read. Of the others, keys and checksums are compared first
    and contents are read again for files that differ. Postings that a store has
    are kept up in every run. With ``carry_enrichment`` a function that has only moved
    within its file keeps summary and embedding.
    """
    models = Models(summarize_file, summarize_function, embed, analyzer)
    run = store.begin(as_of)
    registered = store.rows("projects")
    projects = run.set_aside(
        "projects", register_projects(registered, metadata, scan.select("git_url", "path"), as_of)
        .join(metadata.select("git_url"), "git_url", "left_semi"))
    keys = run.set_aside("keys", scanned_keys(scan, projects))
    digests = projects.select(F.col("id").alias("project_id")).join(project_digests(keys), "project_id", "left").select(
        "project_id", F.coalesce("digest", F.lit(NO_FILES)).alias("digest"))
    before = registered.select(
        F.col("id").alias("project_id"), F.col("scan_digest").alias("digest"), F.col("scanned_at").alias("_before"))
    compared = run.set_aside("compared", unchanged_projects(before, digests).join(digests, "project_id").join(
        before.select("project_id", "_before"), "project_id", "left"))
    differing = compared.where(~F.col("unchanged"))
    posted = {name: store.exists(name) and not run.broken_off for name in POSTINGS}
    changes, lacking = {}, None
    if not differing.isEmpty():
        changes, lacking = _index_projects(run, scan, projects, keys, differing, posted, strict_compat, carry_enrichment, models)
    for name in POSTINGS:
        if not posted[name] and (with_postings or store.exists(name)):
            run.build_postings(name)
    done = projects.join(
        compared.select(F.col("project_id").alias("id"), F.col("digest").alias("scan_digest")), "id"
    ).withColumn("scanned_at", F.lit(as_of).cast("timestamp"))
    if lacking is not None:  # a project that still lacks summaries is looked at again by the next run
        done = done.join(lacking.withColumn("_lacking", F.lit(True)), "id", "left").withColumn(
            "scan_digest", F.when(F.col("_lacking").isNull(), F.col("scan_digest"))).drop("_lacking")
    run.update("projects", done)
    return Report(run.finish(), changes)


def _index_projects(
    run: Run, scan: DataFrame, projects: DataFrame, keys: DataFrame, differing: DataFrame,
    posted: dict[str, bool], strict_compat: bool, carry: bool, models: Models,
) -> tuple[dict[str, int], DataFrame]:
    """Bring the ``differing (project_id, _before)`` projects up to date.

    Returns functions per kind of change, and ``id`` of the projects in which
    summaries are still lacking.
    """
    store = run.store
    scope = differing.select("project_id", "_before")
    files = store.rows("files").join(scope, "project_id")
    compared = file_states(files, keys.join(scope, "project_id", "left_semi"), bare=F.col("summary").isNull(),
                           timed=F.col("last_updated").isNotNull())
    # Besides new and changed files: those that still lack a summary, are back in the scan, or have gone from it.
    concerned = compared.where("CASE state WHEN 'same' THEN bare OR timed WHEN 'missing' THEN NOT timed ELSE true END")
    states = run.set_aside("states", with_new_ids(concerned, highest_id(store.rows("files"))))
    check_unique(states, UNIQUE_KEYS["files"])

    stored = files.select(
        *FILES.fieldNames(), "_before", "bucket").withColumnRenamed("project_id", "_project").drop("path", "checksum")
    # Contents and stored rows that don't matter stay where they lie: hashes of keys, and ids, thin them out first.
    differ, stay = states.where(F.col("state").isin("new", "changed")), states.where(F.col("state").isin("same", "missing"))
    place = F.xxhash64("git_url", "path").alias("_place")
    contents = scan.select("git_url", "path", "content", place).join(
        few_ids(differ.select(place)), "_place", "left_semi"
    ).select("git_url", "path", decode_lossy(F.col("content")).alias("body"))
    known = store.rows("files").join(few_ids(differ.where("state = 'changed'").select("id")), "id", "left_semi")
    incoming = differing_files(known, contents, states, ["git_url", "path"], models.analyzer).withColumn("_differs", F.lit(True))
    staying = stored.join(few_ids(stay.select("id")), "id", "left_semi").join(
        stay.select("id", "path", "checksum", "old_checksum", "state"), "id"
    ).withColumn("_scanned", F.col("state") == "same").withColumn("last_updated", F.when(~F.col("_scanned"), F.coalesce("last_updated", "_before"))).select(
        "id", F.col("_project").alias("project_id"), "path", F.col("old_checksum").alias("checksum"), "body", "summary",
        "embedding", "fts", "last_updated", "_scanned", F.col("old_checksum").alias("_old_checksum"), F.lit(False).alias("_differs"))
    enriched = enrich_files(
        incoming.unionByName(staying), is_stale(strict_compat), run.as_of, models.summarize_file, models.embed,
        models.analyzer)
    # The time of a file that was scanned is its project's.
    changed_files = run.set_aside("changed_files", enriched.withColumn(
        "last_updated", F.when(~F.col("_scanned"), F.col("last_updated"))))

    # Equal file text has equal definitions, so only new and changed files are looked into.
    touched = differ.select(F.col("id").alias("file_id"))
    sources = changed_files.where("_differs")
    definitions = run.set_aside("definitions", extract_definitions(
        supported(sources.withColumn("language", indexed_language(F.col("path")))).select(
            F.col("id").alias("file_id"), "project_id", "body", "language"),
        "project_id", one_per_line=True,
    ))
    near = store.of_buckets("functions", store.touched("functions", touched))
    old_functions = near.select("id", "file_id", "project_id", "start_line", "checksum", "summary", "embedding", "fts").join(
        touched, "file_id", "left_semi")
    diff = run.set_aside("diff", diff_functions(old_functions, definitions, touched))
    going = run.set_aside("going_functions", old_functions.join(
        diff.where(F.col("change").isin("removed", "changed")), ["file_id", "start_line"]))
    removed = going.where("change = 'removed'")
    coming = upserted_functions(
        going, definitions, diff, highest_id(store.rows("functions")), run.as_of, models.analyzer)
    if carry:
        coming = with_carried(coming, carried_enrichment(
            going, definitions.join(diff.where(F.col("change").isin("new", "changed")), ["file_id", "start_line"])))
    # Functions that an earlier run left without a summary.
    left = store.rows("functions").where(F.col("summary").isNull()).join(scope, "project_id", "left_semi").join(
        going.select("id"), "id", "left_anti").select(*FUNCTIONS.fieldNames())
    owners = store.rows("files").select("id", "project_id", "path").unionByName(
        states.where("state = 'new'").select("id", "project_id", "path"))
    changed_functions = run.set_aside("changed_functions", enrich_functions(
        coming.unionByName(left), owners, run.as_of, models.summarize_function, models.embed, models.analyzer,
        indexable(projects)))

    of_file = changed_files.select("id"), states.limit(0).select("id")
    of_function = changed_functions.select("id", "file_id"), removed.select("id", "file_id")
    replaced = {"file_postings": (changed_files, of_file), "function_postings": (changed_functions, of_function)}
    moves = {}
    for name, kept_up in posted.items():
        if kept_up:
            new, ids = replaced[name]
            old = _stored_fts(store, POSTINGS[name], ids[0].union(ids[1]))
            moves[name] = run.set_aside(f"{name}_moves", changed_postings(old, new))
    for name, moved in moves.items():
        run.update(name, moved.where("comes"), moved.where("NOT comes"))
    run.update("functions", changed_functions, removed)
    run.update("files", changed_files.select(*FILES.fieldNames()))

    bare = F.col("summary").isNull()
    lacking = changed_files.where(F.col("_scanned") & bare).select("project_id").union(
        changed_functions.where(bare).select("project_id")).distinct()
    changes = {row["change"]: row["functions"] for row in diff_counts(diff).collect()}
    return changes, lacking.select(F.col("project_id").alias("id"))


def _stored_fts(store: TableStore, table: str, ids: DataFrame) -> DataFrame:
    """``id, project_id, fts`` of the stored rows that are replaced or removed."""
    near = store.of_buckets(table, store.touched(table, ids))
    return near.select("id", "project_id", "fts").join(ids.select("id"), "id", "left_semi")
