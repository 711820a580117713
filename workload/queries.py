"""One query per operator, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.functions.content import checksum, decode_lossy
from shelfmark.functions.naming import (
    counted_language,
    default_branch,
    path_suffix,
    repo_name,
)
from shelfmark.functions.sentences import lead_sentences
from shelfmark.functions.text import MARKUP, PLAIN
from shelfmark.functions.vectors import hashed_vector_sql
from shelfmark.operators import definitions as defs
from shelfmark.operators import files as file_ops
from shelfmark.operators import fulltext, identity, nearest, projects, ranking
from shelfmark.plans import search, table_functions
from shelfmark.plans.indexing import run_index
from shelfmark.session import shared_folder
from shelfmark.sources.repositories import scan_repositories
from shelfmark.sources.store import TableStore
from shelfmark.sources.tables import spread
from workload import corpus
from workload.corpus import AS_OF, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEARCH_TEXT = "attion anea"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _time(column: str = "last_updated"):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _vector_sum():
    """Weights of a new vector, each times its place, summed up; rows without one have none."""
    total = "aggregate(transform(embedding, (x, i) -> (i + 1) * cast(x AS double)), 0D, (s, x) -> s + x)"
    return F.expr(f"round({total}, 3)").alias("vector_sum")


# Sources and lookups


@query
def scan_folder(spark, folder):
    """Every document as a file under names that file sources skip, found again by its tracked path."""
    root = f"{shared_folder(spark)}/checkouts-{uuid.uuid4().hex}"
    documents = corpus.tracked_documents(table(spark, folder, "documents"))
    corpus.write_files(documents.unionByName(corpus.untracked(documents)), root)
    checkouts = documents.select("folder", "git_url").distinct()
    scan = scan_repositories(spark, root, checkouts, documents.select("git_url", "path"))
    return scan.select("git_url", "path", checksum(F.col("content")).alias("checksum"),
                       F.length("content").cast("long").alias("n_bytes"))


@query
def decode_lossy_text(spark, folder):
    raw = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.col("text").cast("binary"), F.lit(b"\xff"), F.col("source").cast("binary"))
        .alias("content")
    )
    return raw.select("doc_id", decode_lossy(F.col("content")).alias("body"))


@query
def scan_checksum(spark, folder):
    content = F.col("text").cast("binary")
    return table(spark, folder, "documents").select(
        "doc_id", checksum(content).alias("checksum"), decode_lossy(content).alias("body")
    )


@query
def stored_lookup(spark, folder):
    labelled = corpus.document_paths(
        table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left_semi")
    )
    return file_ops.stored_lookup(corpus.stored_files(spark, folder), labelled)


def _fill(store: TableStore, spark, folder, files: DataFrame) -> None:
    """A store of the given files, the turns as functions and the sources as projects."""
    run = store.begin(AS_OF)
    sources = table(spark, folder, "documents").select("source").distinct()
    run.replace("projects", sources.select(
        F.expr("cast(substr(source, 4) AS bigint)").alias("id"), F.col("source").alias("name"),
        F.col("source").alias("git_url"), F.lit(None).alias("language"),
        F.lit(None).alias("default_branch"), F.lit(None).alias("summary"),
        F.lit(None).alias("embedding"), F.lit(AS_OF).alias("last_updated"),
    ))
    run.replace("files", files)
    run.replace("functions", corpus.stored_functions(spark, folder))
    run.finish()


@query
def snapshot_roundtrip(spark, folder):
    """Write all three tables, read them back."""
    store = TableStore(spark, f"{shared_folder(spark)}/snapshot-{uuid.uuid4().hex}")
    _fill(store, spark, folder, corpus.stored_files(spark, folder))
    return (
        store.read("files").select(F.lit("files").alias("kind"), "id", "checksum")
        .unionByName(store.read("functions").select(F.lit("functions").alias("kind"), "id", "checksum"))
        .unionByName(store.read("projects").select(
            F.lit("projects").alias("kind"), "id", F.col("name").alias("checksum")))
    )


# Projects


@query
def repository_name(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", repo_name(F.col("url")).alias("name"),
        repo_name(F.concat("url", F.lit(".git///"))).alias("name_of_remote"),
    )


@query
def path_suffix_language(spark, folder):
    paths = corpus.document_paths(table(spark, folder, "documents")).select("path").unionByName(
        table(spark, folder, "pages").select(F.concat("url", F.lit(".PY")).alias("path"))
    ).unionByName(table(spark, folder, "pages").select(F.col("url").alias("path")))
    return paths.select(
        "path", path_suffix(F.col("path")).alias("suffix"),
        counted_language(F.col("path")).alias("language"),
    )


def _listing(spark, folder) -> DataFrame:
    documents = corpus.document_paths(table(spark, folder, "documents")).select("git_url", "path")
    pages = table(spark, folder, "pages").select(
        F.concat(F.substring_index("url", "/", 3), F.lit("/site.git")).alias("git_url"),
        F.expr("concat('page_', page_id, '.JS')").alias("path"),
    )
    events = table(spark, folder, "events").select(
        F.concat(F.lit("https://example.org/"), "event_type", F.lit(".git")).alias("git_url"),
        F.expr("concat(event_id, '.unknown')").alias("path"),
    )
    return documents.unionByName(pages).unionByName(events)


@query
def primary_language(spark, folder):
    return projects.primary_language(_listing(spark, folder))


def _metadata(spark, folder) -> DataFrame:
    return _listing(spark, folder).select("git_url").distinct().select(
        "git_url", F.lit("refs/remotes/origin/feature/x").alias("symbolic_ref"),
        F.lit(None).cast("string").alias("remote_text"),
    )


def _stored_projects(spark, folder) -> DataFrame:
    sources = table(spark, folder, "documents").select("source").distinct().select(
        F.expr("cast(substr(source, 4) AS bigint) + 1").alias("id"),
        F.concat(F.lit("https://example.org/"), "source", F.lit(".git")).alias("git_url"),
    )
    nations = table(spark, folder, "nation").select(
        F.expr("cast(n_nationkey AS bigint) + 1000000").alias("id"),
        F.concat(F.lit("https://example.org/"), "n_name", F.lit(".git")).alias("git_url"),
    )
    return sources.unionByName(nations).select(
        "id", F.lit("old name").alias("name"), "git_url", F.lit("C").alias("language"),
        F.lit("trunk").alias("default_branch"), F.lit("kept").alias("summary"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.lit(corpus.EARLIER).cast("timestamp").alias("last_updated"),
    )


@query
def register_projects(spark, folder):
    registered = projects.register_projects(
        _stored_projects(spark, folder), _metadata(spark, folder), _listing(spark, folder), AS_OF
    )
    return registered.select(
        "id", "name", "git_url", "language", "default_branch", "summary", _time()
    )


@query
def skip_unknown_language(spark, folder):
    registered = projects.register_projects(
        _stored_projects(spark, folder), _metadata(spark, folder), _listing(spark, folder), AS_OF
    )
    return projects.indexable(registered).select("git_url", "language")


@query
def default_branch_name(spark, folder):
    refs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("refs/remotes/origin/"), "lang").alias("ref"),
        F.lit(None).cast("string").alias("text"),
    )
    texts = table(spark, folder, "conversations").select(
        F.expr("-1 - (conv_id * 1000 + turn)").alias("id"), F.lit(None).cast("string").alias("ref"),
        F.expr("concat('* remote origin\\n  HEAD branch: ', role, '\\n  Remote branches:\\n')").alias("text"),
    )
    return refs.unionByName(texts).select(
        "id", default_branch(F.col("ref"), F.col("text")).alias("branch")
    )


@query
def files_for_language(spark, folder):
    languages = projects.primary_language(_listing(spark, folder))
    owned = languages.select(F.md5("git_url").alias("id"), "git_url", "language")
    return file_ops.files_for_language(_listing(spark, folder), owned).select("path", "language")


@query
def cascade_delete(spark, folder):
    """Fill a store, delete the projects of toxic documents in it, read it back."""
    store = TableStore(spark, f"{shared_folder(spark)}/deleted-{uuid.uuid4().hex}")
    files = corpus.files(spark, folder).withColumn("last_updated", F.lit(AS_OF).cast("timestamp"))
    _fill(store, spark, folder, files)
    removed = corpus.document_paths(
        table(spark, folder, "documents")
        .join(table(spark, folder, "labels").where("toxic = 1"), "doc_id", "left_semi")
    ).select(F.col("project_id").alias("id")).distinct()
    store.delete_projects(removed, AS_OF)
    first, second, third = (
        store.read(kind).select(F.lit(kind).alias("kind"), "id") for kind in ("projects", "files", "functions")
    )
    return first.unionByName(second).unionByName(third)


def _edited_few(spark, folder) -> DataFrame:
    """Documents as files of their projects with a new ``text`` of a few: toxic ones of low quality."""
    few = table(spark, folder, "labels").where("toxic = 1 AND quality = 0").select("doc_id").distinct()
    return corpus.document_paths(table(spark, folder, "documents")).join(
        few.withColumn("_few", F.lit(True)), "doc_id", "left"
    ).withColumn("new_text", F.when(F.col("_few"), F.concat(F.lit("Edited. "), "text")).otherwise(F.col("text")))


@query
def unchanged_projects(spark, folder):
    """Projects whose scan has the digest of the one before, with the number of their files."""
    edited = _edited_few(spark, folder)
    before, now = (
        projects.project_digests(edited.select("project_id", "path", checksum(F.col(text)).alias("checksum")))
        for text in ("text", "new_text"))
    return projects.unchanged_projects(before, now).join(now.select("project_id", "files"), "project_id")


# Files


@query
def upsert_files(spark, folder):
    return file_ops.upsert_files(
        corpus.stored_files(spark, folder), corpus.scanned_files(spark, folder), AS_OF, PLAIN
    ).select("id", "project_id", "path", "checksum", "body", "summary", _time())


@query
def stale_files(spark, folder):
    return file_ops.stale_files(
        corpus.stored_files(spark, folder), corpus.scanned_files(spark, folder)
    )


@query
def stale_files_compat(spark, folder):
    return file_ops.stale_files(
        corpus.stored_files(spark, folder), corpus.scanned_files(spark, folder), strict_compat=True
    )


@query
def enrich_files(spark, folder):
    merged = file_ops.merge_files(
        corpus.stored_files(spark, folder), corpus.scanned_files(spark, folder), AS_OF, PLAIN
    )
    return file_ops.enrich_files(merged, file_ops.is_stale(), AS_OF, analyzer=PLAIN).select(
        "path", "summary", F.array_join("fts", " ").alias("fts"),
        _vector_sum(), _time(),
    )


@query
def fts_files(spark, folder):
    return fulltext.terms(corpus.files(spark, folder), "id")


@query
def fts_functions(spark, folder):
    return fulltext.terms(corpus.stored_functions(spark, folder), "id")


@query
def add_body_column(spark, folder):
    old = corpus.files(spark, folder).select("id", "path")
    added = file_ops.add_column(old, "body", "string")
    return added.unionByName(
        corpus.stored_files(spark, folder).select("id", "path", "body")
    )


# Functions


@query
def diff_functions(spark, folder):
    return defs.diff_functions(
        corpus.stored_functions(spark, folder), corpus.extracted_functions(spark, folder),
        corpus.changed_talks(spark, folder),
    )


@query
def diff_counts(spark, folder):
    return defs.diff_counts(diff_functions(spark, folder))


@query
def apply_functions(spark, folder):
    stored = corpus.stored_functions(spark, folder)
    extracted = corpus.extracted_functions(spark, folder)
    diff = defs.diff_functions(stored, extracted, corpus.changed_talks(spark, folder))
    return defs.apply_diff(stored, extracted, diff, AS_OF, PLAIN).select(
        "id", "file_id", "start_line", "name", "signature", "end_line", "checksum", "summary",
        F.array_join("fts", " ").alias("fts"), _time(),
    )


@query
def carried_enrichment(spark, folder):
    """What functions keep that have moved: a line is added on top, some have gone, some stand there twice."""
    old = corpus.stored_functions(spark, folder)
    new = old.where("name NOT LIKE 'system%'").withColumn("start_line", F.col("start_line") + 1).union(
        old.where("name LIKE 'user%'").withColumn("start_line", F.col("start_line") + 101))
    return defs.carried_enrichment(old, new).select("file_id", "start_line", "summary", F.array_join("fts", " ").alias("fts"))


@query
def dedup_same_line(spark, folder):
    found = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("file_id"), F.expr("cast(turn DIV 2 AS int)").alias("start_line"),
        F.col("turn").cast("int").alias("ordinal"), F.col("text").alias("body"),
    )
    return defs.last_per_line(found)


@query
def language_gate(spark, folder):
    rows = corpus.document_paths(table(spark, folder, "documents")).select(
        F.col("doc_id").alias("file_id"), counted_language(F.col("path")).alias("language")
    )
    return defs.supported(rows)


def _half_summarised(spark, folder) -> DataFrame:
    """Stored functions where only the users' turns have a summary."""
    return corpus.stored_functions(spark, folder).withColumn(
        "summary", F.when(F.col("name").startswith("user"), F.col("summary"))
    )


@query
def stale_functions(spark, folder):
    return defs.stale_functions(_half_summarised(spark, folder), corpus.files(spark, folder))


@query
def enrich_functions(spark, folder):
    functions = _half_summarised(spark, folder)
    return defs.enrich_functions(functions, corpus.files(spark, folder), AS_OF, analyzer=PLAIN).select(
        "id", "summary", F.array_join("fts", " ").alias("fts"), _vector_sum(), _time()
    )


@query
def duplicate_keys(spark, folder):
    return identity.duplicate_keys(
        table(spark, folder, "documents").select(checksum(F.col("text")).alias("checksum")),
        ["checksum"],
    )


@query
def assign_ids(spark, folder):
    return identity.number_rows(
        corpus.document_paths(table(spark, folder, "documents")).select("path"), ["path"], "id", 7
    )


@query
def extract_definitions(spark, folder):
    return defs.extract_definitions(corpus.source_files(spark, folder)).select(
        "file_id", "ordinal", "name", "signature", "start_line", "end_line", "body", "checksum"
    )


@query
def indexed_functions(spark, folder):
    """Two indexing runs over all documents, the second with edited files."""
    store = TableStore(spark, f"{shared_folder(spark)}/indexed-{uuid.uuid4().hex}")
    for as_of, edited in ((corpus.EARLIER, False), (AS_OF, True)):
        scan = corpus.repository_scan(spark, folder, edited)
        metadata = table(spark, folder, "documents").select("source").distinct().select(
            F.concat(F.lit("https://example.org/"), "source", F.lit(".git")).alias("git_url"),
            F.lit("refs/remotes/origin/main").alias("symbolic_ref"),
            F.lit(None).cast("string").alias("remote_text"),
        )
        run_index(store, scan, metadata, as_of, analyzer=PLAIN)
    paths = store.read("files").select(F.col("id").alias("file_id"), "path")
    return store.read("functions").join(paths, "file_id").select(
        "path", "name", "start_line", "end_line", "checksum", _time()
    )


# Models


@query
def summarize_lead(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", lead_sentences(text, 8).alias("file_summary"),
        lead_sentences(text, 3).alias("function_summary"),
    )


def _vector_rows(rows: DataFrame, key: str) -> DataFrame:
    vectors = rows.select(key, F.expr(hashed_vector_sql("text", 64)).alias("vector"))
    return vectors.select(key, F.posexplode_outer("vector").alias("bucket", "weight")).select(
        key, "bucket", F.round(F.col("weight").cast("double"), 5).alias("weight")
    )


@query
def embed_hashing(spark, folder):
    return _vector_rows(spread(table(spark, folder, "documents")), "doc_id")


@query
def query_embedding(spark, folder):
    return _vector_rows(table(spark, folder, "benchmark"), "item_id")


# Full text


def _stored_texts(spark, folder) -> DataFrame:
    return corpus.stored(spark, folder, "texts", corpus.texts)


def _stored_files(spark, folder) -> DataFrame:
    return corpus.stored(spark, folder, "files", corpus.searchable_files, by="project_id")


@query
def analyze_terms(spark, folder):
    return fulltext.terms(corpus.texts(spark, folder), "id")


@query
def analyze_terms_markup(spark, folder):
    """Whole pages with their addresses: tags and entities are no words, URLs come with host and path."""
    pages = spread(table(spark, folder, "pages"))
    rows = pages.select(F.col("page_id").alias("id"), F.concat(
        F.coalesce("url", F.lit("")), F.lit(" "), F.coalesce("html", F.lit(""))).alias("text"))
    return fulltext.terms(fulltext.analyze(rows, "text", MARKUP), "id")


@query
def analyze_terms_english(spark, folder):
    """The default analyzer over all documents with their paths."""
    documents = corpus.document_paths(spread(table(spark, folder, "documents")))
    rows = documents.select(F.col("doc_id").alias("id"), F.concat("path", F.lit(" "), "text").alias("text"))
    return fulltext.terms(fulltext.analyze(rows, "text"), "id")


@query
def postings(spark, folder):
    index = fulltext.cluster_postings(fulltext.postings(corpus.texts(spark, folder)))
    return index.withColumn("positions", F.array_join("positions", ","))


@query
def postings_after_change(spark, folder):
    """Postings of all texts in a store, kept up after edits: good documents changed, toxic ones taken out."""
    store = TableStore(spark, f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}")
    old = _stored_texts(spark, folder)
    run = store.begin(AS_OF)
    run.replace("file_postings", fulltext.postings(old))
    labels = table(spark, folder, "labels")
    good = identity.few_ids(labels.where("quality = 1 AND toxic = 0").select("doc_id"))
    edited = corpus.document_paths(
        table(spark, folder, "documents").join(good, "doc_id", "left_semi")
    ).select(F.col("doc_id").alias("id"), "project_id", F.concat("text", F.lit(" Edited tion")).alias("text"))
    new = fulltext.analyze(edited, "text", PLAIN)
    gone = identity.few_ids(labels.where("quality = 1 OR toxic = 1").select(F.col("doc_id").alias("id")))
    moved = run.set_aside("moves", fulltext.changed_postings(old.join(gone, "id", "left_semi"), new))
    run.update("file_postings", moved.where("comes"), moved.where("NOT comes"))
    run.finish()
    return store.read("file_postings").drop("bucket").withColumn("positions", F.array_join("positions", ","))


@query
def web_query(spark, folder):
    words = F.expr("regexp_extract_all(lower(text), r'[\\p{L}\\p{N}]+', 0)")
    first, second, third = (f"coalesce(get(w, {i}), '')" for i in range(3))
    queries = table(spark, folder, "benchmark").withColumn("w", words).select(
        "item_id",
        F.expr(f"concat(array_join(w, ' '), ' \"', {first}, ' ', {second}, '\" -', {third})").alias("query_text"),
    )
    return fulltext.query_clauses(
        fulltext.parse_queries(queries, "query_text", PLAIN), "item_id"
    )


@query
def web_query_compound(spark, folder):
    """Words joined by underscore and hyphen are phrases, negated ones too."""
    words = F.expr("regexp_extract_all(lower(text), r'[\\p{L}\\p{N}]+', 0)")
    w = [f"coalesce(get(w, {i}), '')" for i in range(4)]
    queries = table(spark, folder, "benchmark").withColumn("w", words).select("item_id", F.expr(
        f"concat({w[0]}, '_', {w[1]}, ' ', {w[2]}, '-', {w[3]}, ' -', {w[0]}, '_', {w[2]})").alias("query_text"))
    return fulltext.query_clauses(fulltext.parse_queries(queries, "query_text", PLAIN), "item_id")


def _scores(spark, folder, text: str) -> DataFrame:
    parsed = fulltext.web_query(spark, text, PLAIN)
    return fulltext.keyword_scores(_stored_texts(spark, folder), parsed).select(
        "id", F.round("score", 6).alias("score")
    )


@query
def keyword_match_and(spark, folder):
    return _scores(spark, folder, "tion thre")


@query
def keyword_match_or(spark, folder):
    return _scores(spark, folder, "tion or thre")


@query
def keyword_match_not(spark, folder):
    return _scores(spark, folder, "tion -thre")


@query
def keyword_match_phrase(spark, folder):
    return _scores(spark, folder, '"anea eriner"')


@query
def cover_density_rank(spark, folder):
    return _scores(spark, folder, "tion thre ther")


@query
def cover_density_exclusion(spark, folder):
    """An alternative that excludes a word, beside another one."""
    return _scores(spark, folder, "tion thre -ther or ble -ing")


@query
def keyword_topk(spark, folder):
    parsed = fulltext.web_query(spark, "tion thre", PLAIN)
    scores = fulltext.keyword_scores(_stored_texts(spark, folder), parsed)
    return ranking.keyword_topk(scores, 20).select("id", "rank")


@query
def keyword_topk_bounded(spark, folder):
    """The same rows, where only rows are scored whose bound reaches the best of a first pass."""
    parsed = fulltext.web_query(spark, "tion thre", PLAIN)
    index = corpus.stored(spark, folder, "text_postings", corpus.text_postings)
    scores = fulltext.keyword_scores_of_top(index, parsed, 20)
    return ranking.keyword_topk(scores, 20).select("id", "rank")


@query
def keyword_topk_postings(spark, folder):
    parsed = fulltext.web_query(spark, "tion thre", PLAIN)
    index = corpus.stored(spark, folder, "text_postings", corpus.text_postings)
    scores = fulltext.keyword_scores_from_postings(index, parsed)
    return ranking.keyword_topk(scores, 20).select("id", "rank")


# Vectors, fusion, search


@query
def cosine_distance(spark, folder):
    rows = _stored_files(spark, folder).select("id", "embedding")
    return ranking.distances(rows, corpus.query_vector(spark, folder)).select(
        "id", F.round("distance", 6).alias("distance")
    )


@query
def vectors_present(spark, folder):
    return ranking.vectors_present(_stored_files(spark, folder)).select("id")


@query
def semantic_topk(spark, folder):
    rows = _stored_files(spark, folder).select("id", "embedding")
    return ranking.semantic_topk(rows, corpus.query_vector(spark, folder), 20).select("id", "rank")


@query
def semantic_topk_pruned(spark, folder):
    """The same from vectors stored in groups around pivots."""
    place = f"{shared_folder(spark)}/groups-{uuid.uuid4().hex}"
    nearest.write_groups(_stored_files(spark, folder).select("id", "embedding"), place)
    return nearest.semantic_topk_pruned(spark, place, corpus.query_vector(spark, folder), 20).rows.select("id", "rank")


def _fused(spark, folder) -> DataFrame:
    files = _stored_files(spark, folder)
    parsed = fulltext.web_query(spark, SEARCH_TEXT, PLAIN)
    return ranking.fuse(
        ranking.semantic_topk(files, corpus.query_vector(spark, folder), 20),
        ranking.keyword_topk(fulltext.keyword_scores(files, parsed), 20),
    )


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rrf_score", F.round("rrf_score", 9))


@query
def rrf_fusion(spark, folder):
    return _rounded(_fused(spark, folder))


@query
def fused_topk(spark, folder):
    return _rounded(ranking.best_fused(_fused(spark, folder), 10))


def _stored_functions(spark, folder) -> DataFrame:
    return corpus.stored(spark, folder, "functions", corpus.searchable_functions, by="project_id")


def _search_files(spark, folder, **options) -> DataFrame:
    return search.hybrid_search_files(
        _stored_files(spark, folder), corpus.query_vector(spark, folder), SEARCH_TEXT,
        analyzer=PLAIN, **options,
    )


@query
def hybrid_search_files(spark, folder):
    return _rounded(_search_files(spark, folder))


@query
def hybrid_search_files_project(spark, folder):
    return _rounded(_search_files(spark, folder, p_project_id=3, match_count=5, rrf_k=10))


@query
def hybrid_search_files_file(spark, folder):
    return _rounded(_search_files(spark, folder, p_file_id=0))


@query
def hybrid_search_functions(spark, folder):
    return _rounded(search.hybrid_search_functions(
        _stored_functions(spark, folder), _stored_files(spark, folder),
        corpus.query_vector(spark, folder), "tion or erin", analyzer=PLAIN,
    ))


@query
def sql_table_function(spark, folder):
    _stored_files(spark, folder).createOrReplaceTempView("shelfmark_files")
    table_functions.create_file_search(
        spark, "hybrid_search_files", "shelfmark_files", analyzer=PLAIN
    )
    return _rounded(table_functions.call(
        spark, "hybrid_search_files", corpus.query_vector(spark, folder), SEARCH_TEXT
    ))


@query
def sql_table_function_functions(spark, folder):
    _stored_files(spark, folder).createOrReplaceTempView("shelfmark_files")
    _stored_functions(spark, folder).createOrReplaceTempView("shelfmark_functions")
    table_functions.create_function_search(
        spark, "hybrid_search_functions", "shelfmark_functions", "shelfmark_files", analyzer=PLAIN
    )
    return _rounded(table_functions.call(
        spark, "hybrid_search_functions", corpus.query_vector(spark, folder), "tion or erin",
        match_count=5,
    ))


@query
def format_results(spark, folder):
    return search.format_results(_search_files(spark, folder))
