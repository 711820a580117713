"""The given tables seen as projects, files and functions. Whole tables only."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.functions.content import checksum
from shelfmark.functions.sentences import lead_sentences
from shelfmark.functions.text import PLAIN
from shelfmark.operators.fulltext import analyze, cluster_postings, postings
from shelfmark.operators.identity import few_ids
from shelfmark.session import shared_folder
from shelfmark.sources.store import clustered, write_table
from shelfmark.sources.tables import read_table, spread

AS_OF = datetime(2024, 1, 1)
EARLIER = datetime(2023, 1, 1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


_STORED: dict[tuple, str] = {}


def stored(
    spark: SparkSession, folder: str, name: str, build: Callable[..., DataFrame], by: str | None = None
) -> DataFrame:
    """A derived table, written once per session to the shared folder as the store writes it.

    Searches run over stored lexemes and vectors, as after an indexing run. With ``by``,
    a column that searches filter by, rows of one value lie together; without it no row moves.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STORED:
        location = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}/{name}"
        rows = build(spark, folder)
        write_table(clustered(rows, by) if by else rows, location)
        _STORED[key] = location
    return read_table(spark, _STORED[key])


def _summary(count: int) -> Column:
    """The leading sentences as a stored summary; rows without one have none yet."""
    return F.nullif(lead_sentences(F.col("text"), count), F.lit(""))


def document_paths(documents: DataFrame) -> DataFrame:
    """``documents`` with ``project_id``, ``git_url`` and ``path``."""
    suffix = F.expr("CASE lang WHEN 'en' THEN '.py' WHEN 'fr' THEN '.js' WHEN 'de' THEN '.ts' ELSE '.go' END")
    return (
        documents.withColumn("project_id", F.expr("cast(substr(source, 4) AS bigint)"))
        .withColumn("git_url", F.concat(F.lit("https://example.org/"), "source", F.lit(".git")))
        .withColumn("path", F.concat("source", F.lit("/doc_"), "doc_id", suffix))
    )


def files(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as stored files, with the given vectors."""
    documents = document_paths(table(spark, folder, "documents"))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    rows = documents.join(vectors, "doc_id", "left").select(
        F.col("doc_id").alias("id"), "project_id", "path",
        checksum(F.col("text")).alias("checksum"), F.col("text").alias("body"),
        _summary(2).alias("summary"), "embedding",
    )
    return analyze(rows, "concat(path, ' ', coalesce(summary, ''))", PLAIN)


def searchable_files(spark: SparkSession, folder: str) -> DataFrame:
    """What searches read of ``files``: all but body and checksum.

    Summary and lexemes are taken where the texts lie, before the vectors are joined.
    """
    rows = document_paths(table(spark, folder, "documents")).select(
        F.col("doc_id").alias("id"), "project_id", "path", _summary(2).alias("summary"))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return analyze(rows, "concat(path, ' ', coalesce(summary, ''))", PLAIN).join(vectors, "id", "left")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The whole document texts as searchable rows."""
    rows = document_paths(spread(table(spark, folder, "documents"))).select(
        F.col("doc_id").alias("id"), "project_id", "text"
    )
    return analyze(rows, "text", PLAIN).select("id", "project_id", "fts")


def text_postings(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_postings(postings(texts(spark, folder)))


def talk_paths(talks: DataFrame) -> DataFrame:
    return talks.withColumn("path", F.expr("concat('talks/', conv_id, '_', turn, '.py')"))


def stored_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of an earlier run: all documents and all conversation turns.

    Documents without a full sentence have no summary yet.
    """
    documents = document_paths(table(spark, folder, "documents")).select(
        F.col("doc_id").alias("id"), "project_id", "path", "text"
    )
    talks = talk_paths(table(spark, folder, "conversations")).select(
        (F.lit(1000000000) + F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.lit(0).cast("long").alias("project_id"), "path", "text",
    )
    rows = documents.unionByName(talks).select(
        "id", "project_id", "path", checksum(F.col("text")).alias("checksum"),
        F.col("text").alias("body"), _summary(2).alias("summary"),
        F.lit(None).cast("array<float>").alias("embedding"),
    )
    return analyze(rows, "concat(path, ' ', coalesce(summary, ''))", PLAIN).withColumn(
        "last_updated", F.lit(EARLIER).cast("timestamp")
    )


def scanned_files(spark: SparkSession, folder: str) -> DataFrame:
    """A new scan: all documents, good ones edited, and all pages as new files."""
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id").distinct()
    documents = (
        document_paths(table(spark, folder, "documents"))
        .join(good.withColumn("_good", F.lit(True)), "doc_id", "left")
        .select("project_id", "path",
                F.expr("concat(if(_good, 'Edited. ', ''), text)").alias("body"))
    )
    documents = documents.select(
        "project_id", "path", F.coalesce("body", F.lit("")).alias("body")
    )
    pages = table(spark, folder, "pages").select(
        F.lit(0).cast("long").alias("project_id"),
        F.expr("concat('pages/', page_id, '.py')").alias("path"),
        F.col("html").alias("body"),
    )
    return documents.unionByName(pages).withColumn("checksum", checksum(F.col("body")))


def stored_functions(spark: SparkSession, folder: str) -> DataFrame:
    """``conversations`` as stored functions: a turn is a function of its file."""
    rows = table(spark, folder, "conversations").select(
        F.expr("conv_id * 1000 + turn").alias("id"), F.col("conv_id").alias("file_id"),
        F.lit(0).cast("long").alias("project_id"),
        F.expr("concat(role, '_', turn)").alias("name"),
        F.expr("concat(role, '_', turn, '()')").alias("signature"),
        F.expr("cast(turn + 1 AS int)").alias("start_line"),
        F.expr("cast(turn + 1 AS int)").alias("end_line"),
        F.col("text").alias("body"), checksum(F.col("text")).alias("checksum"),
        _summary(3).alias("summary"),
        F.lit(None).cast("array<float>").alias("embedding"),
    )
    return analyze(rows, "concat(name, ' ', coalesce(summary, ''))", PLAIN).withColumn(
        "last_updated", F.lit(EARLIER).cast("timestamp")
    )


def searchable_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Stored functions with the vector of their file."""
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("file_id"), F.col("embedding").alias("_vector")
    )
    return stored_functions(spark, folder).drop("embedding").join(
        vectors, "file_id", "left"
    ).withColumnRenamed("_vector", "embedding")


def extracted_functions(spark: SparkSession, folder: str) -> DataFrame:
    """A new extraction of the turns.

    Assistant turns are edited, system turns are gone, and every user turn has
    gained a second function a hundred lines below.
    """
    talks = table(spark, folder, "conversations")
    again = talks.where("role <> 'system'").select(
        "conv_id", "role", "turn", (F.col("turn") + 1).alias("line"),
        F.expr("concat(text, if(role = 'assistant', ' Edited.', ''))").alias("body"),
    )
    added = talks.where("role = 'user'").select(
        "conv_id", "role", "turn", (F.col("turn") + 101).alias("line"), F.col("text").alias("body")
    )
    return again.unionByName(added).select(
        F.col("conv_id").alias("file_id"), F.lit(0).cast("long").alias("project_id"),
        F.expr("concat(role, '_', turn)").alias("name"),
        F.expr("concat(role, '_', turn, '()')").alias("signature"),
        F.col("line").cast("int").alias("start_line"), F.col("line").cast("int").alias("end_line"),
        "body", checksum(F.col("body")).alias("checksum"),
    )


def changed_talks(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the new extraction: conversations numbered like a good document."""
    return (
        table(spark, folder, "labels").where("quality = 1")
        .select(F.col("doc_id").alias("file_id")).distinct()
    )


def query_vector(spark: SparkSession, folder: str) -> list[float]:
    """The search argument: one stored vector."""
    vectors = table(spark, folder, "embeddings")
    return vectors.where("vec_id = 0").select("embedding").first()[0]


# Source texts with known definitions. {name} parts are filled per document.
PYTHON_SOURCE = (
    'import os  # def not_here(): pass\n'
    '\n'
    '@decorated(\n'
    '    "def neither(): pass")\n'
    'def top_{id}(first,\n'
    '          second={{}}):  # )\n'
    '    """{text}\n'
    'def inside_text():\n'
    '    """\n'
    '    def nested():\n'
    '        pass\n'
    '    return (first,\n'
    'second)  # the end\n'
    '\n'
    'class Holder_{id}(object):\n'
    '    async def method_{lang}(self): return \'{source}\'\n'
    '\n'
    '    class Inner:\n'
    '        def hidden(self):\n'
    '            pass\n'
    '    # a comment\n'
    'if os:\n'
    '    def conditional():\n'
    '        pass\n'
)
SCRIPT_SOURCE = (
    '// function not_here() {{\n'
    'export function exported() {{ return 1; }}\n'
    'const arrow = () => {{ return /[}}]/; }};\n'
    'async function top_{id}(first, second = {{}}) {{\n'
    '  const text = `{text}`;\n'
    '  function nested() {{ return "}}"; }}\n'
    '  return nested;\n'
    '}}\n'
    'class Holder_{id} extends Base {{\n'
    '  field = {{ a: 1 }};\n'
    '  constructor(first) {{ super(first); }}\n'
    '  static get {lang}() {{\n'
    "    return '{source}';\n"
    '  }}\n'
    '}}\n'
)
TYPED_SOURCE = (
    '@Injectable({{ deps: [of("{{")] }})\n'
    'class Typed_{id}<T extends {{ a: number }}> {{\n'
    '  @Input(() => [f({{}})])\n'
    '  public method_{lang}(first: {{ a: string }}, second?: T): Promise<{{ b: T }}> {{\n'
    '    return `{text}`;\n'
    '  }}\n'
    '}}\n'
)

# Slashes and template literals where a plain count of braces goes wrong.
SLASH_SOURCE = (
    'function first_{id}(s) {{\n'
    '  switch (s) {{ case /}}/.test(s): return `a${{`}}${{s}}`}}`; }}\n'
    '  if (s) /{{/.exec(s);\n'
    '  return typeof /[{{}}]/ + `{text}`;\n'
    '}}\n'
    'function second_{id}() {{ return 1 / 2; }}\n'
)


def source_text(template: str, quote: str = "''") -> str:
    """A template as a SQL expression over ``doc_id, lang, source, clean``.

    ``quote`` is how the dialect writes a quote inside a text.
    """
    filled = template.replace("{{", "\x00").replace("}}", "\x01")
    for name, column in (("id", "doc_id"), ("text", "clean"), ("lang", "lang"), ("source", "source")):
        filled = filled.replace("{" + name + "}", "\x02" + column + "\x02")
    filled = filled.replace("\x00", "{").replace("\x01", "}")
    parts = []
    for i, part in enumerate(filled.split("\x02")):
        if i % 2:
            parts.append(part)
        elif part:
            lines = part.split("\n")
            pieces = []
            for n, line in enumerate(lines):
                if n:
                    pieces.append("chr(10)")
                # Spark's parser would put a setting in place of a name in braces after a dollar sign.
                pieces.extend("'" + p.replace("'", quote) + "'" for p in line.replace("${", "$\x03{").split("\x03") if p)
            parts.extend(pieces)
    return "concat(" + ", ".join(parts) + ")"


# A text as the inside of a literal: everything is kept, quotes and backslashes are escaped.
CLEAN = r"""regexp_replace(text, '([\\"`])', '\\\1', 'g')"""


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r'([\\"`])', r"\\$1")


def source_files(spark: SparkSession, folder: str) -> DataFrame:
    """A source file in each language per document, each holding its whole text."""
    documents = spread(table(spark, folder, "documents")).withColumn(
        "clean", _escaped(F.col("text"))
    )
    def body(template: str):
        return F.expr(source_text(template, quote="\\'"))

    python = documents.select(
        (F.col("doc_id") * 2).alias("file_id"), F.lit("Python").alias("language"),
        body(PYTHON_SOURCE).alias("body"),
    )
    script = documents.select(
        (F.col("doc_id") * 2 + 1).alias("file_id"), F.lit("JavaScript").alias("language"),
        body(SCRIPT_SOURCE).alias("body"),
    )
    other = documents.select(
        (-F.col("doc_id") - 1).alias("file_id"), F.lit("Go").alias("language"),
        body(SCRIPT_SOURCE).alias("body"),
    )
    typed = documents.select(
        (F.col("doc_id") + 1000000000).alias("file_id"), F.lit("TypeScript").alias("language"),
        body(TYPED_SOURCE).alias("body"),
    )
    slashes = documents.select(
        (F.col("doc_id") + 2000000000).alias("file_id"), F.lit("JavaScript").alias("language"),
        body(SLASH_SOURCE).alias("body"),
    )
    return python.unionByName(script).unionByName(typed).unionByName(slashes).unionByName(other)


def repository_scan(spark: SparkSession, folder: str, edited: bool = False) -> DataFrame:
    """Every document as a source file of its project's repository.

    With ``edited``, the files of good documents start with one more line.
    """
    good = few_ids(table(spark, folder, "labels").where("quality = 1").select("doc_id"))
    documents = (
        document_paths(table(spark, folder, "documents"))
        .join(good.withColumn("_good", F.lit(True)), "doc_id", "left")
        .withColumn("clean", _escaped(F.col("text")))
    )
    python, script = (
        F.expr(source_text(t, quote="\\'")) for t in (PYTHON_SOURCE, SCRIPT_SOURCE)
    )
    body = F.when(F.col("lang") == "en", python).otherwise(script)
    if edited:
        line = F.when(F.col("lang") == "en", "# edited\n").otherwise("// edited\n")
        body = F.when(F.col("_good"), F.concat(line, body)).otherwise(body)
    return documents.select("git_url", "path", body.cast("binary").alias("content"))


#: Names under which a document becomes a file, by turns; file sources of Spark skip the first three.
FILE_NAMES = ("_x/__init__.py", ".y/tool.py", "pkg/_private.py", "plain/b.py")


def tracked_documents(documents: DataFrame) -> DataFrame:
    """``folder, git_url, path, content``: every document under one of ``FILE_NAMES`` in its own folder."""
    name = F.element_at(F.array(*[F.lit(n) for n in FILE_NAMES]), (F.col("doc_id") % len(FILE_NAMES) + 1).cast("int"))
    return documents.select(
        F.col("source").alias("folder"), F.concat(F.lit("https://example.org/"), "source", F.lit(".git")).alias("git_url"),
        F.concat(F.lit("d"), "doc_id", F.lit("/"), name).alias("path"), F.col("text").cast("binary").alias("content"),
    )


def untracked(documents: DataFrame) -> DataFrame:
    """A file beside each tracked one that no version control knows."""
    return documents.withColumn("path", F.concat(F.lit("node_modules/"), "path"))


def write_files(files: DataFrame, root: str) -> None:
    """Write ``folder, path, content`` as files below ``root``, each on the executor that holds it."""
    def write(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, base = fs.FileSystem.from_uri(root)
                place = f"{base}/{row['folder']}/{row['path']}"
                system.create_dir(place.rpartition("/")[0])
                with system.open_output_stream(place) as file:
                    file.write(row["content"] or b"")
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]}, pa.schema([("n", pa.int64())]))

    spread(files).mapInArrow(write, "n long").agg(F.sum("n")).collect()
