"""Reading source files of one or many repositories.

Spark's file sources leave out names that start with ``_`` or ``.``. Repositories
are full of them, so folders are listed and files are read in Arrow batches on
the executors, through ``pyarrow.fs``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.functions.content import checksum
from shelfmark.session import shared_folder

#: Bytes of contents after which a batch is handed on.
BATCH_BYTES = 16 << 20
_PLACE = "git_url string, folder string, path string"


def _opened(folder: str, known: dict) -> tuple[fs.FileSystem, str]:
    """The file system of a checkout's folder, and the folder's path in it."""
    if folder not in known:
        known[folder] = fs.FileSystem.from_uri(folder)
    return known[folder]


def _join(folder: str, path: str) -> str:
    return f"{folder}/{path}" if path else folder


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of each folder ``(git_url, folder, path)``, one level deep, without ``.git``."""
    known: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            system, base = _opened(row["folder"], known)
            place = _join(base, row["path"])
            found = [
                i for i in system.get_file_info(fs.FileSelector(place, allow_not_found=True))
                if i.base_name != ".git" and i.type in (fs.FileType.File, fs.FileType.Directory)
            ]
            yield pa.RecordBatch.from_pylist([
                {"git_url": row["git_url"], "folder": row["folder"],
                 "path": _join(row["path"], i.base_name) if row["path"] else i.base_name,
                 "is_folder": i.type == fs.FileType.Directory}
                for i in found
            ], pa.schema([("git_url", pa.string()), ("folder", pa.string()), ("path", pa.string()),
                          ("is_folder", pa.bool_())]))


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``git_url, path, content`` of each file that exists."""
    known: dict = {}
    schema = pa.schema([("git_url", pa.string()), ("path", pa.string()), ("content", pa.binary())])
    rows, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            system, base = _opened(row["folder"], known)
            try:
                with system.open_input_stream(_join(base, row["path"])) as file:
                    content = file.read()
            except FileNotFoundError:
                continue
            rows.append({"git_url": row["git_url"], "path": row["path"], "content": content})
            size += len(content)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, schema)


def _dealt(places: DataFrame) -> DataFrame:
    """Rows spread by their path, so that a large repository is the work of many tasks."""
    n = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return places.repartition(n, "folder", "path")


def _listed(checkouts: DataFrame) -> DataFrame:
    """All files below ``checkouts (git_url, folder)``, level by level."""
    spark = checkouts.sparkSession
    place = f"{shared_folder(spark)}/listing-{uuid.uuid4().hex}"
    level = checkouts.select("git_url", "folder", F.lit("").alias("path"))
    levels = []
    while True:
        here = f"{place}/{len(levels)}"
        _dealt(level).mapInArrow(_list_folders, f"{_PLACE}, is_folder boolean").write.parquet(here)
        levels.append(here)
        found = spark.read.parquet(here)
        level = found.where("is_folder").select("git_url", "folder", "path")
        if level.isEmpty():
            return spark.read.parquet(*levels).where("NOT is_folder").select("git_url", "folder", "path")


def scan_repositories(
    spark: SparkSession, root: str, checkouts: DataFrame, tracked: DataFrame | None = None
) -> DataFrame:
    """``(git_url, path, content)`` of many repositories, one folder each below ``root``.

    ``checkouts`` has ``folder, git_url``; other folders are left out. ``tracked
    (git_url, path)`` names the files that belong to the repositories, as their
    version control lists them; of these, the ones that exist are read. Without
    it every file counts, except what is called ``.git`` at any level.
    """
    places = checkouts.select("git_url", F.concat(F.lit(root.rstrip("/") + "/"), "folder").alias("folder"))
    if tracked is None:
        files = _listed(places)
    else:
        files = tracked.select("git_url", "path").join(places, "git_url").select("git_url", "folder", "path")
    return _dealt(files).mapInArrow(_read_files, "git_url string, path string, content binary")


def scan_repository(spark: SparkSession, root: str, git_url: str, tracked: DataFrame | None = None) -> DataFrame:
    """``(git_url, path, content)`` of one checked-out repository; ``tracked`` has ``path``."""
    parent, _, name = root.rstrip("/").rpartition("/")
    checkouts = spark.createDataFrame([(name, git_url)], "folder string, git_url string")
    if tracked is not None:
        tracked = tracked.select(F.lit(git_url).alias("git_url"), "path")
    return scan_repositories(spark, parent, checkouts, tracked)


def latest_drop(scan: DataFrame) -> DataFrame:
    """One row per ``(git_url, path)``: the one with the latest ``_dropped``.

    Rows of equal time are told apart by content. The winner is found without
    content, so many drops of one path do not gather in one task.
    """
    key = ["git_url", "path"]
    told = scan.withColumn("_sum", checksum(F.col("content")))
    winners = (
        told.groupBy(*key)
        .agg(F.max(F.struct("_dropped", "_sum")).alias("_w"))
        .select(*key, "_w.*")
    )
    return (
        told.join(winners, [*key, "_dropped", "_sum"], "left_semi")
        .dropDuplicates(key)
        .select(*key, "content")
    )
