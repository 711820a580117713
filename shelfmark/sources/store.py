"""The stored tables as Parquet in a folder that all executors share.

Every table is partitioned by the hash of a column: files by their id, functions
by the id of their file, postings by their term. A change names the rows that come
and the ids that go; only the partitions of these are read and written again, by
Spark's dynamic partition overwrite, and their other rows pass without an exchange.
Each rewritten partition also holds a row of nulls, so that one that loses its last
row is overwritten like the others; readers don't see it.

One run writes at a time. Tables are written one after the other, projects last:
with them stands the digest of the scan that the other tables agree with, so a run
that broke off is made good by the next one. For readers that must not see a run
half done, keep the tables in a format with transactions.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfmark import schemas
from shelfmark.operators.fulltext import postings, term_bucket
from shelfmark.operators.identity import check_unique, few_ids
from shelfmark.operators.projects import delete_projects
from shelfmark.schemas import TABLES, UNIQUE_KEYS

BUCKETS = 64
POSTINGS = {"file_postings": "files", "function_postings": "functions"}
_PARTITIONED_BY = {"projects": "id", "files": "id", "functions": "file_id"}
# Rows next to each other in a file share the project, so a project filter skips row groups.
_CLUSTERED_BY = {"files": "project_id", "functions": "project_id", "file_postings": "term", "function_postings": "term"}
_RUNS = "number long, as_of timestamp, finished boolean"


def clustered(table: DataFrame, column: str) -> DataFrame:
    """Rows of one ``column`` value together, in tasks of even size."""
    return table.hint("rebalance", F.col(column)).sortWithinPartitions(column, "id")


def write_table(rows: DataFrame, location: str, *partitioned_by: str, overwrite: bool = False) -> None:
    """Write rows with a bloom filter on the column that they are fetched by.

    It lets a fetch by id skip row groups although ids are not in order; postings
    are found by term. With ``overwrite``, only partitions that ``rows`` has are
    replaced.
    """
    writer = rows.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd")
    sought = next((c for c in ("term", "id") if c in rows.columns), None)
    if sought:
        writer = writer.option(f"parquet.bloom.filter.enabled#{sought}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    if partitioned_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitioned_by)
    writer.parquet(location)


class TableStore:
    """``buckets`` is the number of partitions of each table; it stays as it is for a store's life."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets = buckets

    def _schema(self, table: str) -> T.StructType:
        if table in POSTINGS:
            return schemas.POSTINGS
        return T.StructType([*TABLES[table], *(schemas.SCAN_STATE if table == "projects" else [])])

    def bucket(self, table: str) -> Column:
        """The partition of a row of ``table``."""
        if table in POSTINGS:
            return term_bucket(F.col("term"), self.buckets)
        if table == "projects":  # one narrow row for each repository
            return F.lit(0)
        return F.pmod(F.xxhash64(_PARTITIONED_BY[table]), F.lit(self.buckets)).cast("int")

    def _read(self, name: str, schema: T.StructType | str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def exists(self, table: str) -> bool:
        return self._read(table, self._schema(table)) is not None

    def rows(self, table: str) -> DataFrame:
        """A table as it is stored, with its ``bucket``; empty before the first run."""
        schema = T.StructType([*self._schema(table), T.StructField("bucket", T.IntegerType())])
        found = self._read(table, schema)
        if found is None:
            return self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
        return found.where("id IS NOT NULL")

    def read(self, table: str) -> DataFrame:
        """A table; empty before the first run. Postings come with their ``bucket``, by which a search finds them.

        The time of a file is that of its project's last scan, unless the file has
        gone from it. The aggregation tells Spark that ids are unique, so that the
        join is left out where the time isn't selected.
        """
        if table in POSTINGS:
            return self.rows(table)
        rows = self.rows(table).select(*TABLES[table].fieldNames())
        if table != "files":
            return rows
        scans = self.rows("projects").groupBy(F.col("id").alias("project_id")).agg(F.max("scanned_at").alias("_scanned_at"))
        return rows.join(scans, "project_id", "left").withColumn(
            "last_updated", F.coalesce("last_updated", "_scanned_at")).select(*rows.columns)

    def of_buckets(self, table: str, buckets: set[int]) -> DataFrame:
        """The rows of some partitions; the others are not read."""
        return self.rows(table).where(F.col("bucket").isin(sorted(buckets)) if buckets else F.lit(False))

    def touched(self, table: str, rows: DataFrame) -> set[int]:
        """The partitions that ``rows`` belong to: at most ``buckets`` numbers reach the driver."""
        if table == "projects":
            return {0}
        return {r[0] for r in rows.select(self.bucket(table)).distinct().collect()}

    def update(self, table: str, changed: DataFrame, removed: DataFrame | None = None) -> None:
        """Put ``changed`` rows in place of those with their ids, and take out those with an id of ``removed``.

        Both are read several times, so they should be written tables. ``removed``
        has the id and the column that the table is partitioned by.
        """
        by = "term" if table in POSTINGS else _PARTITIONED_BY[table]
        going = changed.select("id", by)
        if removed is not None:
            going = going.union(removed.select("id", by))
        buckets = self.touched(table, going)
        if not buckets:
            return
        names = self._schema(table).names
        kept = self.of_buckets(table, buckets).join(few_ids(going.select("id")), "id", "left_anti")
        typed = changed.select([F.col(f.name).cast(f.dataType) if f.name in changed.columns
                                else F.lit(None).cast(f.dataType).alias(f.name) for f in self._schema(table)])
        added = typed.withColumn("bucket", self.bucket(table)).hint("rebalance", F.col("bucket"))
        self._overwrite(table, kept.select(*names, "bucket").union(added), buckets)

    def replace(self, table: str, rows: DataFrame) -> None:
        """Make ``rows`` the whole table."""
        if table not in POSTINGS:
            check_unique(rows, UNIQUE_KEYS[table])
        typed = rows.select([F.col(f.name).cast(f.dataType) if f.name in rows.columns
                             else F.lit(None).cast(f.dataType).alias(f.name) for f in self._schema(table)])
        dealt = typed.withColumn("bucket", self.bucket(table)).hint("rebalance", F.col("bucket"))
        self._overwrite(table, dealt, {0} if table == "projects" else set(range(self.buckets)))

    def _overwrite(self, table: str, rows: DataFrame, buckets: set[int]) -> None:
        empty = self.spark.range(0, self.buckets, 1, 1).where(F.col("id").isin(sorted(buckets)))
        marks = empty.select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in self._schema(table)],
            F.col("id").cast("int").alias("bucket"))
        order = dict.fromkeys(["bucket", _CLUSTERED_BY.get(table, "id"), "id"])
        write_table(
            rows.union(marks).sortWithinPartitions(*order), f"{self.folder}/{table}", "bucket", overwrite=True)

    def runs(self) -> DataFrame:
        found = self._read("runs", _RUNS)
        return self.spark.createDataFrame([], _RUNS) if found is None else found

    @property
    def version(self) -> int:
        """The number of the last finished run; 0 before the first."""
        return self.runs().where("finished").agg(F.max("number")).first()[0] or 0

    def begin(self, as_of: datetime) -> "Run":
        """A run that follows all earlier ones, finished or broken off."""
        last = self.runs().agg(F.max("number").alias("number"), F.max(F.when(F.col("finished"), F.col("number")))).first()
        return Run(self, (last[0] or 0) + 1, as_of, broken_off=last[0] != last[1])

    def delete_projects(self, removed: DataFrame, as_of: datetime) -> int:
        """Take out the projects of ``removed(id)``, their files, functions and postings."""
        run = self.begin(as_of)
        gone = run.set_aside("gone", removed.select("id").distinct())
        going = {}
        columns = {"projects": ["id"], "files": ["id", "project_id"], "functions": ["id", "file_id", "project_id"]}
        stored = {table: self.rows(table) for table in columns}
        kept = delete_projects(*(stored[t].select(*names) for t, names in columns.items()), gone)
        for (table, names), left in zip(columns.items(), kept):
            going[table] = run.set_aside(f"{table}_gone", stored[table].select(*names).join(left, "id", "left_anti"))
        for name, table in POSTINGS.items():
            if self.exists(name):
                lost = self.rows(name).join(going[table].select("id"), "id", "left_semi").select("id", "term")
                run.update(name, self.rows(name).limit(0), run.set_aside(f"{name}_gone", lost))
        for table in ("functions", "files", "projects"):
            run.update(table, stored[table].limit(0), going[table])
        return run.finish()


class Run:
    """One run's writes. ``broken_off`` says that the run before it didn't finish."""

    def __init__(self, store: TableStore, number: int, as_of: datetime, broken_off: bool):
        self.store, self.number, self.as_of, self.broken_off = store, number, as_of, broken_off
        self._folder = f"{store.folder}/intermediate/{uuid.uuid4().hex}"
        self._begun = False

    def set_aside(self, name: str, rows: DataFrame) -> DataFrame:
        """Write an intermediate result, to cut its lineage."""
        location = f"{self._folder}/{name}"
        rows.write.option("compression", "zstd").parquet(location)
        return self.store.spark.read.schema(rows.schema).parquet(location)

    def _note(self, finished: bool) -> None:
        note = self.store.spark.range(0, 1, 1, 1).select(
            F.lit(self.number).cast("long").alias("number"), F.lit(self.as_of).cast("timestamp").alias("as_of"),
            F.lit(finished).alias("finished"))
        note.write.mode("append").parquet(f"{self.store.folder}/runs")

    def _begin(self) -> None:
        if not self._begun:
            self._note(False)
            self._begun = True

    def update(self, table: str, changed: DataFrame, removed: DataFrame | None = None) -> None:
        if table != "projects":  # a run of one table is whole once that is written
            self._begin()
        self.store.update(table, changed, removed)

    def replace(self, table: str, rows: DataFrame) -> None:
        self._begin()
        self.store.replace(table, rows)

    def build_postings(self, name: str) -> None:
        """The postings of a whole table."""
        self.replace(name, postings(self.store.read(POSTINGS[name])))

    def finish(self) -> int:
        """Note that the tables agree; the run's number."""
        self._note(True)
        return self.number
