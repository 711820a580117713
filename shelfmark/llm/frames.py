"""Small helpers the operators share: reading tables, Arrow maps, checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfmark.session import shared_folder


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(frame: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``frame`` doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def put_by(frame: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``frame`` with its columns ``names`` renamed out of the way, and the names to restore."""
    aside = {}
    for column in frame.columns:
        if column.lower() in names:
            other = unused(frame, f"own_{column}")
            frame = frame.withColumnRenamed(column, other)
            aside[other] = column
    return frame, aside


def append_columns(
    frame: DataFrame,
    source: str,
    start: Callable[[], Callable[[list], list[list]]],
    added: str,
    keep_source: bool = True,
) -> DataFrame:
    """``frame`` with the columns ``added`` computed from column ``source`` in Arrow batches.

    ``start`` runs once per task and returns the function of a batch: a list of
    values in, one list per added column out. Columns of ``frame`` that bear an
    added name are replaced; ``source`` itself goes unless it is to be kept.
    """
    fields = StructType.fromDDL(added)
    kept = frame.drop(*[f.name for f in fields if f.name.lower() != source.lower()])
    passed = [c for c in kept.columns if c not in fields.names and (keep_source or c != source)]
    schema = StructType([*(kept.schema[c] for c in passed), *fields.fields])
    kinds = [f.type for f in to_arrow_schema(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            names = batch.schema.names
            columns = function(batch.column(names.index(source)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(names.index(c)) for c in passed),
                 *(pa.array(c, k) for c, k in zip(columns, kinds))],
                [*passed, *fields.names],
            )

    return kept.mapInArrow(run, schema)


def written(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared folder and read back.

    Later stages start from the files, so a lost executor costs no recomputation.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
