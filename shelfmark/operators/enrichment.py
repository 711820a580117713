"""Summaries and embeddings for rows that need them.

A model is a function of columns giving a column. ``column_model`` wraps a
JVM expression, ``batch_model`` a Python callable over pandas batches; both are
asked for flagged rows only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.sentences import lead_sentences
from shelfmark.functions.text import ENGLISH, Analyzer, lexemes_sql
from shelfmark.functions.vectors import hashed_vector_sql

# A model gets the flag of the rows to work on, then its input columns.
Model = Callable[..., Column]


def column_model(expression: Callable[..., Column]) -> Model:
    """A model made of built-in column functions."""
    return lambda wanted, *inputs: F.when(wanted, expression(*inputs))


def batch_model(make: Callable[[], Callable[..., pd.Series]], returns: str) -> Model:
    """A model run in Python workers.

    ``make()`` builds the callable once per task that has flagged rows; it gets
    pandas Series of these rows' inputs. Other rows' inputs are not sent to Python.
    """

    def call(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = None
        for wanted, *inputs in batches:
            chosen = wanted.fillna(False).astype(bool)
            result = pd.Series([None] * len(wanted), dtype=object)
            if chosen.any():
                model = model or make()
                answers = model(*[values[chosen].reset_index(drop=True) for values in inputs])
                result[chosen.to_numpy()] = pd.Series(list(answers), dtype=object).to_numpy()
            yield result

    call.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series],
    }
    run = F.pandas_udf(call, returnType=returns)
    return lambda wanted, *inputs: run(wanted, *[F.when(wanted, c) for c in inputs])


def lead_summary(sentences: int) -> Model:
    """Built-in summary: the first sentences of the last input (the body)."""
    return column_model(lambda *inputs: lead_sentences(inputs[-1], sentences))


def hashed_embedding(dimension: int = 64) -> Model:
    """Built-in embedding: hashed term counts of the ``summary`` column."""
    return column_model(lambda _: F.expr(hashed_vector_sql("summary", dimension)))


def enrich(
    rows: DataFrame,
    stale: Column,
    inputs: list[str],
    searchable: str,
    as_of,
    summarize: Model,
    embed: Model,
    analyzer: Analyzer = ENGLISH,
) -> DataFrame:
    """Fill summary, embedding, text vector and time of ``stale`` rows.

    The embedding is made from the new summary. ``searchable`` names the column
    that is full-text searchable together with the summary.
    """
    flagged = rows.withColumn("_stale", F.coalesce(stale, F.lit(False)))
    columns = rows.columns

    def replace(frame: DataFrame, name: str, value: Column) -> DataFrame:
        return frame.withColumn(name, F.when(F.col("_stale"), value).otherwise(F.col(name)))

    summarized = replace(
        flagged, "summary", summarize(F.col("_stale"), *[F.col(c) for c in inputs])
    )
    embedded = replace(summarized, "embedding", embed(F.col("_stale"), F.col("summary")))
    searchable_text = f"concat(coalesce({searchable}, ''), ' ', coalesce(summary, ''))"
    indexed = replace(embedded, "fts", F.expr(lexemes_sql(searchable_text, analyzer)))
    return replace(indexed, "last_updated", F.lit(as_of).cast("timestamp")).select(*columns)
