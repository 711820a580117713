"""From raw documents to token ids, in five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept. All but the last return the columns of ``documents``, and any
others that are there, as they are. A null or empty text has no language and goes
at the first stage. A row without an id goes at the second, and of repeated rows
one stays. Nulls in other columns pass, texts of any length are worked on whole,
and an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontamination, language, personal, pieces, simhash
from shelfmark.llm.frames import read
from shelfmark.llm.queries import tokenizer_path
from shelfmark.session import shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without a letter, or of no language, go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and ``n_chars`` set anew."""
    return personal.mask(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digests that verify them."""
    return pieces.digests(docs, pieces.Model.from_file(tokenizer_path()), with_ids=True).drop("text", "n_chars")


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

#: A trained classifier and fingerprints can't be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
