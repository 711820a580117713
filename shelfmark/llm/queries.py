"""One query per operator over its whole table, in the agreed result columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import (
    chat, decontamination, language, personal, pieces, quality, secret_scan, sharding, simhash, site_style, spelling, urls,
    whitening,
)
from shelfmark.llm.frames import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.measure(docs))
    return judged.drop("text", "rejected_by", "rules_run")


@query
def op2_html_extraction(spark, folder):
    pages = site_style.extract(read(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op3_sentencepiece(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return pieces.digests(docs, pieces.Model.from_file(tokenizer_path())).drop("text")


@query
def op4_benchmark_decontamination(spark, folder):
    return decontamination.leaked_pairs(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op5_chat_formatting(spark, folder):
    added = [(-7, 0, "user"), (-7, 1, "assistant")]
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(added, "conv_id long, turn long, role string").withColumn(
            "text", F.lit("\\### Assistant: </turn> ok"))
    )
    formatted = chat.format_conversations(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    read_back = formatted.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_back(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


@query
def op6_pii(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = personal.with_spans(docs, personal.train(docs)).select("doc_id", "pii")
    counts = [f"cast(size(filter(pii, s -> s.base and s.kind = '{k}')) as bigint) as n_{k}" for k in personal.KINDS]
    return found.selectExpr(
        "doc_id", *counts, f"sha2({_joined('filter(pii, s -> s.base)')}, 256) as base_sha256",
        f"{_joined('pii')} as spans",
    )


@query
def op7_secret_scans(spark, folder):
    found = secret_scan.with_secrets(read(spark, folder, "documents").select("doc_id", "text")).drop("text")
    counts = [
        f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint) as n_{k}" for k in secret_scan.KINDS[:3]
    ]
    return found.selectExpr(
        "doc_id", *counts, f"sha2({_joined('filter(secrets, s -> s.base)')}, 256) as base_sha256",
        f"{_joined('secrets')} as spans",
    )


#: The rules of the URL query.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query
def op8_url_filters(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge_urls(read(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


@query
def op9_language_id(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op10_simhash_near_dedup(spark, folder):
    groups = simhash.simhash_components(read(spark, folder, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _lose_one_in_31(doc_id: str, run: str) -> str:
    """The contract's misspelling: a run whose checksum 31 divides loses one letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % 31 else run[:at] + run[at + 1:]


@query
def op11_spelling_variants(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return spelling.group_spellings(docs, alter=_lose_one_in_31).select(
        "word", "form", "root", "n", "n_near", "form_n")


@query
def op12_sharding(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return sharding.into_shards(docs, 16).select(
        "doc_id", sharding.record_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op13_embedding_whitening(spark, folder):
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    fitted = whitening.fit(vectors)
    error = whitening.identity_error(vectors, fitted)
    explained = F.array(*[F.lit(e) for e in fitted.explained]).cast("array<double>")
    rows = whitening.whiten(vectors, fitted).select(
        "vec_id", F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
