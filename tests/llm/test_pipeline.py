import hashlib

import sentencepiece

import corpus_pipeline
from shelfmark.llm import language, personal
from shelfmark.llm.queries import tokenizer_path
from tests.llm.test_decontamination import brute
from tests.llm.test_simhash import brute_components, brute_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_pipeline(spark, rows, benchmark):
    """The stages over rows in memory: every pair of fingerprints, every document and item."""
    kind = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS).schema
    model = language.train(spark.createDataFrame(rows, kind))
    rows = [r for r in rows if model.predict(r["text"])[0] != "und" and model.predict(r["text"])[1] >= 0.5]
    component = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in rows])
    rows = [r for r in rows if component[r["doc_id"]] == r["doc_id"]]
    leaked = {p[0] for p in brute([(r["doc_id"], r["text"]) for r in rows], benchmark)}
    rows = [r for r in rows if r["doc_id"] not in leaked]
    field = personal.train(spark.createDataFrame(rows, kind))
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    out = set()
    for r in rows:
        ids = library.encode(personal.masked(r["text"], field), add_eos=True)
        out.add((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return out


def test_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select(*COLUMNS).collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()
    got = corpus_pipeline.run(spark, folder)
    want = brute_pipeline(spark, rows, items)
    assert {tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want
    assert got.count() == len(want) > 50


def test_edge_cases(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the mail a@b.org of the", "en", "s", 1),
            (3, "the mail a@b.org of the", "en", "s", 1), (4, "les des une est", "fr", None, None),
            (None, "the of and to", None, None, None), (5, "la de " * 100000, "fr", "s", None)]
    docs = spark.createDataFrame(rows, kind).selectExpr("*", "1 as item_id", "'x' as ids", "2 as score", "3 as pii")
    for number, part in enumerate((docs, docs.where("false"))):
        folder = tmp_path / str(number)
        part.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "unseen item")], "item_id long, text string").write.parquet(
            f"{folder}/benchmark.parquet")
        kept = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(folder))
            assert kept.columns == docs.columns
            kept.collect()
        ids = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(folder)).collect())
        assert ids == ([3, 4, 5] if number == 0 else [])
