import zlib

import numpy as np

from shelfmark.llm import language

DOCS = "doc_id long, text string, lang string"


def test_held_out_accuracy_and_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs)
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    rows = language.identify(docs, model).withColumn("held", language.held_out()).collect()
    assert {(r["doc_id"], r["held"]) for r in rows} == {
        (r["doc_id"], zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows}
    held = [r for r in rows if r["held"] and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_predictions_come_from_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs)
    for r in language.identify(docs, model).collect():
        assert (r["lang_pred"], r["score"]) == model.predict(r["text"])


def test_long_texts_are_counted_whole(monkeypatch):
    text = "éa bcd " * 1000
    whole = language.counts_of(text)
    monkeypatch.setattr(language, "STRIDE", 11)
    assert (language.counts_of(text) == whole).all()
    assert whole.sum() == len(text.strip().encode())


def test_edge_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 $$", "fr"), (4, "the and of", None), (None, "the and of", "en"),
            (5, "les des une", "fr"), (5, "les des une", "fr"), (6, "x" * 300000, "zz")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'kept' as Score", "9 as h", "8 as grams", "7 as own_Score")
    model = language.train(docs)
    found = language.identify(docs, model)
    got = [(r["doc_id"], r["lang_pred"]) for r in found.collect()]
    assert {(1, "und"), (2, "und"), (3, "und")} <= set(got) and len(got) == len(rows)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {4, None, 5, 6}
    assert {r["Score"] for r in kept.collect()} == {"kept"}
    empty = docs.where("false")
    assert language.identify(empty, language.train(empty)).count() == 0
    untaught = language.identify(docs, language.train(empty)).collect()
    assert {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}


def test_all_languages_are_learned(spark, monkeypatch):
    """Seventy labels with words of their own, the last one rare; the bound holds for each language."""
    words = {f"l{i:02}": f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 2}" for i in range(70)}
    rows = [(100 * i + j, f"{w} {w}{w[0]} {w}", k) for i, (k, w) in enumerate(words.items())
            for j in range(8 if k != "l69" else 6)]
    docs = spark.createDataFrame(rows, DOCS)
    model = language.train(docs)
    assert model.languages == {"other": sorted(words)}
    assert [model.predict(f"{w} {w}{w[0]}")[0] for w in words.values()] == list(words)

    learned = []
    train_svm = language.train_svm
    monkeypatch.setattr(language, "train_svm", lambda x, y: learned.append(len(y)) or train_svm(x, y))
    many = [(1000 * i + j, t, k) for i, (_, t, k) in enumerate(rows[::70]) for j in range(60)]
    language.train(spark.createDataFrame(many, DOCS), sample=30)
    assert len(learned) == 28 and min(learned) > 40


def test_numerals_are_no_letters():
    for text in ("²³", "Ⅷ", "½", "12_3", "", None, " ¼ ٣ Ⅻ "):
        assert language.counts_of(text) is None
    assert language.counts_of("²a") is not None and language.counts_of("日") is not None
