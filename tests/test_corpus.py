import pytest
from pyspark.sql import functions as F

from shelfmark.operators.definitions import extract_definitions
from workload import corpus, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def moved(monkeypatch):
    """Columns of the stored tables whose rows are brought together."""
    seen = []
    clustered = corpus.clustered
    monkeypatch.setattr(corpus, "_STORED", {})
    monkeypatch.setattr(corpus, "clustered", lambda rows, by: seen.append(set(rows.columns)) or clustered(rows, by))
    return seen


def test_stored_texts_stay_where_they_are_analysed(spark, moved):
    texts = queries._stored_texts(spark, FOLDER)
    assert texts.count() == corpus.table(spark, FOLDER, "documents").count()
    assert not moved


def test_postings_need_no_stored_texts(spark, moved):
    assert queries.QUERIES["keyword_topk_postings"](spark, FOLDER).count() == 20
    assert [name for _, _, name in corpus._STORED] == ["text_postings"] and not moved


def test_stored_files_leave_texts_behind(spark, moved):
    found = queries._stored_files(spark, FOLDER)
    assert len(moved) == 1 and not moved[0] & {"body", "text"}
    same = corpus.files(spark, FOLDER).select(*found.columns)
    assert found.exceptAll(same).isEmpty() and same.exceptAll(found).isEmpty()


def test_script_files_go_to_python_row_by_row(spark):
    rows = spark.range(1).select(
        F.col("id").alias("file_id"), F.lit("JavaScript").alias("language"), F.lit("function f() {}").alias("body"))
    plan = extract_definitions(rows)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
