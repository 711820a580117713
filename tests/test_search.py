import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.functions.vectors import cosine_distance_sql
from shelfmark.operators.fulltext import analyze, postings
from shelfmark.operators.ranking import fuse, semantic_topk
from shelfmark.plans import search, table_functions
from shelfmark.plans.search import (
    format_results,
    hybrid_search_files,
    hybrid_search_functions,
    query_embedding,
)


def distance(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a array<float>, b array<float>")
    return row.select(F.expr(cosine_distance_sql("a", "b"))).first()[0]


def test_cosine_distance(spark):
    assert distance(spark, [1.0, 2.0], [2.0, 4.0]) == pytest.approx(0, abs=1e-12)
    assert distance(spark, [1.0, 0.0], [-1.0, 0.0]) == 2
    assert distance(spark, [0.0, 0.0], [1.0, 0.0]) != distance(spark, [0.0, 0.0], [1.0, 0.0])  # NaN
    assert distance(spark, None, [1.0]) is None
    with pytest.raises(PySparkException):
        distance(spark, [1.0], [1.0, 2.0])


FILES = [
    (1, 1, "a/one.py", "Parses the query text.", [1.0, 0.0]),
    (2, 1, "a/two.py", "Writes query results. Text output.", [0.8, 0.6]),
    (3, 2, "b/three.py", "Draws charts.", [0.0, 1.0]),
    (4, 2, "b/four.py", None, None),
    (5, 2, "b/five.py", "An empty vector.", [0.0, 0.0]),
]


@pytest.fixture(scope="module")
def files(spark):
    rows = spark.createDataFrame(
        FILES, "id long, project_id long, path string, summary string, embedding array<float>"
    )
    return analyze(rows, "concat(path, ' ', coalesce(summary, ''))").cache()


@pytest.fixture(scope="module")
def functions(spark):
    rows = spark.createDataFrame(
        [(10, 1, 1, "parse", "Parses text.", "def parse(): ...", [1.0, 0.0]),
         (11, 3, 2, "draw", "Draws.", "def draw(): ...", [0.0, 1.0])],
        "id long, file_id long, project_id long, name string, summary string, body string, "
        "embedding array<float>",
    )
    return analyze(rows, "concat(name, ' ', coalesce(summary, ''))").cache()


def ids(frame):
    return [r["id"] for r in frame.collect()]


def test_zero_vectors_come_last(files):
    assert ids(semantic_topk(files, [1.0, 0.0], 10).orderBy("rank")) == [1, 2, 3, 5]


def test_fusion(spark):
    ranks = "id long, rank int"
    s = spark.createDataFrame([(1, 1), (2, 2)], ranks)
    k = spark.createDataFrame([(1, 2), (3, 1)], ranks)
    got = {r["id"]: r["rrf_score"] for r in fuse(s, k, 60).collect()}
    assert got == {1: pytest.approx(1 / 61 + 1 / 62), 2: pytest.approx(1 / 62), 3: pytest.approx(1 / 61)}


def test_hybrid_search_files(files):
    rows = hybrid_search_files(files, [0.0, 1.0], "text queries").collect()
    # By distance 3, 2, 1, 5; by keyword 1 (adjacent words), 2 (one word between).
    assert [r["id"] for r in rows] == [1, 2, 3, 5]
    assert [r["rrf_score"] for r in rows] == [
        pytest.approx(s) for s in (1 / 61 + 1 / 63, 1 / 62 + 1 / 62, 1 / 61, 1 / 64)
    ]


def test_filters_and_counts(files):
    assert set(ids(hybrid_search_files(files, [1.0, 0.0], "query", p_project_id=1))) == {1, 2}
    assert ids(hybrid_search_files(files, [1.0, 0.0], "query", p_file_id=2)) == [2]
    assert ids(hybrid_search_files(files, [1.0, 0.0], "query", p_project_id=9)) == []
    assert ids(hybrid_search_files(files, [1.0, 0.0], "query", match_count=0)) == []
    assert len(ids(hybrid_search_files(files, [1.0, 0.0], "query", match_count=2))) == 2


@pytest.mark.parametrize("text", ["query text", "query or draws", "query -parses", '"query text"', "-query", "the"])
def test_postings_ids_and_sql_give_the_same(spark, files, text):
    plain = hybrid_search_files(files, [0.6, 0.8], text).collect()
    assert plain == hybrid_search_files(
        files, [0.6, 0.8], text, postings=postings(files), fetch="ids"
    ).collect()
    files.createOrReplaceTempView("search_files")
    table_functions.create_file_search(spark, "find_files", "search_files")
    called = table_functions.call(spark, "find_files", [0.6, 0.8], text)
    assert sorted(map(tuple, called.collect())) == sorted(map(tuple, plain))


def test_long_id_lists_are_fetched_in_parts(files, monkeypatch):
    wanted = hybrid_search_files(files, [0.6, 0.8], "query").collect()
    monkeypatch.setattr(search, "IDS_IN_A_FILTER", 1)
    assert hybrid_search_files(files, [0.6, 0.8], "query").collect() == wanted and len(wanted) > 1


def test_sql_function_broadcasts_its_winners(spark, functions, files):
    functions.createOrReplaceTempView("search_functions")
    files.createOrReplaceTempView("search_files")
    table_functions.create_function_search(spark, "find_functions", "search_functions", "search_files")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        called = table_functions.call(spark, "find_functions", [1.0, 0.0], "parsing")
        plan = called._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("BroadcastHashJoin") == 2


def test_sql_arguments(spark, files):
    files.createOrReplaceTempView("search_files")
    table_functions.create_file_search(spark, "find_files", "search_files")
    called = table_functions.call(
        spark, "find_files", [1.0, 0.0], "query", p_project_id=1, match_count=1, rrf_k=1
    )
    wanted = hybrid_search_files(files, [1.0, 0.0], "query", p_project_id=1, match_count=1, rrf_k=1)
    assert called.collect() == wanted.collect()
    table_functions.drop(spark, "find_files")
    with pytest.raises(PySparkException):
        table_functions.call(spark, "find_files", [1.0, 0.0], "query").collect()


def test_hybrid_search_functions(spark, functions, files):
    rows = hybrid_search_functions(functions, files, [1.0, 0.0], "parsing").collect()
    assert [(r["id"], r["path"], r["body"]) for r in rows] == [
        (10, "a/one.py", "def parse(): ..."), (11, "b/three.py", "def draw(): ..."),
    ]
    functions.createOrReplaceTempView("search_functions")
    files.createOrReplaceTempView("search_files")
    table_functions.create_function_search(spark, "find_functions", "search_functions", "search_files")
    called = table_functions.call(spark, "find_functions", [1.0, 0.0], "parsing")
    assert sorted(map(tuple, called.collect())) == sorted(map(tuple, rows))


def test_dimension_mismatch_is_an_error(files):
    with pytest.raises(PySparkException):
        hybrid_search_files(files, [1.0, 0.0, 0.0], "query").collect()


def test_format_results(spark):
    results = spark.createDataFrame(
        [(1, 7, "a.py", "x" * 130, 0.03278), (2, 7, "b.py", None, 0.5), (3, 8, "c.py", "", 0.1)],
        "id long, project_id long, path string, summary string, rrf_score double",
    )
    assert [tuple(r) for r in format_results(results).orderBy("rank").collect()] == [
        (1, " 1. [0.5000] (project 7) b.py", None),
        (2, " 2. [0.1000] (project 8) c.py", None),
        (3, " 3. [0.0328] (project 7) a.py", "    " + "x" * 120 + "..."),
    ]


def test_query_embedding_is_a_unit_vector(spark):
    vector = query_embedding(spark, "search for text", 16)
    assert len(vector) == 16 and sum(v * v for v in vector) == pytest.approx(1)
    assert query_embedding(spark, "", 4) == [0, 0, 0, 0]
