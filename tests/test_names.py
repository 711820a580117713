import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfmark.functions.content import checksum, decode_lossy
from shelfmark.functions.naming import (
    counted_language,
    default_branch,
    indexed_language,
    path_suffix,
    repo_name,
)
from shelfmark.functions.sentences import lead_sentences
from shelfmark.operators.projects import primary_language


def column(spark, values, expression, data_type="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {data_type}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_repo_name(spark):
    urls = ["https://h/u/repo.git", "git@h:u/repo.git", "git@h:repo.git", "https://h/x.git///", "a.git.git"]
    assert column(spark, urls, repo_name) == ["repo", "repo", "repo", "x", "a.git"]


def test_path_suffix(spark):
    paths = ["a/b.py", ".bashrc", "a.tar.gz", "foo.", "noext", "A.R", "d.x/noext", "é/ü.ts"]
    assert column(spark, paths, path_suffix) == [".py", "", ".gz", "", "", ".R", "", ".ts"]


def test_language_case(spark):
    paths = ["X.PY", "a.R", "a.r", "a.h", "a.m", "x.md", "README"]
    assert column(spark, paths, counted_language) == ["Python", "R", "R", "C", "Objective-C", None, None]
    assert column(spark, paths, indexed_language) == [None, "R", "R", "C", "Objective-C", None, None]


def test_default_branch(spark):
    rows = spark.createDataFrame(
        [
            ("refs/remotes/origin/main", None),
            ("refs/remotes/origin/feature/x", None),
            (None, "* remote origin\n  Fetch URL: x\n  HEAD branch: dev\n  Remote branch:\n"),
        ],
        "ref string, text string",
    )
    got = [r[0] for r in rows.select(default_branch(F.col("ref"), F.col("text"))).collect()]
    assert got == ["main", "x", "dev"]
    neither = spark.createDataFrame([(None, "nothing")], "ref string, text string")
    with pytest.raises(PySparkException):
        neither.select(default_branch(F.col("ref"), F.col("text"))).collect()


def test_primary_language(spark):
    listing = spark.createDataFrame(
        [
            ("one", "X.PY"),
            ("tie", "b.py"), ("tie", "a.js"),
            ("none", "README"), ("none", "x.md"),
            ("most", "a.js"), ("most", "b.py"), ("most", "c.py"),
        ],
        "git_url string, path string",
    )
    got = {r["git_url"]: r["language"] for r in primary_language(listing).collect()}
    assert got == {"one": "Python", "tie": "JavaScript", "most": "Python"}


def test_lossy_decoding_equals_python(spark):
    samples = [b"a\xffb", b"a\xe2\x82b", b"\xed\xa0\x80", b"a\x00b", b"", "é𝒳".encode(), b"\xf0\x9f\x98"]
    decoded = column(spark, samples, decode_lossy, "binary")
    assert decoded == [s.decode("utf-8", errors="replace") for s in samples]
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert column(spark, [b""], checksum, "binary") == [empty]


def test_lead_sentences(spark):
    texts = ["One. Two! Three?", " no end", "", "  A.  \n", None]
    assert column(spark, texts, lambda c: lead_sentences(c, 2)) == ["One. Two!", "", "", "A.", ""]
