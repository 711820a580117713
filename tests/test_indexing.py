import re
from datetime import datetime
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfmark.functions.text import PLAIN
from shelfmark.operators.enrichment import batch_model
from shelfmark.operators.files import differing_files, file_states, files_for_language, scanned_keys, with_new_ids
from shelfmark.operators.fulltext import keyword_scores_from_postings, postings, web_query
from shelfmark.operators.projects import project_digests
from shelfmark.operators.definitions import enrich_functions, stale_functions
from shelfmark.plans.indexing import run_index
from shelfmark.plans.table_functions import call, create_function_search
from shelfmark.plans.search import hybrid_search_files, hybrid_search_functions, query_embedding
from shelfmark.schemas import METADATA, SCAN
from shelfmark.sources.repositories import scan_repositories, scan_repository
from shelfmark.sources.store import POSTINGS, TableStore
from shelfmark.streaming.file_drops import index_file_drops

URL = "https://h/u/repo.git"
OTHER = "git@h:u/plain.git"
DAY = [datetime(2024, 1, d) for d in range(1, 10)]
ONE = "def first():\n    return 'One sentence here.'\n\n\ndef second():\n    return 'Two. Three.'\n"


def scan(spark, files, url=URL):
    rows = [(url, path, bytearray(text.encode() if isinstance(text, str) else text))
            for path, text in files.items()]
    return spark.createDataFrame(rows, SCAN)


def metadata(spark, *urls):
    return spark.createDataFrame([(u, "refs/remotes/origin/main", None) for u in urls or (URL,)], METADATA)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "state"), buckets=16)


def rows(store, table, *columns):
    return {tuple(r) for r in store.read(table).select(*columns).collect()}


def test_first_run_and_rerun(spark, store):
    files = {"a.py": ONE, "b.js": "function x() {}", "X.PY": "ignored. ", "c.py": b"# bad \xff.\n"}
    report = run_index(store, scan(spark, files), metadata(spark), DAY[0], with_postings=True)
    assert (report.version, report.upserted, report.deleted) == (1, 2, 0)
    assert rows(store, "projects", "name", "language", "default_branch") == {("repo", "Python", "main")}
    assert {p for (p,) in rows(store, "files", "path")} == {"a.py", "c.py"}
    assert ("c.py", "# bad �.\n") in rows(store, "files", "path", "body")
    assert rows(store, "functions", "name", "start_line", "summary") == {
        ("first", 1, "def first():\n    return 'One sentence here."), ("second", 5, "def second():\n    return 'Two. Three."),
    }
    assert store.read("file_postings").where("term = 'a.py'").count() == 1

    before = {t: rows(store, t, "id", "summary", "checksum") for t in ("files", "functions")}
    again = run_index(store, scan(spark, files), metadata(spark), DAY[1])
    assert (again.version, again.changes) == (2, {})
    assert before == {t: rows(store, t, "id", "summary", "checksum") for t in ("files", "functions")}
    assert rows(store, "files", "last_updated") == {(DAY[1],)}
    assert rows(store, "functions", "last_updated") == {(DAY[0],)}


def test_changed_shifted_and_missing(spark, store):
    run_index(store, scan(spark, {"a.py": ONE, "gone.py": "def g(): return 'G.'\n"}), metadata(spark), DAY[0])
    old = {r["name"]: r["id"] for r in store.read("functions").collect()}
    edited = ONE.replace("Two.", "Edited.")
    report = run_index(store, scan(spark, {"a.py": edited}), metadata(spark), DAY[1])
    assert report.changes == {"changed": 1, "unchanged": 1}
    now = {r["name"]: (r["id"], r["last_updated"]) for r in store.read("functions").collect()}
    assert now == {"first": (old["first"], DAY[0]), "second": (old["second"], DAY[1]),
                   "g": (old["g"], DAY[0])}
    shifted = edited.replace("\n\n\n", "\n\n\n\n")
    report = run_index(store, scan(spark, {"a.py": shifted}), metadata(spark), DAY[2])
    assert report.changes == {"unchanged": 1, "removed": 1, "new": 1}
    second = store.read("functions").where("name = 'second'").first()
    assert second["id"] > max(old.values()) and second["start_line"] == 6
    assert {p for (p,) in rows(store, "files", "path")} == {"a.py", "gone.py"}


@pytest.mark.parametrize("strict, summary", [(False, "# New."), (True, "# Old.")])
def test_changed_file_summary(spark, store, strict, summary):
    for day, text in enumerate(("# Old.\n", "# New.\n")):
        run_index(store, scan(spark, {"a.py": text}), metadata(spark), DAY[day], strict_compat=strict)
    assert rows(store, "files", "summary", "body") == {(summary, "# New.\n")}


def test_projects_without_language_and_language_changes(spark, store):
    both = scan(spark, {"a.py": ONE}).union(scan(spark, {"README": "x", "x.md": "y"}, OTHER))
    run_index(store, both, metadata(spark, URL, OTHER), DAY[0])
    assert rows(store, "projects", "name", "language") == {("repo", "Python"), ("plain", None)}
    assert store.read("files").count() == 1
    kept = rows(store, "projects", "id", "git_url")
    go = scan(spark, {"a.go": "package x. ", "b.go": "package y. "})
    run_index(store, go, metadata(spark), DAY[1])
    assert rows(store, "projects", "name", "language") == {("repo", "Go"), ("plain", None)}
    assert kept == rows(store, "projects", "id", "git_url")
    assert rows(store, "functions", "name") == {("first",), ("second",)}


def test_batch_model_sees_flagged_rows_only(spark, store):
    def make():
        def summarize(path, body):
            return pd.Series([f"{p} has {len(b)} characters" for p, b in zip(path, body)])
        return summarize

    def make_vectors():
        return lambda summary: pd.Series([[float(len(s)), 1.0] for s in summary])

    options = {"summarize_file": batch_model(make, "string"), "embed": batch_model(make_vectors, "array<float>")}
    run_index(store, scan(spark, {"a.py": ONE, "b.py": "x = 1\n"}), metadata(spark), DAY[0], **options)
    assert rows(store, "files", "path", "summary") == {
        ("a.py", f"a.py has {len(ONE)} characters"), ("b.py", "b.py has 6 characters"),
    }
    assert all(len(r["embedding"]) == 2 for r in store.read("files").collect())

    def make_failing():
        def summarize(path, body):
            assert list(path) == ["b.py"]
            return pd.Series(["again"])
        return summarize

    options["summarize_file"] = batch_model(make_failing, "string")
    run_index(store, scan(spark, {"a.py": ONE, "b.py": "x = 2\n"}), metadata(spark), DAY[1], **options)
    assert ("b.py", "again") in rows(store, "files", "path", "summary")


def test_failed_run_changes_nothing(spark, store):
    run_index(store, scan(spark, {"a.py": ONE}), metadata(spark), DAY[0])
    broken = scan(spark, {"a.py": "def other(): pass\n"})
    with pytest.raises(ValueError):
        run_index(store, broken.union(broken), metadata(spark), DAY[1])
    assert store.version == 1
    assert rows(store, "functions", "name") == {("first",), ("second",)}


def test_search_after_indexing(spark, store):
    files = {"a.py": "# Parses queries.\n", "b.py": "# Draws charts.\n"}
    run_index(store, scan(spark, files), metadata(spark), DAY[0], with_postings=True)
    found = hybrid_search_files(
        store.read("files"), query_embedding(spark, "draws charts"), "drawing chart",
        postings=store.read("file_postings"), fetch="ids",
    ).collect()
    assert [r["path"] for r in found] == ["b.py", "a.py"]
    one_word = keyword_scores_from_postings(store.read("file_postings"), web_query(spark, "charts"))
    assert "Exchange" not in one_word._jdf.queryExecution().executedPlan().toString()


def test_cascading_delete(spark, store):
    both = scan(spark, {"a.py": ONE}).union(scan(spark, {"z.py": ONE}, OTHER))
    run_index(store, both, metadata(spark, URL, OTHER), DAY[0], with_postings=True)
    removed = store.read("projects").where(F.col("git_url") == OTHER).select("id")
    assert store.delete_projects(removed, DAY[1]) == 2
    assert [store.read(t).count() for t in ("projects", "files", "functions")] == [1, 1, 2]
    assert rows(store, "projects", "git_url") == {(URL,)}
    assert rows(store, "file_postings", "project_id") == rows(store, "projects", "id")


def partitions(store, table):
    """The data files of each partition of a table."""
    found = {}
    for path in sorted(Path(store.folder, table).glob("bucket=*/*.parquet")):
        found.setdefault(int(path.parent.name.split("=")[1]), []).append(path.name)
    return found


def rewritten(before, after):
    return {b for b in after if before.get(b) != after[b]}


def test_only_touched_partitions_are_written(spark, store):
    files = {f"f{i}.py": ONE.replace("first", f"first{i}") for i in range(20)}
    run_index(store, scan(spark, files), metadata(spark), DAY[0], analyzer=PLAIN, with_postings=True)
    tables = ("files", "functions", "file_postings", "function_postings")
    before = {t: partitions(store, t) for t in tables}
    run_index(store, scan(spark, files), metadata(spark), DAY[1], analyzer=PLAIN)
    assert before == {t: partitions(store, t) for t in tables}
    files["f7.py"] = files["f7.py"].replace("Two.", "Edited.")
    run_index(store, scan(spark, files), metadata(spark), DAY[2], analyzer=PLAIN)
    after = {t: partitions(store, t) for t in tables}
    id_ = store.read("files").where("path = 'f7.py'").first()["id"]
    for table, column in (("files", "id"), ("functions", "file_id")):
        expected = {r["bucket"] for r in store.rows(table).where(f"{column} = {id_}").collect()}
        assert rewritten(before[table], after[table]) == expected and len(expected) == 1
    for table in ("file_postings", "function_postings"):
        touched = rewritten(before[table], after[table])
        of_row = store.rows(table).where("term = 'edited'").first()
        changed = postings(store.read(POSTINGS[table]).where(F.col("id") == of_row["id"]))
        own = {r["bucket"] for r in changed.select(store.bucket(table).alias("bucket")).collect()}
        assert own <= touched and len(touched - own) <= 1  # 'two' has gone
        assert len(touched) < len(after[table])
    assert rows(store, "files", "last_updated") == {(DAY[2],)}
    assert store.read("files").where("path = 'f7.py'").first()["body"] == files["f7.py"]
    narrow = store.read("files").select("id", "path")
    assert "Join" not in narrow._jdf.queryExecution().optimizedPlan().toString()
    found = hybrid_search_functions(
        store.read("functions"), store.read("files"), query_embedding(spark, "edited"), "edited", match_count=1, analyzer=PLAIN,
        postings=store.read("function_postings"), postings_buckets=store.buckets,
    ).collect()
    assert [(r["path"], r["name"], "Edited." in r["body"]) for r in found] == [("f7.py", "second", True)]


def test_unchanged_run_reads_no_file_and_no_function(spark, store, monkeypatch):
    both = scan(spark, {"a.py": ONE}).union(scan(spark, {"z.py": ONE}, OTHER))
    run_index(store, both, metadata(spark, URL, OTHER), DAY[0], analyzer=PLAIN, with_postings=True)
    read = []
    original = store.rows
    monkeypatch.setattr(store, "rows", lambda table: read.append(table) or original(table))
    run_index(store, both, metadata(spark, URL, OTHER), DAY[1], analyzer=PLAIN)
    assert set(read) == {"projects"}
    monkeypatch.undo()
    assert rows(store, "files", "path", "last_updated") == {("a.py", DAY[1]), ("z.py", DAY[1])}
    assert rows(store, "functions", "last_updated") == {(DAY[0],)}


def test_files_that_go_and_come_back(spark, store):
    """A file that has gone from the scan keeps its time until it is back."""
    for day, files in enumerate(({"a.py": ONE, "b.py": ONE}, {"a.py": ONE}, {"a.py": ONE}, {"a.py": ONE, "b.py": ONE})):
        run_index(store, scan(spark, files), metadata(spark), DAY[day], analyzer=PLAIN)
        times = dict(rows(store, "files", "path", "last_updated"))
        assert times == {"a.py": DAY[day], "b.py": DAY[0 if day in (1, 2) else day]}
    assert len(rows(store, "functions", "id")) == 4


def test_same_files_in_the_other_order(spark):
    keys = [(1, "a", "x"), (1, "b", "y"), (2, "a", "x"), (3, "a", "y"), (3, "a", "y")]
    one, other = (project_digests(spark.createDataFrame(k, "project_id long, path string, checksum string")).collect()
                  for k in (keys, keys[::-1]))
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
    assert len({r["digest"] for r in one}) == 3


def test_equal_contents_are_not_exchanged(spark, store):
    """Contents meet the keys that differ where they are; only these are moved to their partition."""
    files = {f"{i}.py": f"# File {i}.\n" for i in range(30)}
    run_index(store, scan(spark, files), metadata(spark), DAY[0], analyzer=PLAIN)
    contents = scan(spark, {**files, "3.py": "# New.\n"}).withColumn("body", F.col("content").cast("string"))
    stored = store.rows("files")
    keys = scanned_keys(contents, store.rows("projects"))
    states = store.begin(DAY[1]).set_aside("states", with_new_ids(file_states(stored, keys), 100))
    found = differing_files(stored, contents, states, ["git_url", "path"])
    assert [r["path"] for r in found.collect()] == ["3.py"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and not re.search(r"(?<!Broadcast)Exchange", plan), plan


def test_a_run_that_broke_off_is_made_good(spark, store):
    run_index(store, scan(spark, {"a.py": ONE, "b.py": ONE}), metadata(spark), DAY[0], analyzer=PLAIN, with_postings=True)
    broken = store.begin(DAY[1])
    broken.update("function_postings", store.rows("function_postings").limit(0), store.rows("function_postings"))
    broken.update("functions", store.rows("functions").limit(0), broken.set_aside("x", store.rows("functions").where("name = 'first'")))
    assert store.read("function_postings").count() == 0 and store.version == 1
    edited = {"a.py": ONE.replace("Two.", "Edited."), "b.py": ONE + "# more\n"}
    run_index(store, scan(spark, edited), metadata(spark), DAY[2], analyzer=PLAIN)
    assert store.version == 3
    expected = postings(store.read("functions")).select("term", "id", "project_id", "positions")
    assert sorted(map(str, store.read("function_postings").drop("bucket").collect())) == sorted(map(str, expected.collect()))
    assert rows(store, "functions", "name") == {("first",), ("second",)}


def test_sql_search_reads_bodies_of_the_winners_partitions(spark, store):
    files = {f"f{i}.py": ONE.replace("One", f"Number {i}") for i in range(12)}
    run_index(store, scan(spark, files), metadata(spark), DAY[0], analyzer=PLAIN)
    store.rows("functions").createOrReplaceTempView("stored_functions")
    store.read("files").createOrReplaceTempView("stored_files")
    vector = query_embedding(spark, "number 7")
    create_function_search(spark, "near_functions", "stored_functions", "stored_files", PLAIN, store.buckets)
    found = call(spark, "near_functions", vector, "number 7", match_count=1)
    assert [(r["path"], "Number 7" in r["body"]) for r in found.collect()] == [("f7.py", True)]
    scans = [line for line in found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).splitlines() if "FileScan" in line]
    with_body = [line for line in scans if re.search(r"\bbody#", line)]
    assert with_body and all("dynamicpruning" in line for line in with_body)
    create_function_search(spark, "all_functions", "stored_functions", "stored_files", PLAIN)
    assert found.collect() == call(spark, "all_functions", vector, "number 7", match_count=1).collect()


def test_moved_functions_keep_their_enrichment(spark, store):
    text = ONE + "\n\n" + ONE.replace("second", "third")
    run_index(store, scan(spark, {"a.py": text}), metadata(spark), DAY[0], analyzer=PLAIN)
    before = rows(store, "functions", "name", "start_line", "summary")

    def failing():
        raise AssertionError("a model was called")

    report = run_index(
        store, scan(spark, {"a.py": "# a line\n" + text}), metadata(spark), DAY[1], analyzer=PLAIN,
        summarize_function=batch_model(failing, "string"), carry_enrichment=True)
    assert (report.upserted, report.deleted) == (4, 4)
    assert rows(store, "functions", "name", "start_line", "summary") == {(n, at + 1, s) for n, at, s in before}
    assert store.read("functions").where("embedding IS NULL OR fts IS NULL").count() == 0


def test_emptied_partitions(spark, store):
    run_index(store, scan(spark, {"a.py": ONE}), metadata(spark), DAY[0], analyzer=PLAIN, with_postings=True)
    assert store.delete_projects(store.read("projects").select("id"), DAY[1]) == 2
    for table in ("projects", "files", "functions", "file_postings", "function_postings"):
        assert store.read(table).count() == 0


def test_a_run_leaves_other_projects_alone(spark, store):
    text = "def first(): pass\n"  # without a sentence: summarised once all the same
    both = scan(spark, {"a.py": text}).union(scan(spark, {"z.py": text}, OTHER))
    run_index(store, both, metadata(spark, URL, OTHER), DAY[0])
    assert rows(store, "functions", "summary") == {("",)}
    assert all(set(r["embedding"]) == {0.0} for r in store.read("functions").collect())

    def failing():
        raise AssertionError("a model was called")

    model = batch_model(failing, "string")
    before = rows(store, "functions", "id", "last_updated")
    run_index(store, scan(spark, {"a.py": text}), metadata(spark), DAY[1], summarize_function=model)
    assert rows(store, "functions", "id", "last_updated") == before
    other = store.read("projects").where(F.col("git_url") == OTHER).select("id")
    lacking = store.read("functions").withColumn("summary", F.lit(None).cast("string"))
    enriched = enrich_functions(lacking, store.read("files"), DAY[2], projects=other)
    assert enriched.where("summary IS NOT NULL").count() == 1
    assert stale_functions(lacking, store.read("files"), other).count() == 1


def test_scanning_folders(spark, tmp_path):
    root = tmp_path / "check outs"
    for path, content in {
        "one/a.py": b"x", "one/sub dir/ä.py": b"\xff", "one/.git/config.py": b"no", "two/b.py": b"y",
        "left/c.py": b"z", "one/__init__.py": b"i", "one/.hidden/_x.py": b"h", "one/node_modules/.git": b"no",
        "one/node_modules/d.js": b"d",
    }.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content)
    single = scan_repository(spark, str(root / "one"), URL).collect()
    assert {(r["git_url"], r["path"], bytes(r["content"])) for r in single} == {
        (URL, "a.py", b"x"), (URL, "sub dir/ä.py", b"\xff"), (URL, "__init__.py", b"i"), (URL, ".hidden/_x.py", b"h"),
        (URL, "node_modules/d.js", b"d"),
    }
    tracked = spark.createDataFrame([(p,) for p in ("a.py", "__init__.py", ".hidden/_x.py", "gone.py")], "path string")
    assert {r["path"] for r in scan_repository(spark, str(root / "one"), URL, tracked).collect()} == {
        "a.py", "__init__.py", ".hidden/_x.py"}
    checkouts = spark.createDataFrame([("one", URL), ("two", OTHER)], "folder string, git_url string")
    many = scan_repositories(spark, str(root), checkouts).collect()
    assert {(r["git_url"], r["path"]) for r in many} == {
        (URL, "a.py"), (URL, "sub dir/ä.py"), (OTHER, "b.py"), (URL, "__init__.py"), (URL, ".hidden/_x.py"),
        (URL, "node_modules/d.js"),
    }


def test_file_drops(spark, store, tmp_path):
    drops, progress = str(tmp_path / "drops"), str(tmp_path / "progress")

    def index():
        index_file_drops(
            spark, store, drops,
            lambda batch: batch.select("git_url").distinct().select(
                "git_url", F.lit("x/main").alias("symbolic_ref"), F.lit(None).cast("string").alias("remote_text")),
            lambda number: DAY[number], progress,
        ).awaitTermination()

    scan(spark, {"a.py": ONE}).write.parquet(drops)
    index()
    assert store.version == 1
    index()
    assert store.version == 1
    scan(spark, {"a.py": "def first():\n    return 'One sentence here.'\n"}).write.mode("append").parquet(drops)
    index()
    assert store.version == 2
    assert rows(store, "functions", "name") == {("first",)}


def test_contents_of_a_large_project_are_spread(spark):
    listing = spark.createDataFrame([(URL, f"{i}.py") for i in range(100)], "git_url string, path string")
    projects = spark.createDataFrame([(1, URL, "Python")], "id long, git_url string, language string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chosen = files_for_language(listing, projects)
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert chosen.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert re.search(r"hashpartitioning\([^)]*_slot", plan)
