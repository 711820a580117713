"""What an update moves: rows meet the few ids that change where they lie."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import identity
from shelfmark.operators.fulltext import changed_postings, postings
from shelfmark.plans import indexing
from shelfmark.sources.store import TableStore
from test_indexing import DAY, metadata, scan


@pytest.fixture
def no_broadcast(spark):
    """Joins that Spark would broadcast by size alone are sorted."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_few_ids_are_broadcast_and_many_are_not(spark, no_broadcast, monkeypatch):
    ids = spark.range(10).union(spark.range(10))
    few = spark.range(30).join(identity.few_ids(ids), "id", "left_anti")
    monkeypatch.setattr(identity, "FEW_IDS", 9)
    many = spark.range(30).join(identity.few_ids(ids), "id", "left_anti")
    assert "BroadcastHashJoin" in plan_of(few) and "BroadcastHashJoin" not in plan_of(many)
    assert sorted(r[0] for r in few.collect()) == sorted(r[0] for r in many.collect()) == list(range(10, 30))


def test_kept_postings_stay_where_they_lie(spark, no_broadcast, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path), 4)
    rows = spark.createDataFrame([(i, 1, ["a", "b", f"w{i}"]) for i in range(40)], "id long, project_id long, fts array<string>")
    run = store.begin(DAY[0])
    run.replace("file_postings", postings(rows))
    removed = run.set_aside("removed", store.rows("file_postings").where("id < 5").select("id", "term"))
    written = []
    overwrite = store._overwrite
    monkeypatch.setattr(store, "_overwrite", lambda t, r, b: written.append(plan_of(r)) or overwrite(t, r, b))
    run.update("file_postings", store.rows("file_postings").limit(0), removed)
    assert "BroadcastHashJoin" in written[0] and "SortMergeJoin" not in written[0]
    assert {r[0] for r in store.read("file_postings").select("id").collect()} == set(range(5, 40))


def test_changed_postings_move_no_lexemes(spark, no_broadcast):
    kind = "id long, project_id long, fts array<string>"
    old = spark.createDataFrame([(1, 1, ["a", "b"]), (2, 1, ["a"]), (3, 1, ["c"]), (4, 1, None), (5, 1, ["x", "y"])], kind)
    new = spark.createDataFrame([(1, 1, ["a", "b"]), (2, 2, ["a"]), (3, 1, ["c", "c"]), (4, 1, None), (6, 1, ["n"])], kind)
    changed = changed_postings(old, new)
    assert {(r["id"], r["term"], r["project_id"], tuple(r["positions"]), r["comes"]) for r in changed.collect()} == {
        (2, "a", 1, (1,), False), (2, "a", 2, (1,), True), (3, "c", 1, (1,), False), (3, "c", 1, (1, 2), True),
        (5, "x", 1, (1,), False), (5, "y", 1, (2,), False), (6, "n", 1, (1,), True)}
    assert "Exchange hashpartitioning" not in plan_of(changed.where(F.lit(True))).split("BroadcastExchange")[0]


def test_only_differing_contents_are_joined(spark, tmp_path, monkeypatch):
    seen = []
    found = indexing.differing_files
    monkeypatch.setattr(indexing, "differing_files", lambda known, contents, *rest: seen.append(
        (known.count(), {r["path"] for r in contents.collect()})) or found(known, contents, *rest))
    store = TableStore(spark, str(tmp_path), 4)
    first = {f"f{i}.py": f"def f{i}():\n    return {i}\n" for i in range(6)}
    indexing.run_index(store, scan(spark, first), metadata(spark), DAY[0])
    indexing.run_index(store, scan(spark, {**first, "f2.py": "def g():\n    return 1\n", "new.py": "x = 1\n"}), metadata(spark), DAY[1])
    assert seen == [(0, set(first)), (1, {"f2.py", "new.py"})]
    assert {r["name"] for r in store.read("functions").collect()} == {"f0", "f1", "g", "f3", "f4", "f5"}
