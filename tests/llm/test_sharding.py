import zlib
from collections import Counter

from pyspark.sql import functions as F

from shelfmark.llm import sharding
from shelfmark.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def check_law(rows, shards):
    """Row counts at most one apart, slots without a gap."""
    slots = {s: [] for s in range(shards)}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_query_keeps_its_law(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op12_sharding"](spark, folder).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check_law(rows, 16)
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (
            len(data) + 1, zlib.crc32(data), "rows", None)


def test_nothing_runs_outside_the_jvm(spark):
    plan = QUERIES["op12_sharding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_order_is_random_and_repeatable(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))

    def order(seed, **options):
        placed = sharding.shuffled(docs, seed, **options).select("position", "doc_id").collect()
        assert sorted(p for p, _ in placed) == list(range(4000))
        return [i for _, i in sorted(tuple(r) for r in placed)]

    first = order(1)
    assert first == order(1) != order(2)
    few = order(1, least_buckets=1)  # one bucket: its Fisher-Yates order is all there is
    for found in (first, few):
        assert abs(sum(i * p for p, i in enumerate(found)) / 4000 - 1999.5 ** 2) < 0.1 * 1999.5 ** 2
        assert sum(a + 1 == b for a, b in zip(found, found[1:])) < 20
    small = order(1, bucket_bytes=66 * 100, least_buckets=1)
    assert small != few


def test_edge_cases(spark, tmp_path):
    rows = [(1, "a"), (1, "a"), (None, None), (None, None), (2, ""), (3, "ü" * 200_000)] + [(7, "copy")] * 30
    docs = spark.createDataFrame(rows, DOCS).selectExpr(
        "*", "'s' as Shard", "1 as slot", "2 as bucket", "3 as position", "4 as place", "5 as `order`", "6 as n", "7 as start")
    placed = sharding.into_shards(docs, 5)
    assert placed.columns == ["doc_id", "text", "bucket", "position", "place", "order", "n", "start", "shard", "slot"]
    found = placed.collect()
    check_law(found, 5)
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(rows)
    sizes = docs.select("doc_id", sharding.record_size().alias("s")).collect()
    assert {r["s"] for r in sizes if r["doc_id"] is None} == {1} and max(r["s"] for r in sizes) == 400_001
    assert sharding.into_shards(docs.where("false"), 5).count() == 0
    check_law(sharding.into_shards(docs.limit(3), 5).collect(), 5)
    sharding.write_shards(docs, str(tmp_path / "out"), 5)
    stored = spark.read.parquet(str(tmp_path / "out"))
    check_law(stored.collect(), 5)
    assert Counter((r["doc_id"], r["text"]) for r in stored.collect()) == Counter(rows)
