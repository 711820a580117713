import re
from functools import reduce

import pytest

from shelfmark.llm import decontamination as d

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def brute(docs, items):
    """Every document against every item."""
    def grams(words, n):
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    out = []
    for doc, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        for item, wanted in items:
            own = re.findall(r"\w+", (wanted or "").lower())
            if own:
                n = min(5, len(own))
                q = grams(own, n)
                shared = len(q & grams(words, n))
                if 10 * shared >= 8 * len(q):
                    out.append((doc, item, len(q), shared))
    return sorted(out, key=str)


def pairs(frame):
    return sorted([tuple(r)[:4] for r in frame.collect()], key=str)


@pytest.mark.parametrize("block", [d.BLOCK_BYTES, 3000])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_BYTES", block)
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = pairs(d.leaked_pairs(docs, items))
    want = brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert got == want and len(want) > 5
    kept = d.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {p[0] for p in want}


def test_many_blocks_are_searched_one_at_a_time(spark, monkeypatch):
    # Each block is a job of its own, so that the plan of the result holds no Python stage at all.
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(60))) for i in range(40)] + [(90, None), (91, ""), (3, "clean")]
    items = [(i, " ".join(f"d{i}w{j}" for j in range(5, 30))) for i in range(0, 40, 8)] + [(7, "repeated words")] * 300
    rows += [(92, "some repeated words here"), (92, "some repeated words here")]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    want = brute(rows, items)
    assert pairs(d.leaked_pairs(docs, bench)) == want
    monkeypatch.setattr(d, "BLOCK_BYTES", 100)
    blocks = d._blocks(bench, "item_id", "text")
    assert len(blocks) >= 10 and reduce(lambda a, b: a.union(b), blocks).count() == 6
    found = d.with_leaks(docs, bench)
    plan = found._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and found.columns == ["doc_id", "text", "leaks"]
    assert pairs(d.leaked_pairs(docs, bench)) == want
    assert sorted(r["doc_id"] for r in d.keep_clean(docs, bench).collect()) == sorted([3, *(i for i in range(40) if i % 8), 90, 91])


def test_partly_and_scattered(spark):
    words = [f"w{i}" for i in range(44)]  # 40 shingles
    item = " ".join(words)
    filler = " ".join(f"f{i}" for i in range(30000))
    rows = [
        (1, f"{filler} {item.upper()} {filler}"), (2, " ".join(words[:36])), (3, " ".join(words[:35])),
        (4, f"{' '.join(words[:20])} x {' '.join(words[20:])}"), (5, " ".join(words[:24] + ["y"] + words[20:])),
        (6, None), (7, ""), (8, item), (8, item), (None, "Short  ITEM!"), (9, "short, other item"),
    ]
    items = [(1, item), (1, item), (2, "short item"), (3, ""), (4, None), (None, "w1 w2 w3 w4 w5")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as item_id", "'mine' as leaks", "2 as n_shared")
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "0 as leaks")
    want = brute(rows, items)
    assert pairs(d.leaked_pairs(docs, bench)) == want
    assert (2, 1, 40, 32) in want and not any(p[:2] == (3, 1) for p in want)
    kept = d.keep_clean(docs, bench)
    assert kept.columns == docs.columns and {r["leaks"] for r in kept.collect()} == {"mine"}
    assert d.leaked_pairs(docs.where("false"), bench).count() == 0
    assert d.leaked_pairs(docs, bench.where("false")).count() == 0
    assert d.keep_clean(docs, bench.where("false")).count() == len(rows)


def test_signature_length_is_the_least_that_finds_all():
    for n in range(1, 60):
        assert d.needed(n) >= 0.8 * n - 1e-9 and d.needed(n) - 1 < 0.8 * n
