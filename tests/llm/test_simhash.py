import random
from itertools import combinations

import pytest
import xxhash

from shelfmark.llm import simhash
from shelfmark.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """``{id: component}`` of ``[(id, unsigned fingerprint)]`` by comparing every pair."""
    parent = {i: i for i, _ in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            r, s = sorted((find(i), find(j)))
            parent[s] = r
    return {i: find(i) for i, _ in prints}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_equals_brute_force(spark):
    texts = [None, "", " \n", "One", "one TWO", "a b c", "a b c a b c a b c", "é É " * 50, "x " * 70000]
    for t in texts:
        assert simhash.fingerprint_of(t) == signed(brute_fingerprint(t))


@pytest.mark.parametrize("limit", [2000, 40, 5])
def test_components_equal_brute_force(spark, limit):
    rng = random.Random(limit)
    prints = [0, (1 << 64) - 1]
    for _ in range(12):  # chains and stars of close fingerprints, some of them dense
        at = rng.getrandbits(64)
        for _ in range(25):
            prints.append(at)
            for _ in range(rng.choice((1, 2, 3, 4))):
                at ^= 1 << rng.randrange(64 if rng.random() < 0.5 else 12)
    prints += [rng.getrandbits(64) for _ in range(200)]
    prints = list(dict.fromkeys(prints))
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = simhash.link_fingerprints(frame, limit=limit)
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = brute_components([(p, p) for p in prints])
    classes = {}
    for p in prints:
        classes.setdefault(got.get(signed(p), signed(p)), set()).add(p)
    expected = {}
    for p in prints:
        expected.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_whole_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    want = brute_components(rows)
    got = simhash.simhash_components(docs).collect()
    assert {(r[0], r[1], r[2]) for r in got} == {(i, signed(p), want[i]) for i, p in rows}
    assert len(got) == len(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(set(want.values()))


def test_edge_cases(spark):
    rows = [(3, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c d", None, "s", 7),
            (2, "a b c d", None, "s", 7), (None, "A B C D", None, None, None), (None, "other words here", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as fp", "2 as component_id", "3 as node", "4 as rank")
    got = sorted(simhash.simhash_components(docs).select("doc_id", "component_id").collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted(
        [(3, 1), (1, 1), (2, 2), (2, 2), (None, 2), (None, None)], key=str)
    kept = simhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    empty = docs.where("false")
    assert simhash.simhash_components(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_different_texts_under_one_id(spark):
    """Each group keeps its own row, whatever other texts its id has."""
    near, far, third = "a b c d e", "z y x w v", "other words altogether here"
    rows = [(2, near), (5, near.upper()), (5, far), (7, third), (7, "q r s t"), (7, third), (8, "q r s t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as digest", "2 as component")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [
        (2, near), (5, far), (7, third), (7, "q r s t")]
