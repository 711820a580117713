import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import spelling
from shelfmark.llm.queries import QUERIES

WORDS = "word string, n long"


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    by_size = defaultdict(list)
    for w in counts:
        by_size[len(w)].append(w)
    forms, out = {}, {}
    for w, n in counts.items():
        close = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size[size] if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * n:
            forms[w] = best
        out[w] = len(close)
    rows = set()
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        rows.add((w, n, out[w], form, counts.get(form), root))
    return rows


def got(frame):
    rows = [tuple(r) for r in frame.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_words(rng, size):
    """Words over few letters, so that many are near, with repeated letters and shared ends."""
    counts = {}
    while len(counts) < size:
        if counts and rng.random() < 0.7:
            w = rng.choice(list(counts))
            i = rng.randrange(len(w) + 1)
            w = rng.choice((w[:i] + rng.choice("abé") + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice("abü") + w[i + 1:]))
        else:
            w = "".join(rng.choice("aab") for _ in range(rng.randrange(1, 14)))
        counts[w] = rng.choice((2, 3, 3, 20, 30, 300, 5000, 1 << 40))
    return {w: n for w, n in counts.items() if w}


@pytest.mark.parametrize("cells", [spelling.CELLS, 40])
def test_equals_brute_force(spark, cells):
    """Also with blocks that have to be cut down to one open letter."""
    counts = random_words(random.Random(cells), 600)
    frame = spark.createDataFrame(list(counts.items()), WORDS).repartition(5)
    assert got(spelling.variants(frame, cells=cells)) == brute(counts)


def test_blocks_are_bounded_and_hold_each_pair_once(spark):
    counts = random_words(random.Random(3), 400) | {"prefixes" + "".join(t): 2 for t in zip("abcdefgh" * 9, "abcdefghi" * 8)}
    frame = spark.createDataFrame(list(counts.items()), WORDS)
    blocks = defaultdict(list)
    for r in spelling.bounded_blocks(frame, 60).collect():
        w = r["word"]
        blocks[r["longest"], r["head"], r["tail"], w[:r["head"]], w[len(w) - r["tail"]:]].append((w, r["n"]))
    seen = Counter()
    for (longest, head, tail, _, _), block in blocks.items():
        wide = longest - head - tail
        assert len(block) == 1 or wide == 1 or len(block) * wide <= 60
        index = spelling.PositionIndex([w for w, _ in block], longest, head, tail)
        for w, _ in block:
            if len(w) == longest:
                replaced, missing = index.near(w)
                seen.update((w, block[i][0]) for i in spelling._members(replaced | missing))
    words = list(counts)
    assert seen == Counter((a, b) for a in words for b in words if near(a, b) and len(b) <= len(a))


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(brute_words(docs))
    assert len(expected) > 1000 and any(r[3] for r in expected)
    assert got(QUERIES["op11_spelling_variants"](spark, folder)) == expected


def test_edge_cases(spark):
    long = "ab" * 40_000
    rows = [(1, None), (2, ""), (None, "Letters LETTERS letter·letters"), (None, "Éclairs éclairs Éclairs"),
            (4, f"{long} {long}c x{long[1:]}"), (4, f"{long} {long}c x{long[1:]}"), (5, "seventh seventh " * 10 + "sevenths sevenths")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as word", "2 as n", "3 as root", "4 as key", "5 as id")
    result = {r[0]: r[1:] for r in got(spelling.group_spellings(docs))}
    assert result[long] == (2, 2, None, None, long)
    assert result["letters"] == (3, 0, None, None, "letters")
    assert result["Éclairs"] == (2, 0, None, None, "Éclairs") and "éclairs" not in result
    assert result["sevenths"] == (2, 1, "seventh", 20, "seventh")
    assert got(spelling.group_spellings(docs.where("false"))) == set()
    assert got(spelling.variants(spark.createDataFrame([(None, 3), ("a", 1), ("", 2)], WORDS))) == {
        ("a", 1, 1, None, None, "a"), ("", 2, 1, None, None, "")}
    one = spark.createDataFrame([(1, "notes noted")], "key long, body string")
    assert got(spelling.variants(spelling.vocabulary(one, "body", "key", least_letters=1, least_count=1))) == {
        ("notes", 1, 1, None, None, "notes"), ("noted", 1, 1, None, None, "noted")}


def test_chains_of_forms_are_followed(spark):
    chain = [("w" + "o" * i, 10 ** (18 - i)) for i in range(1, 18)]
    rows = got(spelling.variants(spark.createDataFrame(chain, WORDS)))
    assert {r[5] for r in rows} == {"wo"} and sum(r[3] is None for r in rows) == 1
