import itertools
import random
import re

import numpy as np

from shelfmark.llm import personal as p
from shelfmark.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The patterns as they are stated."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and sum(
                    int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])
                ) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def field():
    rng = np.random.default_rng(1)
    table = rng.normal(size=(5, 5)) + 2 * np.eye(5)
    shapes = {(i, v): rng.normal(size=5) for i in range(7) for v in range(9)}
    return p.Field(shapes, rng.normal(size=5), table, (table + table.T) / 2)


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(0)
    alphabet = "ab9 @.+-1204(5)\n_é%"
    for _ in range(6000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert p.base_spans(text) == plain(text), text
    for text in ("a@b.c@d.e", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "+1 (017) 555-7713", "256.1.1.1",
                 "+4111111111111111", "4" * 40, "01.002.0003.4", "x@y", "@a.b"):
        assert p.base_spans(text) == plain(text)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    assert all(p.base_spans(r[0]) == plain(r[0]) for r in docs)


def test_messages_are_exact_on_trees():
    model = field()
    rng = random.Random(3)
    for _ in range(20):
        n = rng.randrange(2, 6)
        edges = [(rng.randrange(i), i) for i in range(1, n)]
        cut = rng.randrange(n)
        graph = p.Graph(
            list(range(n)), list(range(1, n + 1)), [tuple(rng.randrange(5) for _ in range(7)) for _ in range(n)],
            np.array([rng.choice((-1, -1, 2)) for _ in range(n)]), edges[:cut], edges[cut:])
        scores = model.evidence(graph.shapes)
        want = np.zeros((n, 5))
        for labels in itertools.product(range(5), repeat=n):
            if any(k >= 0 and k != a for k, a in zip(graph.known, labels)):
                continue
            w = sum(scores[i, a] for i, a in enumerate(labels) if graph.known[i] < 0)
            w += sum(model.chain[labels[a], labels[b]] for a, b in graph.chain)
            w += sum(model.skip[labels[a], labels[b]] for a, b in graph.skip)
            want[range(n), labels] += np.exp(w)
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(model.beliefs(graph), want, atol=1e-2)


def test_repetitions_take_the_label_of_a_match(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    learned = p.train(docs)
    text = "call +1 (017) 555-7713 now\n" + "then and so on " * 50 + "or 555-7713 again, version 4.0, room 12"
    spans = p.spans_of(text, learned)
    assert spans[0] == ("phone", 5, 22, True)
    assert ("phone", text.index("555-7713 again"), text.index(" again"), False) in spans and len(spans) == 2
    assert p.masked(text, learned).count("[PHONE]") == 2
    for clean in ("Licensed under CC BY-NC 4.0.", "In 2019, 3 of 12 rooms", "version 3.", None, ""):
        assert p.spans_of(clean, learned) == []


def test_query_and_mask_over_whole_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op6_pii"](spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        want = plain(text)
        assert [rows[i][f"n_{k}"] for k in p.KINDS] == [sum(s[0] == k for s in want) for k in p.KINDS]
        assert set(f"{k}:{s}:{e}" for k, s, e in want) <= set(rows[i]["spans"].split(",")) | {""}
    masked = p.mask(docs)
    assert masked.columns == docs.columns
    for r in masked.collect():
        assert plain(r["text"]) == [] and r["n_chars"] == len(r["text"])
        if not re.search("[0-9@]", texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]


def test_edge_cases(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a@b.org", None, "s", 7), (3, "a@b.org", None, "s", 7),
            (None, "1.2.3.4 " * 3, None, None, None), (4, "9" * 300000 + "@" * 300000, None, None, 5)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'mine' as pii", "1 as h", "2 as seen", "3 as before")
    got = p.mask(docs)
    assert got.columns == docs.columns
    out = got.collect()
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in out[:5]] == [
        (1, None, None), (2, "", 0), (3, "[EMAIL]", 7), (3, "[EMAIL]", 7), (None, "[IP] [IP] [IP] ", 15)]
    assert p.mask(docs.where("false")).count() == 0
    assert p.with_spans(docs, p.train(docs)).where("size(pii) > 0").count() == 3


def test_parts_of_very_many_zeros():
    assert p.base_spans("0" * 4301 + ".1.2.3") == [("ip", 0, 4307)]
    assert p.base_spans("1." + "0" * 5000 + ".2.0256 0.0.0.0") == [("ip", 5010, 5017)]
