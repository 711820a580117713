import random
import re
from collections import Counter

from shelfmark.llm import quality as q

DOCS = "doc_id long, text string"
WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def counts(text):
    f = q.Features(text)
    return f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed


def test_counts_equal_brute_force(spark):
    rng = random.Random(0)
    parts = ["a", "b", "é", "\x1c", "\x85", " ", " ", " ", "\n", "\t", "\x0b", "#", "<", " ", "日"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(80)))
        assert counts(text) == brute(text), repr(text)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert counts(r[0]) == brute(r[0])


def test_order_by_rejection_per_cost():
    # 0 rejects as much as 1 but costs more; 2 rejects only what 1 does; 3 nothing; 4 a little, cheaply
    outcomes = [
        ((5, True), (1, True), (1, True), (9, False), (1, False)),
        ((5, True), (1, True), (1, True), (9, False), (1, False)),
        ((5, False), (1, True), (1, False), (9, False), (1, False)),
        ((5, False), (1, False), (1, False), (9, False), (1, True)),
        ((5, False), (1, False), (1, False), (9, False), (1, False)),
    ]
    assert q.cascade_order(outcomes) == [1, 4, 2, 0, 3]
    assert q.cascade_order([]) == []


def test_shared_features_are_paid_once():
    # 2 asks for the feature that 0 has made, and then costs less than 1
    outcomes = [((2, True), (3, True), (9, False))] * 2 + [((2, True), (3, False), (9, False))] + [
        ((2, False), (3, True), (9, True))]
    assert q.cascade_order(outcomes) == [0, 1, 2]
    assert q.cascade_order(outcomes, [{"a": 1.5}, {}, {"a": 7.5, "b": 1.0}]) == [0, 2, 1]


def test_base_counts_cost_nothing_and_base_failures_do_not_count(spark):
    """A rule on base counts comes first although it rejects no more than a costly one does."""
    def slow(f):
        return sum(map(len, f.text.split("w"))) < 0 or f.n_words > 30

    rules = (q.Rule("slow", slow), q.Rule("counted", lambda f: f.n_words > 30), q.Rule("failures", lambda f: f.n_words < 10))
    texts = [" ".join(f"w{i}x{j}" for j in range(20 + 20 * (i % 2))) for i in range(60)] + ["short"] * 500
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    assert q.measure(docs, rules)[0] == 1 and q.measure(docs, rules)[1:] in ([0, 2], [2, 0])
    assert q.measure(docs.where("text = 'short'"), rules) == [0, 1, 2]


def test_verdict_is_the_same_in_any_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    order = q.measure(docs)
    assert sorted(order) == list(range(len(q.RULES)))
    want = {}
    for r in docs.collect():
        f = q.Features(r["text"])
        want[r["doc_id"]] = not f.base_failed and not any(rule.rejects(f) for rule in q.RULES)
    for chosen in (order, order[::-1]):
        rows = q.judge(docs, chosen).collect()
        assert {r["doc_id"]: r["kept"] for r in rows} == want
        assert all((r["rejected_by"] is None) == r["kept"] for r in rows)
    assert 0.6 < sum(want.values()) / len(want) < 0.95
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    f = {r["doc_id"]: q.Features(r["text"]).base_failed for r in docs.collect()}
    good = [want[d] for d, v in labels.items() if v == 1 and not f[d]]
    assert sum(good) / len(good) > 0.98


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "w " * 200000), (4, "w " * 200000), (None, "x" * 500000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'mine' as Kept", "1 as h", "2 as outcome", "3 as other")
    out = q.judge(docs, q.measure(docs)).collect()
    assert [(r["n_words"], r["kept"], r["rejected_by"]) for r in out[:4]] == [
        (0, False, "base"), (0, False, "base"), (0, False, "base"), (200000, False, "base")]
    assert len(out) == 6 and out[0]["other"] == 3
    empty = docs.where("false")
    assert q.judge(empty, q.measure(empty)).count() == 0
