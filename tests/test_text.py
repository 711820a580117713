import random

import duckdb
from pyspark.sql import functions as F

from shelfmark.functions.stemming import stems_sql
from shelfmark.functions.text import ENGLISH, MARKUP, PLAIN, Analyzer, lexemes_sql
from shelfmark.operators.fulltext import (
    analyze,
    keyword_scores,
    keyword_scores_from_postings,
    keyword_scores_of_top,
    postings,
    score_bounds,
    web_query,
)
from shelfmark.operators.ranking import keyword_topk
from shelfmark.sources.tables import spread
from workload import english

# Every word counts, so that letters can stand for words.
LETTERS = Analyzer(stemmer="none", path_mode="split", stop_words=())

# Published sample pairs of the English Snowball algorithm, and a few more.
STEMS = {
    "consign": "consign", "consigned": "consign", "consigning": "consign", "consistency": "consist",
    "consistently": "consist", "consolation": "consol", "consolatory": "consolatori",
    "consolingly": "consol", "conspicuous": "conspicu", "conspiracy": "conspiraci",
    "conspirator": "conspir", "constables": "constabl", "constancy": "constanc",
    "knackeries": "knackeri", "knaves": "knave", "knavish": "knavish", "kneaded": "knead",
    "kneeled": "kneel", "knell": "knell", "knightly": "knight", "knitted": "knit", "knives": "knive",
    "knocker": "knocker", "knopp": "knopp", "running": "run", "hopping": "hop", "hoping": "hope",
    "happy": "happi", "generously": "generous", "generalization": "general", "communism": "communism",
    "yes": "yes", "say": "say", "flying": "fli", "skies": "sky", "relational": "relat",
    "conditional": "condit", "retrieval": "retriev", "indexing": "index", "cries": "cri",
    "ties": "tie", "gas": "gas", "this": "this", "kiwis": "kiwi", "gaps": "gap", "agreed": "agre",
    "feed": "feed", "luxuriated": "luxuri", "by": "by", "cry": "cri", "enjoy": "enjoy",
    "succeeding": "succeed", "news": "news", "abc1s": "abc1s",
}


def test_stemming(spark):
    words = list(STEMS)
    row = spark.createDataFrame([(words,)], "w array<string>").select(F.expr(stems_sql("w"))).first()
    assert dict(zip(words, row[0])) == STEMS


def lexemes(spark, text, analyzer):
    row = spark.createDataFrame([(text,)], "t string")
    return row.select(F.expr(lexemes_sql("t", analyzer))).first()[0]


def test_analysis_keeps_positions_of_stop_words(spark):
    assert lexemes(spark, "The fat Cats of Rome", ENGLISH) == ["", "fat", "cat", "", "rome"]


def test_token_classes(spark):
    assert lexemes(spark, "src/files/indexer.py get_names", ENGLISH) == ["src/files/indexer.py", "get", "name"]
    assert lexemes(spark, "src/a.py camelCase", PLAIN) == ["src", "", "py", "camelcase"]
    assert lexemes(spark, "a well-known main.py 3.14", ENGLISH) == [
        "", "well-known", "well", "known", "main.py", "3.14",
    ]
    assert lexemes(spark, None, ENGLISH) is None


def test_markup_classes(spark):
    def found(text):
        return lexemes(spark, text, MARKUP)

    assert found('<!DOCTYPE html><p class="x">Cats&amp;dogs&#39;s &#x41;<br/>A<!-- no > word --></p>') == [
        "cat", "dog", "", ""]  # "s" and "a" are stop words
    assert found("<style>p{margin:0}</style>one<SCRIPT src='x'>var two='</p>';</SCRIPT> three") == ["one", "three"]
    assert found("<script>never closed") == [] and found("a < b > c") == ["", "b", "c"]
    assert found("http://example.com/stuff/index.html?q=1 https://example.com ftp://x") == [
        "example.com/stuff/index.html?q=1", "example.com", "/stuff/index.html?q=1", "example.com", "x"]
    assert found("example.com:80/ src/files/indexer.py /usr/local/foo.txt me@example.com") == [
        "example.com:80/", "example.com:80", "/", "src/files/indexer.py", "/usr/local/foo.txt", "me@example.com"]
    assert found("-12 +3.5 x=-1.234e56 1e-5 8.3.0 3.14 2024-01-02 foo-1 foo-1a a-1.txt 5-3.14") == [
        "-12", "+3.5", "x", "-1.234e56", "1e-5", "8.3.0", "3.14", "2024", "-01", "-02", "foo", "-1",
        "foo-1a", "foo", "1a", "a-1.txt", "5", "-3.14"]
    assert found("get_user_name well-known logs/2024-01-02/x") == [
        "get", "user", "name", "well-known", "well", "known", "logs/2024-01-02/x"]
    assert found("a" * 2047 + " " + "b" * 2048 + " c") == ["a" * 2047, "c"]
    assert found("") == [] and found(None) is None
    for hostile in ("<a " * 200000, "<!--" * 200000, "a." * 200000, "a-" * 200000, "1-" * 200000, "<script>" * 200000):
        found(hostile)


def clauses(spark, text, analyzer=LETTERS):
    return [
        (c["alt"], c["negated"], c["phrase"], c["terms"], c["offsets"])
        for c in web_query(spark, text, analyzer).clauses
    ]


def test_web_query(spark):
    word = lambda alt, t, negated=False: (alt, negated, False, [t], [0])
    assert clauses(spark, "a b") == [word(0, "a"), word(0, "b")]
    assert clauses(spark, "a OR b") == [word(0, "a"), word(1, "b")]
    assert clauses(spark, "a -b") == [word(0, "a"), word(0, "b", True)]
    assert clauses(spark, '"a b"') == [(0, False, True, ["a", "b"], [0, 1])]
    assert clauses(spark, 'a -"b c" or d') == [word(0, "a"), (0, True, True, ["b", "c"], [0, 1]), word(1, "d")]
    assert clauses(spark, '"fat the cat"', ENGLISH) == [(0, False, True, ["fat", "cat"], [0, 2])]
    pair = lambda a, b, negated=False: (0, negated, True, [a, b], [0, 1])
    assert clauses(spark, "a_b - c") == [pair("a", "b"), word(0, "c")]
    assert clauses(spark, "a -pg_class") == [word(0, "a"), pair("pg", "class", True)]
    assert clauses(spark, "wi-fi", ENGLISH) == [(0, False, True, ["wi-fi", "wi", "fi"], [0, 1, 2])]
    for nothing in ("the", "", '""', "-", "or", '"'):
        assert clauses(spark, nothing, ENGLISH) == []


def scores(spark, docs, query, analyzer=LETTERS):
    table = spark.createDataFrame(list(enumerate(docs)), "id long, body string")
    table = analyze(table, "body", analyzer).withColumn("project_id", F.lit(1).cast("long"))
    parsed = web_query(spark, query, analyzer)
    by_row = {r["id"]: round(r["score"], 9) for r in keyword_scores(table, parsed).collect()}
    if not parsed.needs_all_rows:
        index = keyword_scores_from_postings(postings(table), parsed).collect()
        assert {r["id"]: round(r["score"], 9) for r in index} == by_row
    return by_row


def test_matching(spark):
    docs = ["a b", "b a", "a x b", "a", "c"]
    assert set(scores(spark, docs, "a b")) == {0, 1, 2}
    assert set(scores(spark, docs, "a or c")) == {0, 1, 2, 3, 4}
    assert set(scores(spark, docs, "a -b")) == {3}
    assert set(scores(spark, docs, '"a b"')) == {0}
    assert set(scores(spark, docs, "-a")) == {4}
    assert set(scores(spark, docs, 'a -"a b"')) == {1, 2, 3}
    assert scores(spark, docs, "") == {}


def test_cover_density_examples(spark):
    assert scores(spark, ["a b x x b a", "a x b", "a"], "a b") == {0: 0.2, 1: 0.05}
    assert scores(spark, ["a a x a"], "a") == {0: 0.3}
    assert scores(spark, ["a b", "a x b"], '"a b" or x') == {0: 0.1, 1: 0.1}
    assert scores(spark, ["The cats sat. A cat!"], "cats", ENGLISH) == {0: 0.2}


def covers_by_scanning(words, wanted):
    """Minimal covers by trying every window; ``wanted`` is a list of and-lists."""
    known = {w for group in wanted for w in group}
    hits = [(i + 1, w) for i, w in enumerate(words) if w in known]
    satisfied = [
        (a, b)
        for a in range(len(hits))
        for b in range(a, len(hits))
        if any(all(w in {h[1] for h in hits[a : b + 1]} for w in group) for group in wanted)
    ]
    minimal = [
        (a, b) for a, b in satisfied
        if not any((c, d) != (a, b) and a <= c and d <= b for c, d in satisfied)
    ]
    return sum(0.1 / (1 + (hits[b][0] - hits[a][0]) - (b - a)) for a, b in minimal)


def test_cover_density_equals_scanning(spark):
    random.seed(7)
    docs = [" ".join(random.choices("abcdxyz", k=random.randint(1, 25))) for _ in range(150)]
    for query, wanted in (
        ("a b", [["a", "b"]]), ("a b c", [["a", "b", "c"]]), ("a or b", [["a"], ["b"]]),
        ("a b or c d", [["a", "b"], ["c", "d"]]), ("a a b", [["a", "b"]]),
    ):
        got = scores(spark, docs, query)
        expected = {i: covers_by_scanning(d.split(), wanted) for i, d in enumerate(docs)}
        assert got == {i: round(s, 9) for i, s in expected.items() if s > 0}


def covers_one_by_one(words, alternatives):
    """Matches and scores by trying windows; ``alternatives`` are lists of (wanted, phrase)."""
    known = {w for group in alternatives for _, phrase in group for w in phrase}
    hits = [(i, w) for i, w in enumerate(words) if w in known]

    def holds(window):
        at = set(window)
        there = lambda phrase: any(all((i + j, w) in at for j, w in enumerate(phrase)) for i, _ in window)
        return any(all(there(phrase) == wanted for wanted, phrase in group) for group in alternatives)

    if not holds(hits):
        return None
    score, start = 0.0, 0
    while True:
        end = next((r for r in range(start, len(hits)) if holds(hits[start : r + 1])), None)
        if end is None:
            return score
        begin = next(b for b in range(end, start - 1, -1) if holds(hits[b : end + 1]))
        score += 0.1 / (1 + hits[end][0] - hits[begin][0] - (end - begin))
        start = begin + 1


def test_exclusions_beside_other_alternatives(spark):
    random.seed(11)
    docs = [" ".join(random.choices("abcdxyz", k=random.randint(1, 25))) for _ in range(200)]
    docs += ["x a b c", "b x a", "x p a x q", "c x a b", " ".join(random.choices("abcx", k=700))]
    for query, alternatives in (
        ("a b -x or c", [[(True, "a"), (True, "b"), (False, "x")], [(True, "c")]]),
        ("a -x or b", [[(True, "a"), (False, "x")], [(True, "b")]]),
        ("p q or a -x", [[(True, "p"), (True, "q")], [(True, "a"), (False, "x")]]),
        ('a -"x y" or "c d" -b', [[(True, "a"), (False, "xy")], [(True, "cd"), (False, "b")]]),
        ('"a b" -x or c d -y or z', [
            [(True, "ab"), (False, "x")], [(True, "c"), (True, "d"), (False, "y")], [(True, "z")]]),
    ):
        expected = {i: covers_one_by_one(d.split(), alternatives) for i, d in enumerate(docs)}
        assert scores(spark, docs, query) == {i: round(s, 9) for i, s in expected.items() if s is not None}
    assert scores(spark, ["x a b c"], "a b -x or c") == {0: 0.1}
    assert scores(spark, ["a", "x", "b", "x a"], "-x or a") == {0: 0.1, 2: 0.0, 3: 0.1}


def test_keyword_topk_breaks_ties_by_id(spark):
    rows = spark.createDataFrame([(3, 0.1), (1, 0.1), (2, 0.2)], "id long, score double")
    assert [(r["id"], r["rank"]) for r in keyword_topk(rows, 2).collect()] == [(2, 1), (1, 2)]
    assert keyword_topk(rows, 0).collect() == []


def test_top_rows_by_bounds(spark):
    random.seed(5)
    docs = [" ".join(random.choices("abcdxyz", k=random.randint(1, 60))) for _ in range(300)]
    docs += ["a b " * 40, "a b a b a b", "a b a b a b", "b" + " a" * 90]
    table = spark.createDataFrame(list(enumerate(docs)), "id long, body string")
    table = analyze(table, "body", LETTERS).withColumn("project_id", F.lit(1).cast("long"))
    index = postings(table).cache()
    for text in ("a b", "a b c", "a", "a or b", 'a "b c"', "a b -x", "a b -x or c", "a nowhere", ""):
        query = web_query(spark, text, LETTERS)
        every = keyword_scores_from_postings(index, query)
        bounds = {r["id"]: r["bound"] for r in score_bounds(index, query).collect()}
        assert all(r["score"] <= bounds[r["id"]] + 1e-9 for r in every.collect())
        for limit in (1, 7, 400):
            want = [tuple(r) for r in keyword_topk(every, limit).collect()]
            assert [tuple(r) for r in keyword_topk(keyword_scores_of_top(index, query, limit), limit).collect()] == want
    # One row stands out, and its 79 covers are more than the bounds of all others.
    assert [r["id"] for r in keyword_scores_of_top(index, web_query(spark, "a b", LETTERS), 1).collect()] == [300]
    assert keyword_scores_of_top(index, web_query(spark, "a", LETTERS), 0).count() == 0
    index.unpersist()


def test_postings_are_gathered_in_their_row(spark):
    random.seed(11)
    fts = [random.choices(["a", "b", "ab", "é", "", "zz"], k=random.randint(0, 40)) for _ in range(200)]
    rows = [(i, i % 3, words) for i, words in enumerate(fts)] + [(900, 1, None), (901, 1, [""]), (902, None, ["x", "x"])]
    index = postings(spark.createDataFrame(rows, "id long, project_id long, fts array<string>"))
    expected = {(t, i, p, tuple(k + 1 for k, w in enumerate(words or []) if w == t))
                for i, p, words in rows for t in set(words or []) - {""}}
    found = index.select("term", "id", "project_id", "positions").collect()
    assert len(found) == len(expected)
    assert {(r["term"], r["id"], r["project_id"], tuple(r["positions"])) for r in found} == expected
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Aggregate" not in plan


def test_spread_tasks_stay_bounded(spark):
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        rows = spark.range(0, 20000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
        sizes = spread(rows).groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("text").alias("count")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert sum(r["count"] for r in sizes) == 20000
    assert len(sizes) > 2 * spark.sparkContext.defaultParallelism


def test_long_words_are_stemmed(spark):
    words = ["ab" * 150 + "running", "ba" * 60 + "ness", "bcd" * 100 + "ed", "a" * 100000 + "bing", "b" * 100000 + "s", "y" * 5000]
    row = spark.createDataFrame([(words,)], "w array<string>").select(F.expr(stems_sql("w"))).first()
    assert row[0][:3] == ["ab" * 150 + "run", "ba" * 60, "bcd" * 100 + "ed"]
    assert row[0][3] == "a" * 100000 + "b" and row[0][4] == "b" * 100000 + "s"


def test_the_oracle_stems_alike():
    values = ", ".join(f"('{w}')" for w in STEMS)
    found = duckdb.sql(f"WITH words(t) AS (VALUES {values}), {english.stems('words')} SELECT t, stem FROM stems").fetchall()
    assert dict(found) == STEMS
