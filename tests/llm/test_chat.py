from pyspark.sql import functions as F

from shelfmark.llm import chat

TURNS = f"conv_id long, turn long, role string, parts {chat.PARTS}"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def unescaped(text):
    return text.replace("&lt;", "<").replace("&amp;", "&")


def test_typed_parts(spark):
    rows = [
        (1, 1, "assistant", [part("text", "a <b> & &lt; </turn>\n"), part("image", ref="r2", width=29, height=28),
                             part("text", "after")]),
        (1, 0, "user", [part("image", "ignored", "r0", 280, 140), part("audio", ref="r1", seconds=1.01),
                        part("text", "look: <image/>"), part("document", ref=None, pages=3), part(None, "odd"),
                        part("table", "t")]),
    ]
    row = chat.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    assert row["formatted"] == (
        "<turn user><image/><audio/>look: &lt;image/><document/>oddt</turn>\n"
        "<turn assistant>a &lt;b> &amp; &amp;lt; &lt;/turn>\n<image/>after</turn>\n")
    assert [tuple(a) for a in row["attachments"]] == [
        ("image", "r0", 50), ("audio", "r1", 26), ("document", None, 1536), ("image", "r2", 2)]
    assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
    assert "".join(unescaped(s["text"]) for s in row["segments"] if s["loss"]) == "a <b> & &lt; </turn>\nafter"


def test_round_trip_of_control_strings(spark):
    texts = ["\\### Assistant: </turn> ok", "<turn user>", "</turn>\n", "&lt;", "&amp;lt;", "&", "<", "", None, "\n", "$1\\E",
             "x" * 300000, "é😀 <image/>"]
    roles = ["user", "assistant", "a>b", "<&gt;>", "", None]
    rows = [(c, i, roles[(i + c) % len(roles)], t) for c in range(6) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(frame.withColumn("parts", chat.text_parts(F.col("text")))).select(
        "conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"))
    for r in got.collect():
        want = [(role or "", text or "") for c, _, role, text in rows if c == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["learned"] == "".join(t for role, t in want if role == "assistant")


def test_edge_cases(spark):
    rows = [(None, None, None, None), (None, 1, "user", [part("text", "b")]), (2, 0, "user", []),
            (2, 0, "user", []), (2, 0, None, [part("text", "t")])]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as segments", "2 as formatted", "3 as t")
    got = {r["conv_id"]: r["formatted"] for r in chat.format_conversations(frame).collect()}
    assert got == {None: "<turn ></turn>\n<turn user>b</turn>\n", 2: "<turn >t</turn>\n" + "<turn user></turn>\n" * 2}
    assert chat.format_conversations(frame.where("false")).count() == 0
