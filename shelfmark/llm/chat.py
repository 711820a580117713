"""Chat formatting: typed content parts flattened to one reversible text for each conversation.

``<turn ROLE>`` and ``</turn>`` mark turns, ``<image/>``, ``<audio/>`` and
``<document/>`` stand for attachments. Every mark starts with ``<``, which texts
can't contain after escaping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PARTS = ("array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>")
END = "</turn>\n"
#: Tokens that an attachment expands to: image patches of 28 x 28 points, audio frames, tokens of a page.
PATCH, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 512


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def text_parts(text: Column) -> Column:
    """One text part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )).cast(PARTS)


def _visit(part: Column) -> Column:
    """What a part leaves in the text; a part of unknown kind is one of text."""
    return F.when(part["kind"].isin("image", "audio", "document"), F.concat(F.lit("<"), part["kind"], F.lit("/>"))) \
        .otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def _tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; a missing measure counts as zero."""
    def number(name):
        return F.coalesce(part[name], F.lit(0))

    return (
        F.when(part["kind"] == "image", F.ceil(number("width") / PATCH) * F.ceil(number("height") / PATCH))
        .when(part["kind"] == "audio", F.ceil(number("seconds") * FRAMES_PER_SECOND))
        .otherwise(number("pages") * TOKENS_PER_PAGE).cast("long")
    )


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", learned: str = "assistant") -> DataFrame:
    """One row for each conversation of ``turns (conv_id, turn, role, parts)``.

    ``segments`` is the formatted text in order, each piece with its ``loss`` flag
    (the texts of role ``learned``); ``formatted`` is their concatenation.
    ``attachments`` lists the non-text parts in the order of their placeholders,
    with reference and expanded tokens. Turns are ordered by number, equal ones by
    role and content, nulls first; repeated rows stay. A null role is empty, null
    parts are no parts. A null ``conv_id`` is a conversation like another. The
    text of one conversation is one row, so the longest one bounds a task.
    """
    role = F.coalesce("role", F.lit(""))
    marked = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), role.alias("role"), F.coalesce("parts", F.array().cast(PARTS)).alias("parts"))
        .alias("t"),
    )
    gathered = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def segments(t):
        opening = F.concat(F.lit("<turn "), F.replace(escape(t["role"]), F.lit(">"), F.lit("&gt;")), F.lit(">"))
        body = F.transform(t["parts"], lambda p: F.struct(
            _visit(p).alias("text"),
            ((t["role"] == learned) & ~F.coalesce(p["kind"].isin("image", "audio", "document"), F.lit(False))).alias("loss"),
        ))
        mark = [F.array(F.struct(x.alias("text"), F.lit(False).alias("loss"))) for x in (opening, F.lit(END))]
        return F.concat(mark[0], body, mark[1])

    def attachments(t):
        return F.transform(
            F.filter(t["parts"], lambda p: p["kind"].isin("image", "audio", "document")),
            lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
        )

    return gathered.select(
        F.col("conv_id").alias(conv_id),
        F.flatten(F.transform("turns", segments)).alias("segments"),
        F.flatten(F.transform("turns", attachments)).alias("attachments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of the turns of a formatted text."""
    turns = F.filter(F.split(formatted, END, -1), lambda t: t != "")

    def turn(t):
        role = F.regexp_extract(t, r"^<turn ([^>]*)>", 1)
        return F.struct(
            unescape(F.replace(role, F.lit("&gt;"), F.lit(">"))).alias("role"),
            unescape(F.substring(t, F.length(role) + 8, F.length(t))).alias("text"),
        )

    return F.transform(turns, turn)


def learned_text(segments: Column) -> Column:
    """The text under the loss mask, unescaped."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")
