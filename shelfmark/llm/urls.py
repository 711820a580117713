"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of a digest that the join compares; the full digest is confirmed after it.
PREFIX_DIGITS = 8
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    found = F.instr(url, "://")
    return F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise("")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX_DIGITS)


def _hashed_rules(rules: DataFrame) -> DataFrame:
    """Rules by digest; of equal host and path, a block wins."""
    known = rules.where("host is not null and path is not null and action in ('allow', 'block')").select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "action"
    )
    return known.groupBy("host", "path").agg(F.max("action").alias("action")).select(
        F.concat("host", "path").alias("rule"), "action",
        F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.", -1))).alias("labels"),
        F.length("path").alias("path_chars"),
    ).withColumn("digest", _digest(F.col("rule")))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` of each ``url``.

    ``rules`` has ``host, path, action`` (allow or block). A rule fits its host and
    all subdomains if the URL's path starts with the rule's; the longest fitting
    rule wins, of equally long ones a block. ``rule`` is null where none fits and
    the verdict is ``default``. A null URL or one without ``://`` has empty host
    and path. Rules with a null are left out. Columns that bear the four names are
    replaced. Each distinct host and path is expanded once, by the label counts
    and path lengths that rules have, so work doesn't grow with repeated URLs.
    """
    hashed = _hashed_rules(rules)
    kept = pages.drop("host", "path", "rule", "verdict")
    split = kept.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    distinct = split.select("host", "path").distinct()
    # Shapes of rules: as many as they differ in labels and path lengths, not as there are rules.
    # A host has at most 127 labels and a path a few thousand characters.
    found = hashed.select("labels", "path_chars").distinct().collect()
    shapes = F.array(*[
        F.struct(F.lit(r["labels"]).alias("labels"), F.lit(r["path_chars"]).alias("path_chars")) for r in found
    ]).cast("array<struct<labels:int,path_chars:int>>")
    labels = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.", -1)))
    expanded = distinct.select(
        "host", "path", labels.alias("n"), F.length("path").alias("chars"), F.explode(shapes).alias("shape")
    ).where("shape.labels <= n and shape.path_chars <= chars").select(
        "host", "path",
        F.expr("sha2(concat(substring_index(host, '.', -shape.labels), left(path, shape.path_chars)), 256)")
        .alias("digest"),
    )
    hits = expanded.withColumn("prefix", _prefix(F.col("digest"))).join(
        hashed.select(F.col("digest").alias("full"), _prefix(F.col("digest")).alias("prefix"), "rule", "action"),
        "prefix",
    ).where(F.col("digest") == F.col("full"))
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("length"), "action", "rule")).alias("best")
    ).select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict"))
    judged = split.join(best, ["host", "path"], "left")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default))).select(
        *kept.columns, "host", "path", "rule", "verdict"
    )
