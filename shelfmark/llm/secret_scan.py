"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings.

Candidates are runs of characters that keys are written in, cut where a fixed
pattern has matched. A window slides over each one; the counts of its characters
are kept up by one step in and one step out, and with them the sum of
``c * log2(c)``, which is low where the Shannon entropy is high. Each window is
judged by its own character class and that class's threshold. Runs of letters and
digits within a candidate are judged first and reported by themselves, so that
what is glued to a key doesn't hide it; then what is left of the candidate. An
allow list suppresses findings that hold known harmless strings. Everything is a
Spark expression of one row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.frames import unused

WINDOW = 20
#: The base patterns.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW
_WORD = r"[A-Za-z0-9]{%d,}" % WINDOW
_SIGN = r"[+/_=-]"
#: Bits from which a window is random: of hexadecimal digits, of letters and digits, with signs too. A window
#: of letters and digits is also random without a digit from ``BARE_BITS``; others need a letter and a digit.
HEX_BITS, WORD_BITS, BARE_BITS, MIXED_BITS = 3.0, 3.7, 4.0, 3.8
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Findings that hold one of these are no secrets: samples from manuals, fillers, sequences, UUIDs.
ALLOWED = (
    r"(?i)example|sample|placeholder|changeme|dummy|x{6}|0{8}|123456789|abcdefgh",
    r"(?:^|[^0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?:$|[^0-9a-fA-F])",
)
#: Sums of ``c * log2(c)`` are whole millionths, so that no rounding depends on the order.
_UNIT = 1_000_000
_TERMS = [0 if c == 0 else round(c * math.log2(c) * _UNIT) for c in range(WINDOW + 2)]  # one more before the oldest leaves
#: Lengths are summed up in blocks, so that a text with very many matches takes linear time.
_BLOCK = 256


def entropy_limit(bits: float) -> int:
    """The largest sum of terms that a window of at least ``bits`` of entropy can have."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * _UNIT)


def _let(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), function), 1)


def _running_sums(values: Column) -> Column:
    """The sum of all values before each one; an array of longs, not empty."""
    nothing = F.array().cast("array<bigint>")

    def before(array: Column, first: Column) -> Column:
        return F.aggregate(
            array, F.struct(first.alias("sum"), nothing.alias("all")),
            lambda s, v: F.struct((s["sum"] + v).alias("sum"), F.array_append(s["all"], s["sum"]).alias("all")),
            lambda s: s["all"],
        )

    def part(b: Column) -> Column:
        return F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))

    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0).cast("long"), lambda s, v: s + v))
    return _let(before(totals, F.lit(0).cast("long")), lambda starts: F.flatten(
        F.transform(starts, lambda start, b: before(part(b), start))))


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<start, end, value>>`` of the matches; ``value`` is the group."""
    def lengths(pieces: Column) -> Column:
        return F.transform(pieces, lambda p: F.length(p).cast("long"))

    cut = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
        lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("long"),
        lengths(F.split(text, pattern, -1)).alias("gaps"),  # before each match, and after the last
    )

    def spans(c: Column) -> Column:
        steps = F.zip_with(c["gaps"], c["long"], lambda gap, long: gap + F.coalesce(long, F.lit(0)))
        starts = _let(steps, lambda s: F.zip_with(_running_sums(s), c["gaps"], lambda at, gap: at + gap))
        ends = F.zip_with(starts, c["long"], lambda start, long: F.struct(
            start.alias("start"), (start + long).alias("end")))
        return F.slice(F.zip_with(ends, c["values"], lambda e, v: F.struct(
            e["start"].alias("start"), e["end"].alias("end"), v.alias("value"))), F.lit(1), F.size(c["long"]))

    return _let(cut, spans)


NONE = "array<struct<start:bigint,end:bigint,value:string>>"


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches of ``pattern``; most texts have none, and are only looked through."""
    return F.when(text.rlike(pattern), _found(text, pattern, group).cast(NONE)).otherwise(F.array().cast(NONE))


def _random(value: Column) -> Column:
    """Whether a window of ``value``, which has ``WINDOW`` characters at least, is as random as its class asks."""
    terms = F.array(*[F.lit(t).cast("long") for t in _TERMS])
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    codes = F.filter(codes, lambda c: c > 0)
    zeros = F.array_repeat(F.lit(0), len(ALPHABET))
    kinds = {  # places in the alphabet
        "letters": lambda c: c.between(1, 52), "digits": lambda c: c.between(53, 62), "signs": lambda c: c > 62,
        "others": lambda c: c.between(7, 26) | c.between(33, 52),  # letters that are no hexadecimal digit
    }

    def term(c: Column) -> Column:
        return F.element_at(terms, c + 1)

    def step(s: Column, pair: Column) -> Column:
        """One character in; the one that leaves the window out."""
        into, out = pair["into"], pair["out"]
        there = F.element_at(s["counts"], into)
        gained = s["sum"] + term(there + 1) - term(there)
        leaving = F.element_at(s["counts"], F.greatest(out, F.lit(1))) + (out == into).cast("int")
        total = F.when(out == 0, gained).otherwise(gained - term(leaving) + term(leaving - 1))
        counts = F.transform(
            s["counts"], lambda c, i: c + (i + 1 == into).cast("int") - (i + 1 == out).cast("int"))
        of_kind = [(s[k] + holds(into).cast("int") - holds(out).cast("int")).alias(k) for k, holds in kinds.items()]
        return F.struct(counts.alias("counts"), total.alias("sum"), (s["n"] + 1).alias("n"), *of_kind, s["found"].alias("found"))

    def judged(s: Column) -> Column:
        both = (s["letters"] > 0) & (s["digits"] > 0)
        plain = s["signs"] == 0
        limit = (
            F.when(plain & (s["others"] == 0) & both, entropy_limit(HEX_BITS))
            .when(plain & both, entropy_limit(WORD_BITS)).when(plain, entropy_limit(BARE_BITS))
            .when(both, entropy_limit(MIXED_BITS)).otherwise(-1)
        )
        found = s["found"] | ((s["n"] >= WINDOW) & (s["sum"] <= limit))
        return F.struct(*[s[k].alias(k) for k in ("counts", "sum", "n", *kinds)], found.alias("found"))

    pairs = _let(codes, lambda own: F.slice(
        F.zip_with(own, F.concat(F.array_repeat(F.lit(0), WINDOW), own), lambda a, b: F.struct(
            a.alias("into"), b.alias("out"))), F.lit(1), F.size(own)))
    start = F.struct(zeros.alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"),
                     *[F.lit(0).alias(k) for k in kinds], F.lit(False).alias("found"))
    return F.aggregate(pairs, start, lambda s, pair: _let(step(s, pair), judged), lambda s: s["found"])


def _span(start: Column, end: Column, value: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), value.alias("value"))


def _cut(runs: Column, spans: Column) -> Column:
    """What is left of ``runs`` outside ``spans``, in pieces of ``WINDOW`` characters at least."""
    def pieces(r: Column) -> Column:
        hit = F.filter(spans, lambda b: (b["start"] < r["end"]) & (b["end"] > r["start"]))

        def parts(h: Column) -> Column:
            begins = F.array_distinct(F.concat(F.array(r["start"]), F.transform(h, lambda b: b["end"])))
            free = F.filter(begins, lambda p: (p < r["end"]) & ~F.exists(h, lambda b: (b["start"] <= p) & (b["end"] > p)))

            def piece(p: Column) -> Column:
                behind = F.filter(h, lambda b: b["start"] >= p)
                end = F.coalesce(F.array_min(F.transform(behind, lambda b: b["start"])), r["end"])
                return _span(p, end, F.substr(r["value"], (p - r["start"] + 1).cast("int"), (end - p).cast("int")))

            return F.transform(free, piece)

        return _let(hit, lambda h: F.when(F.size(h) == 0, F.array(_span(r["start"], r["end"], r["value"]))).otherwise(parts(h)))

    return F.filter(F.flatten(F.transform(runs, pieces)), lambda p: p["end"] - p["start"] >= WINDOW)


def _words(runs: Column) -> Column:
    """The runs of letters and digits, of ``WINDOW`` characters at least, within ``runs``."""
    return F.flatten(F.transform(runs, lambda r: F.transform(_matches(r["value"], _WORD), lambda m: _span(
        r["start"] + m["start"], r["start"] + m["end"], m["value"]))))


def with_secrets(docs: DataFrame, text: str = "text", name: str = "secrets", allowed: tuple = ALLOWED) -> DataFrame:
    """``docs`` with column ``name``: ``array<struct<start, end, kind, base>>`` by start, then kind as listed.

    Positions count code points, the end is exclusive. Base kinds are always
    reported. A random run of letters and digits, or else what is left of a
    candidate, is reported as ``entropy`` unless it fits an ``allowed`` pattern. A
    null or empty text has no secret, repeated rows stay, an empty table gives an
    empty result. A column of ``docs`` that bears the name is replaced.
    """
    kept = docs.drop(name)
    own = {k: unused(kept, f"found_{k}") for k in KINDS}
    whole, words, rest = (unused(kept, n) for n in ("found_base", "found_words", "found_rest"))
    value = F.coalesce(F.col(text), F.lit(""))
    base = kept.withColumns({
        own["assign"]: F.filter(_matches(value, ASSIGN, 2), lambda s: F.length(s["value"]) >= 6),
        own["access"]: _matches(value, ACCESS),
        own["hex"]: _matches(value, HEX),
        own["entropy"]: _matches(value, CANDIDATE),
    })

    def secret(s: Column) -> Column:
        harmless = F.lit(False)
        for pattern in allowed:
            harmless = harmless | s["value"].rlike(pattern)
        return ~harmless & _random(s["value"])

    def labelled(column: str, kind: str) -> Column:
        return F.transform(column, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end")))

    spans = (
        base.withColumn(whole, F.concat(*[labelled(own[k], k) for k in KINDS[:3]]))
        .withColumn(own["entropy"], _cut(F.col(own["entropy"]), F.col(whole)))
        .withColumn(words, F.filter(_words(F.col(own["entropy"])), secret))
        .withColumn(rest, F.filter(_cut(F.col(own["entropy"]), F.col(words)), lambda s: s["value"].rlike(_SIGN) & secret(s)))
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])
    found = F.transform(
        F.array_sort(F.concat(whole, labelled(words, "entropy"), labelled(rest, "entropy"))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                           F.element_at(kinds, s["rank"] + 1).alias("kind"), (s["rank"] < 3).alias("base")),
    )
    return spans.withColumn(name, found).select(*kept.columns, name)
