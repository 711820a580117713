"""Cosine distance and hashed term vectors, as SQL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from shelfmark.functions.sqltext import let
from shelfmark.functions.text import PLAIN, Analyzer, lexemes_sql


def vector_literal(values: Sequence[float]) -> str:
    """A query vector, narrowed to float like a stored one."""
    return "array(" + ", ".join(f"cast({float(v)!r}D AS float)" for v in values) + ")"


def _dot(a: str, b: str) -> str:
    return (
        f"aggregate(zip_with({a}, {b}, (p, q) -> cast(p AS double) * cast(q AS double)), "
        "0.0D, (s, v) -> s + v)"
    )


def squared_norm_sql(a: str) -> str:
    return _dot(a, a)


def cosine_distance_sql(a: str, b: str, b_squared: str | None = None) -> str:
    """1 - cosine similarity. A zero vector gives NaN, unequal sizes an error.

    ``b_squared`` is the squared norm of ``b``, where it is at hand.
    """
    similarity = f"try_divide({_dot(a, b)}, sqrt({_dot(a, a)} * {b_squared or _dot(b, b)}))"
    distance = let(
        "c", similarity,
        "CASE WHEN c IS NULL THEN double('NaN') WHEN c > 1 THEN 0.0D "
        "WHEN c < -1 THEN 2.0D ELSE 1.0D - c END",
    )
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL "
        f"WHEN size({a}) <> size({b}) THEN raise_error(concat('different vector dimensions ', "
        f"size({a}), ' and ', size({b}))) ELSE {distance} END"
    )


def term_buckets_sql(text: str, dimension: int, analyzer: Analyzer = PLAIN) -> str:
    """Hash bucket of every term of ``text``, in text order."""
    terms = f"filter({lexemes_sql(text, analyzer)}, t -> t <> '')"
    return (
        f"transform({terms}, t -> "
        f"cast(cast(conv(substr(md5(t), 1, 8), 16, 10) AS bigint) % {dimension} AS int))"
    )


def hashed_vector_sql(text: str, dimension: int = 64, analyzer: Analyzer = PLAIN) -> str:
    """Term counts per bucket, scaled to unit length; all zero without terms, NULL for NULL."""
    # Runs of equal buckets in sorted order, as map entries; a last -1 ends them.
    runs = (
        f"aggregate(concat(sort_array({term_buckets_sql(text, dimension, analyzer)}), array(-1)), "
        "named_struct('key', -1, 'value', 0, "
        "'runs', cast(array() AS array<struct<key:int,value:int>>)), "
        "(a, b) -> if(a.key = b, named_struct('key', b, 'value', a.value + 1, 'runs', a.runs), "
        "named_struct('key', b, 'value', 1, 'runs', if(a.value = 0, a.runs, "
        "concat(a.runs, array(named_struct('key', a.key, 'value', a.value)))))), a -> a.runs)"
    )
    counts = let(
        "m", f"map_from_entries({runs})",
        f"transform(sequence(0, {dimension - 1}), i -> coalesce(try_element_at(m, i), 0))",
    )
    norm = "sqrt(cast(aggregate(n, 0L, (s, v) -> s + cast(v AS bigint) * v) AS double))"
    vector = let(
        "n", counts,
        let(
            "length", norm,
            "transform(n, v -> cast(coalesce(try_divide(cast(v AS double), length), 0.0D) AS float))",
        ),
    )
    return f"if({text} IS NULL, NULL, {vector})"
