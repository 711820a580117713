"""Small helpers for expressions that are written as Spark SQL text.

The text operators exist twice: as DataFrame columns and inside SQL table
functions. Writing them once as SQL text keeps the two the same.
"""

from __future__ import annotations


def raw(pattern: str) -> str:
    """A raw string literal, for regular expressions."""
    quote = '"' if "'" in pattern else "'"
    if quote in pattern:
        raise ValueError("a raw literal cannot hold both kinds of quote")
    return f"r{quote}{pattern}{quote}"


def text_literal(value: str) -> str:
    """A string literal with its special characters escaped."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` inside ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"
