"""Repository names, branches, file suffixes and languages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfmark.functions.fixed_values import EXTENSION_LANGUAGE


def repo_name(git_url: Column) -> Column:
    """Last part of a web or ssh remote address, without ``.git``."""
    trimmed = F.regexp_replace(git_url, "/+$", "")
    return F.regexp_replace(F.regexp_extract(trimmed, r"([^/:]*)$", 1), r"\.git$", "")


def path_suffix(path: Column) -> Column:
    """``.ext`` of the last path component; empty for dot files and bare names."""
    return F.regexp_extract(path, r"[^/](\.[^/.]+)$", 1)


def _language(suffix: Column) -> Column:
    pairs = [F.lit(part) for pair in EXTENSION_LANGUAGE.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), suffix)


def counted_language(path: Column) -> Column:
    """Language a file counts for: exact suffix first, then in lower case."""
    suffix = path_suffix(path)
    return F.coalesce(_language(suffix), _language(F.lower(suffix)))


def indexed_language(path: Column) -> Column:
    """Language a file is indexed under: the exact suffix only."""
    return _language(path_suffix(path))


def default_branch(symbolic_ref: Column, remote_text: Column) -> Column:
    """Last part of the symbolic ref, else the remote's HEAD branch, else an error."""
    head_line = r"(?m)^[ \t]*HEAD branch:(.*)$"
    return (
        F.when(symbolic_ref.isNotNull(), F.element_at(F.split(symbolic_ref, "/"), -1))
        .when(remote_text.rlike(head_line), F.trim(F.regexp_extract(remote_text, head_line, 1)))
        .otherwise(F.raise_error(F.lit("no default branch in the remote's description")))
    )
