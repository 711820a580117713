"""Extractive summaries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lead_sentences(text: Column, count: int) -> Column:
    """The first ``count`` sentences, trimmed; empty when there are none, also for NULL."""
    lead = F.regexp_extract(F.coalesce(text, F.lit("")), r"^((?:[^.!?]*+[.!?]++\s*+){1,%d})" % count, 1)
    return F.regexp_replace(lead, r"^\s+|\s+$", "")
