"""File content: lossy decoding and checksums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def decode_lossy(content: Column) -> Column:
    """Bytes as UTF-8 text; every invalid sequence becomes U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def checksum(content: Column) -> Column:
    """SHA-256 in hex, of raw bytes or of a text's UTF-8 bytes."""
    return F.sha2(content, 256)
