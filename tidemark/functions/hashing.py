"""Stable hashes that every engine computes alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(*parts: Column | str) -> Column:
    """SHA-256 of the parts joined by colons and written as a JSON string (so in double quotes)."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.sha2(F.concat(F.lit('"'), text, F.lit('"')), 256)


def unit_interval(digest: Column) -> Column:
    """The first 12 hexadecimal digits as a number from 0 to under 1."""
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16**12)


def bucket(digest: Column, n: int) -> Column:
    """The first 8 hexadecimal digits modulo ``n``."""
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n).cast("int")
