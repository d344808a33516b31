"""Repeatable random-looking choices that survive repartitioning and task retries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest100(key: str | Column, salt: str = "") -> Column:
    """0..99 from the md5 of a key."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
