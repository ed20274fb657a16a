"""Uniform draws keyed by record id: the same on every engine, partitioning and retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform_draw(key: Column, seed: int) -> Column:
    """A double in [0, 1) from the first 52 bits of md5('seed:key')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)
