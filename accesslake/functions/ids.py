"""Surrogate ids computed from the natural key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_id(natural_key: Column) -> Column:
    """First 128 bits of the key's SHA2-256, as hex; NULL for a NULL key.

    The id is a pure function of the key, so a fact row finds its dimension row without a join,
    and retries or parallel batches give the same id. Keys and user agents are written by whoever
    sends a request; 64-bit ids would collide at some billions of keys, or on purpose, and merge two
    files' counts. 128 bits of a cryptographic digest do neither.
    """
    return F.substring(F.sha2(natural_key.cast("binary"), 256), 1, 32)
