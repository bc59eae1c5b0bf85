"""Joins against key sets whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether a table is within the row and byte bounds; reads at most one row beyond the bound."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Hint a broadcast only after checking the size; beyond it the join shuffles as usual."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def anti_join(
    left: DataFrame, keys: DataFrame, on: list[str], check_size: bool = False, unique: bool = False
) -> DataFrame:
    """Rows of ``left`` with no equal key.

    Keys that may repeat are made distinct before they are shuffled or sent; ``unique`` says that they
    do not. Without a broadcast AQE splits the partitions a hot key of ``left`` fills.
    """
    wanted = keys.select(*on) if unique else keys.select(*on).distinct()
    return left.join(broadcast_if_small(wanted) if check_size else wanted, on, "left_anti")


def semi_join(left: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` with an equal key."""
    return left.join(keys.select(*on).distinct(), on, "left_semi")
