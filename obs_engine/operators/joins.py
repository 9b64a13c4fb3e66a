"""Broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine.functions import quoted

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def row_width(df: DataFrame) -> Column:
    """About how many bytes a row takes: 16 for a number or date, else its text's length."""
    width = F.lit(0)
    for field in df.schema:
        c = F.col(quoted(field.name))
        if isinstance(field.dataType, T.StringType):
            width += F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(field.dataType, (T.NumericType, T.DatetimeType)):
            width += 16
        else:
            width += F.octet_length(F.to_json(F.struct(c)))
    return width


def is_small(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Count whether ``df`` is within both limits; looks at ``max_rows + 1`` rows at most."""
    seen = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(row_width(df)).alias("bytes"))
    n, size = seen.first()
    return n <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to be small, else unchanged.

    Without the hint the join stays a shuffled one, where adaptive execution splits
    skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
