"""High-water marks, extraction windows and work lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Day = dt.date | str


def _date(day: Day) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def high_water_mark(df: DataFrame, column: str = "incremental_value") -> DataFrame:
    """One row, ``mark``: the greatest value, NULL if there is none."""
    return df.agg(F.max(column).alias("mark"))


def window_bounds(mark: Day | None, as_of: Day, days_back: int) -> tuple[dt.date, dt.date]:
    """Days still to load, ``[start, end)``: since the mark, else ``days_back`` days."""
    end = _date(as_of)
    if mark is None:
        return end - dt.timedelta(days=days_back), end
    return _date(mark) + dt.timedelta(days=1), end


def extraction_window(
    df: DataFrame, day: str, *, mark: Day | None, as_of: Day, days_back: int
) -> DataFrame:
    """Rows of the days still to load. Up to date means no rows, not an error.

    The bounds are literals of the column's own type, so the scan can use them.
    """
    start, end = window_bounds(mark, as_of, days_back)
    if isinstance(df.schema[day].dataType, T.StringType):
        low, high = F.lit(start.isoformat()), F.lit(end.isoformat())
    else:
        low, high = F.lit(start), F.lit(end)
    return df.where((F.col(day) >= low) & (F.col(day) < high))


def work_list(entities: DataFrame, start: Day | Column, end: Day | Column) -> DataFrame:
    """Each row of ``entities`` with each date of ``[start, end)``.

    The dates come from a sequence per row, so there is no join. An empty range gives
    no rows (a bare sequence would raise).
    """
    low = start if isinstance(start, Column) else F.lit(_date(start))
    last = F.date_sub(end if isinstance(end, Column) else F.lit(_date(end)), 1)
    days = F.when(low <= last, F.sequence(low, last))
    return entities.select("*", F.explode(days).alias("date"))


def missing_keys(wanted: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the work list whose key is not loaded yet."""
    return wanted.join(loaded.select(*keys).distinct(), keys, "left_anti")
