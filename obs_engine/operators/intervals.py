"""Sets of days per entity as disjoint intervals, first and last day included."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.functions import quoted

FIRST, LAST = "first_day", "last_day"


def merge_intervals(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and adjacent intervals of an entity as one.

    An interval begins a new one if it begins more than a day after all before it have ended.
    """
    ordered = Window.partitionBy(*map(quoted, keys)).orderBy(FIRST, LAST)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(LAST).over(before)
    begins = reached.isNull() | (F.col(FIRST) > F.date_add(reached, 1))
    numbered = intervals.select(*map(quoted, keys), FIRST, LAST, begins.alias("_begins")).select(
        "*", F.count_if(F.col("_begins")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("_part")
    )
    return numbered.groupBy(*map(quoted, keys), "_part").agg(
        F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST)
    ).drop("_part")


def days_to_intervals(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """The days of each entity as intervals; repeated days count once.

    Days in a row have a constant difference to their number, so one window finds the parts.
    """
    days = rows.select(*map(quoted, keys), F.to_date(F.col(quoted(day))).alias("_day")).distinct()
    number = F.row_number().over(Window.partitionBy(*map(quoted, keys)).orderBy("_day"))
    return (
        days.withColumn("_part", F.date_sub("_day", number))
        .groupBy(*map(quoted, keys), "_part")
        .agg(F.min("_day").alias(FIRST), F.max("_day").alias(LAST))
        .drop("_part")
    )


def subtract_intervals(wanted: DataFrame, covered: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of ``wanted`` intervals that no ``covered`` one has.

    ``wanted`` intervals of an entity must not overlap. What is covered is merged first, so
    what is left lies between one covered interval and the next; each of those, and the one
    before the first, meets the wanted ones of its entity.
    """
    merged = merge_intervals(covered, keys)
    ordered = Window.partitionBy(*map(quoted, keys)).orderBy(FIRST)
    ends = merged.select(
        *map(quoted, keys),
        F.date_add(LAST, 1).alias("_from"),
        F.date_sub(F.lead(FIRST).over(ordered), 1).alias("_to"),
    )
    heads = merged.groupBy(*map(quoted, keys)).agg(F.date_sub(F.min(FIRST), 1).alias("_to"))
    between = ends.unionByName(heads, allowMissingColumns=True)
    # An entity that has nothing covered matches nothing and keeps all it wants.
    met = wanted.join(between, keys, "left")
    first = F.greatest(FIRST, "_from")
    last = F.least(LAST, "_to")
    return (
        met.select(*map(quoted, keys), first.alias(FIRST), last.alias(LAST))
        .where(F.col(FIRST) <= F.col(LAST))
        .distinct()
    )


def outside_intervals(rows: DataFrame, intervals: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Rows whose day lies in none of the intervals of their entity."""
    named = intervals.select(
        *[F.col(quoted(k)).alias(f"_of_{k}") for k in keys],
        F.col(FIRST).alias("_first"),
        F.col(LAST).alias("_last"),
    )
    on = F.to_date(F.col(quoted(day))).between(F.col("_first"), F.col("_last"))
    for k in keys:
        on &= F.col(quoted(k)) == F.col(quoted(f"_of_{k}"))
    return rows.join(named, on, "left_anti")


def count_days(intervals: DataFrame) -> DataFrame:
    """``days``: how many days disjoint intervals have together."""
    return intervals.agg(F.coalesce(F.sum(F.date_diff(LAST, FIRST) + 1), F.lit(0)).alias("days"))
