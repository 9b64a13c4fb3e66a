"""Picking entities: name filter, latest period, top n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.operators.joins import MAX_BROADCAST_ROWS

# Fixed value: names with a space or a hyphen are left out.
NAME_SEPARATORS = " |-"


def filter_regex_not(df: DataFrame, name: str, pattern: str = NAME_SEPARATORS) -> DataFrame:
    return df.where(~F.col(name).rlike(pattern))


def filter_latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows whose period text contains the greatest one (string order).

    The maximum is a scalar subquery: one value whatever the size of ``df``.
    """
    latest = df.agg(F.max(period).alias("latest")).scalar()
    return df.where(F.contains(F.col(period), latest))


def top_entities(
    records: DataFrame,
    *,
    name: str = "city",
    period: str = "year",
    measure: Column | str = "value",
    within: Sequence[str] = (),
    prefetch: int = 30,
    n: int = 10,
) -> DataFrame:
    """Top ``n`` rows of the latest period among the ``prefetch`` largest entities.

    Steps, in this order: the ``prefetch`` entities with the largest measure, names
    without separators, rows of the latest period left, first ``n``. An entity
    without a row in that period falls out. Equal measures are ordered by name. Equal
    names are one entity unless columns ``within`` which they count, as a country, differ.

    Both limits are part of the result, and each is a top-k that keeps k rows per
    task; no whole sort takes place.
    """
    size = (F.col(measure) if isinstance(measure, str) else measure).cast("double")
    parts = {f"_within_{i}": column for i, column in enumerate(within)}
    largest = (
        records.groupBy(
            F.col(name).alias("_entity"), *[F.col(c).alias(k) for k, c in parts.items()]
        )
        .agg(F.max(size).alias("_size"))
        .orderBy(F.desc_nulls_last("_size"), "_entity", *parts)
        .limit(prefetch)
    )
    same = F.col(name) == F.col("_entity")
    for k, c in parts.items():
        same = same & F.col(c).eqNullSafe(F.col(k))
    kept = records.join(
        F.broadcast(largest) if prefetch <= MAX_BROADCAST_ROWS else largest, same
    )
    recent = filter_latest_period(filter_regex_not(kept, name), period)
    return (
        recent.orderBy(F.desc_nulls_last("_size"), name, *within, size.desc())
        .limit(n)
        .select(*records.columns)
    )
