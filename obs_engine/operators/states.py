"""Monthly aggregates as states that add up: new days are added, corrected ones taken back.

A state has counts and exact sums, so states of parts of a month give that of the month, in any
order, and a row with the sign -1 undoes one with +1. Measures are summed as decimals of ten
places; averages are taken when a state is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.functions import normalised, rounded, year_month
from obs_engine.operators.conditions import WEATHER_CATEGORIES
from obs_engine.operators.ranking import MONTHLY_METRICS
from obs_engine.operators.shaping import union_by_name

STATE_KEYS = ["year_month", "city"]
MEASURES = sorted({source for _, source in MONTHLY_METRICS.values()})
EXACT = "decimal(38,10)"


def _state_columns() -> list[str]:
    sums = [f"{kind}_{m}" for m in MEASURES for kind in ("sum", "n")]
    return ["days", *sums, *[f"{c}_days" for c in WEATHER_CATEGORIES]]


def month_states(rows: DataFrame, sign: str | None = None) -> DataFrame:
    """One state per (month, city) of observations, each counted ``sign`` times (once)."""
    times = F.col(sign) if sign else F.lit(1)
    marked = rows.select(
        year_month("date").alias("year_month"),
        "city",
        times.cast("long").alias("_sign"),
        normalised("weather_condition").alias("_condition"),
        *[F.col(m).cast(EXACT).alias(m) for m in MEASURES],
    )

    def signed(value: Column) -> Column:
        return F.when(F.col("_sign") > 0, value).otherwise(-value)

    aggregates = [F.sum("_sign").alias("days")]
    for m in MEASURES:
        there = F.when(F.col(m).isNotNull(), F.col("_sign")).otherwise(0)
        aggregates += [
            F.coalesce(F.sum(signed(F.col(m))), F.lit(0)).cast(EXACT).alias(f"sum_{m}"),
            F.sum(there).alias(f"n_{m}"),
        ]
    for category, matches in WEATHER_CATEGORIES.items():
        met = F.when(matches(F.col("_condition")), F.col("_sign")).otherwise(0)
        aggregates.append(F.sum(met).alias(f"{category}_days"))
    return marked.groupBy(*STATE_KEYS).agg(*aggregates)


def add_states(*states: DataFrame) -> DataFrame:
    """States of the same keys added up; one that counts no day any more is gone."""
    sums = [
        F.sum(c).cast(EXACT if c.startswith("sum_") else "long").alias(c) for c in _state_columns()
    ]
    added = union_by_name(*states).groupBy(*STATE_KEYS).agg(*sums)
    return added.where(F.col("days") != 0)


def metrics_of_states(states: DataFrame) -> DataFrame:
    """The monthly means and sums, as ``monthly_metrics`` gives them."""

    def value(name: str) -> Column:
        function, source = MONTHLY_METRICS[name]
        count, total = F.col(f"n_{source}"), F.col(f"sum_{source}").cast("double")
        return F.when(count > 0, total / count if function is F.avg else total)

    return states.select(*STATE_KEYS, *[rounded(value(m)).alias(m) for m in MONTHLY_METRICS])


def counts_of_states(states: DataFrame) -> DataFrame:
    """The days per condition category, as ``condition_counts`` gives them by month."""
    named = [F.col(f"{c}_days").alias(f"{c}_day_count_by_month") for c in WEATHER_CATEGORIES]
    return states.select(*STATE_KEYS, *named)
