"""Serving models, each a function of the observations it is built over.

Any frame with the columns of the unified staging table can be the source, for
example the forecast rows alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from obs_engine.functions import year_month, year_of
from obs_engine.operators.activities import activity_flags
from obs_engine.operators.conditions import condition_counts
from obs_engine.operators.ranking import rank_metrics_by_day, rank_metrics_by_month


def condition_count_by_month(df: DataFrame) -> DataFrame:
    return condition_counts(
        df, year_month("date"), period_name="year_month", suffix="by_month"
    )


def condition_count_by_year(df: DataFrame) -> DataFrame:
    return condition_counts(df, year_of("date"), period_name="year", suffix="by_year")


SERVING_MODELS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "serving_activities": activity_flags,
    "serving_rank_city_metrics_by_day": rank_metrics_by_day,
    "serving_rank_city_metrics_by_month": rank_metrics_by_month,
    "serving_weather_condition_count_by_month": condition_count_by_month,
    "serving_weather_condition_count_by_year": condition_count_by_year,
}
