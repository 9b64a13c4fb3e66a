"""Days per weather condition category, per period and group."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.functions import normalised

# Condition texts of each category, upper case.
SUNNY = "SUNNY"
RAIN = [
    "LIGHT DRIZZLE",
    "PATCHY RAIN POSSIBLE",
    "LIGHT RAIN",
    "LIGHT RAIN SHOWER",
    "MODERATE RAIN",
    "MODERATE OR HEAVY RAIN SHOWER",
    "HEAVY RAIN",
]
CLOUDY = ["OVERCAST", "CLOUDY", "PARTLY CLOUDY"]
THUNDER = "THUNDER"

WEATHER_CATEGORIES: dict[str, Callable[[Column], Column]] = {
    "sunny": lambda c: c == SUNNY,
    "rain": lambda c: c.isin(RAIN),
    "cloudy": lambda c: c.isin(CLOUDY),
    "thunder": lambda c: c.contains(THUNDER),
}


def condition_counts(
    df: DataFrame,
    period: Column,
    *,
    period_name: str,
    suffix: str,
    group: str = "city",
    condition: str = "weather_condition",
    categories: Mapping[str, Callable[[Column], Column]] = WEATHER_CATEGORIES,
    count_name: str = "{category}_day_count_{suffix}",
) -> DataFrame:
    """Rows per category for each (period, group).

    Categories may overlap or miss a row; a NULL condition counts nowhere, and a
    group without any match keeps its row of zeros. The counts combine before the
    shuffle, so a hot group sends one row per task.
    """
    return (
        df.select(period.alias(period_name), group, normalised(condition).alias("_condition"))
        .groupBy(period_name, group)
        .agg(
            *[
                F.count_if(matches(F.col("_condition"))).alias(
                    count_name.format(category=category, suffix=suffix)
                )
                for category, matches in categories.items()
            ]
        )
    )
