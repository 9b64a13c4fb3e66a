"""Staging models: raw weather tables to typed, renamed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.functions import quoted
from obs_engine.operators.shaping import union_by_name

# Raw column and its name in the staging tables.
STAGED_COLUMNS = {
    "date": "date",
    "City_Name": "city",
    "day.maxtemp_c": "max_temp_celcius",
    "day.mintemp_c": "min_temp_celcius",
    "day.maxwind_kph": "max_wind_kph",
    "day.totalprecip_mm": "total_rain_mm",
    "day.avgvis_km": "average_visibility_km",
    "day.avghumidity": "average_humity",
    "day.condition.text": "weather_condition",
    "day.uv": "uv_rating",
    "astro.sunrise": "sunrise",
    "astro.sunset": "sunset",
    "astro.moonrise": "moonrise",
    "astro.moonset": "moonset",
    "astro.moon_phase": "astro.moon_phase",
    "astro.moon_illumination": "astro.moon_illumination",
}


def stage(raw: DataFrame) -> DataFrame:
    """One raw table. The two moon columns keep their dotted names here."""
    return raw.select(*[F.col(quoted(c)).alias(name) for c, name in STAGED_COLUMNS.items()])


def unify(raw_historic: DataFrame, raw_forecast: DataFrame) -> DataFrame:
    """Both raw tables with their origin; moon columns without prefix, no dedup."""

    def tagged(raw: DataFrame, origin: str) -> DataFrame:
        staged = stage(raw)
        plain = [F.col(quoted(c)).alias(c.removeprefix("astro.")) for c in staged.columns]
        return staged.select(F.lit(origin).alias("from_table"), *plain)

    return union_by_name(tagged(raw_historic, "historic"), tagged(raw_forecast, "forecast"))
