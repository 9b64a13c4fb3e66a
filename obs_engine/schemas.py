"""Explicit schemas of the landed documents and the small tables.

Reading with these never infers, so two batches cannot drift apart: fields not
listed are dropped, missing ones are NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType | str) -> T.StructType:
    schema = T.StructType()
    for name, dtype in fields.items():
        schema.add(name, dtype)
    return schema


DAY = _struct(
    maxtemp_c="double",
    mintemp_c="double",
    maxwind_kph="double",
    totalprecip_mm="double",
    avgvis_km="double",
    avghumidity="double",
    condition=_struct(text="string"),
    uv="double",
)

ASTRO = _struct(
    sunrise="string",
    sunset="string",
    moonrise="string",
    moonset="string",
    moon_phase="string",
    moon_illumination="string",
)

FORECAST_DAY = _struct(date="string", day=DAY, astro=ASTRO)

WEATHER = _struct(
    City_Name="string",
    forecast=_struct(forecastday=T.ArrayType(FORECAST_DAY)),
)

POPULATION = _struct(
    data=T.ArrayType(
        _struct(
            city="string",
            country="string",
            populationCounts=T.ArrayType(_struct(year="string", value="string")),
        )
    )
)

INCREMENT_LOG = _struct(log_date="string", incremental_value="string")

RUN_LEDGER = _struct(
    run_timestamp="string",
    run_id="integer",
    run_status="string",
    run_config="string",
    run_log="string",
)

RAW_WEATHER_KEYS = ["City_Name", "date"]
