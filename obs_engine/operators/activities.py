"""Rule-based activity flags per observation. A NULL input gives 'no'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.functions import clock_diff, day_of, normalised, whole_number
from obs_engine.operators.conditions import SUNNY
from obs_engine.operators.joins import broadcast_if_small

# Fixed values of the rules.
FULL_MOON = "FULL MOON"
PICNIC_YES = ["SUNNY", "PARTLY CLOUDY"]
PICNIC_MAYBE = ["OVERCAST", "CLOUDY"]
PICNIC_MIN_TEMP = 10.0
PICNIC_MAX_TEMP = 30.0
SAILING_WIND = (9.0, 23.0)
HAPPY_MAX_TEMP = 25.0
HAPPY_HUMIDITY = (30.0, 60.0)
MOONBATHING_ILLUMINATION = 80


def _yes_if(rule: Column) -> Column:
    return F.when(rule, "yes").otherwise("no")


def werewolf() -> Column:
    return _yes_if(
        (normalised("moon_phase") == FULL_MOON) & (normalised("weather_condition") == SUNNY)
    )


def picnics() -> Column:
    condition = normalised("weather_condition")
    mild = (F.col("min_temp_celcius") >= PICNIC_MIN_TEMP) & (
        F.col("max_temp_celcius") <= PICNIC_MAX_TEMP
    )
    return (
        F.when(condition.isin(PICNIC_YES) & mild, "yes")
        .when(condition.isin(PICNIC_MAYBE) & mild, "maybe")
        .otherwise("no")
    )


def sailing() -> Column:
    return _yes_if(F.col("max_wind_kph").between(*SAILING_WIND))


def happy() -> Column:
    return _yes_if(
        (F.col("max_temp_celcius") <= HAPPY_MAX_TEMP)
        & F.col("average_humity").between(*HAPPY_HUMIDITY)
    )


def moonbathing(df: DataFrame) -> Column:
    illumination = whole_number("moon_illumination", df.schema["moon_illumination"].dataType)
    return _yes_if(illumination >= MOONBATHING_ILLUMINATION)


def indoor_conditions(df: DataFrame) -> DataFrame:
    """Distinct upper-case conditions that are not sunny; not trimmed, never NULL."""
    return (
        df.where(normalised("weather_condition") != SUNNY)
        .select(F.upper("weather_condition").alias("indoor_time"))
        .distinct()
    )


def with_indoor_activity(df: DataFrame, indoor_source: DataFrame | None = None) -> DataFrame:
    """Add ``indoor_activity``: is the condition among the non-sunny ones of the source?

    With the rows themselves as the source (the default) every non-sunny condition is
    in the set by definition and no sunny one is, so the flag needs neither the set
    nor a join. Another source is joined in on its distinct conditions, without a
    broadcast hint: Spark broadcasts the set if it turns out small, and otherwise
    splits the shuffle partition of a frequent condition.
    """
    if indoor_source is None:
        return df.withColumn(
            "indoor_activity", _yes_if(normalised("weather_condition") != SUNNY)
        )
    joined = df.join(
        broadcast_if_small(indoor_conditions(indoor_source)),
        F.upper("weather_condition") == F.col("indoor_time"),
        "left",
    )
    return joined.withColumn(
        "indoor_activity", _yes_if(F.col("indoor_time").isNotNull())
    ).drop("indoor_time")


def activity_flags(df: DataFrame, indoor_source: DataFrame | None = None) -> DataFrame:
    """Activity table of the observations ``df``, one row per row of ``df``."""
    return with_indoor_activity(df, indoor_source).select(
        day_of("date").alias("date"),
        "city",
        "weather_condition",
        werewolf().alias("werewolf"),
        picnics().alias("picnics"),
        "indoor_activity",
        sailing().alias("sailing"),
        happy().alias("happy"),
        moonbathing(df).alias("moonbathing"),
        clock_diff("sunset", "sunrise").alias("day_duration"),
    )
