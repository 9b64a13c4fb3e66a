"""Flags and condition counts on hand-made rows."""

import datetime as dt

import pytest

from obs_engine.operators import activity_flags, with_indoor_activity
from obs_engine.plans import condition_count_by_month, condition_count_by_year

COLUMNS = {
    "date": "string",
    "city": "string",
    "weather_condition": "string",
    "min_temp_celcius": "double",
    "max_temp_celcius": "double",
    "max_wind_kph": "double",
    "average_humity": "double",
    "moon_phase": "string",
    "moon_illumination": "string",
    "sunrise": "string",
    "sunset": "string",
}
SCHEMA = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
USUAL = {
    "date": "2022-10-05",
    "city": "Perth",
    "weather_condition": "Sunny",
    "min_temp_celcius": 12.0,
    "max_temp_celcius": 24.0,
    "max_wind_kph": 10.0,
    "average_humity": 50.0,
    "moon_phase": "Full Moon",
    "moon_illumination": "84",
    "sunrise": "05:30 AM",
    "sunset": "07:15 PM",
}


def frame(spark, *changes):
    rows = [tuple((USUAL | change)[c] for c in COLUMNS) for change in changes]
    return spark.createDataFrame(rows, SCHEMA)


def flags(spark, **change):
    return activity_flags(frame(spark, change)).first()


def test_usual_day(spark):
    row = flags(spark)
    assert row["date"] == dt.date(2022, 10, 5)
    assert row["day_duration"] == dt.timedelta(seconds=49_500)
    assert [row[f] for f in ("werewolf", "picnics", "sailing", "happy", "moonbathing")] == [
        "yes"
    ] * 5
    assert row["indoor_activity"] == "no"


def test_nulls_give_no(spark):
    nothing = {c: None for c in COLUMNS if c not in ("date", "city")}
    row = flags(spark, **nothing)
    for flag in ("werewolf", "picnics", "indoor_activity", "sailing", "happy", "moonbathing"):
        assert row[flag] == "no"
    assert row["day_duration"] is None


@pytest.mark.parametrize(
    "change, flag, expected",
    [
        ({"weather_condition": " sunny "}, "werewolf", "yes"),
        ({"weather_condition": " sunny "}, "indoor_activity", "no"),
        ({"moon_phase": " full moon"}, "werewolf", "yes"),
        ({"weather_condition": "Mist"}, "werewolf", "no"),
        ({"weather_condition": "Mist"}, "indoor_activity", "yes"),
        ({"weather_condition": "Mist"}, "picnics", "no"),
        ({"min_temp_celcius": 10.0, "max_temp_celcius": 30.0}, "picnics", "yes"),
        (
            {"min_temp_celcius": 10.0, "max_temp_celcius": 30.0, "weather_condition": "Overcast"},
            "picnics",
            "maybe",
        ),
        ({"min_temp_celcius": 9.9}, "picnics", "no"),
        ({"max_temp_celcius": 30.1}, "picnics", "no"),
        ({"weather_condition": "Partly cloudy"}, "picnics", "yes"),
        ({"max_wind_kph": 9.0}, "sailing", "yes"),
        ({"max_wind_kph": 23.0}, "sailing", "yes"),
        ({"max_wind_kph": 8.9}, "sailing", "no"),
        ({"max_wind_kph": 23.1}, "sailing", "no"),
        ({"max_temp_celcius": 25.0, "average_humity": 30.0}, "happy", "yes"),
        ({"max_temp_celcius": 25.0, "average_humity": 60.0}, "happy", "yes"),
        ({"max_temp_celcius": 25.0, "average_humity": 61.0}, "happy", "no"),
        ({"max_temp_celcius": 25.1}, "happy", "no"),
        ({"moon_illumination": " 84 "}, "moonbathing", "yes"),
        ({"moon_illumination": "79"}, "moonbathing", "no"),
    ],
)
def test_limits(spark, change, flag, expected):
    assert flags(spark, **change)[flag] == expected


def test_numeric_illumination_is_rounded(spark):
    df = frame(spark, {"moon_illumination": "79.5"}).selectExpr(
        "* except (moon_illumination)", "cast(moon_illumination as double) as moon_illumination"
    )
    assert activity_flags(df).first()["moonbathing"] == "yes"


def test_indoor_set_of_another_source(spark):
    forecast = frame(spark, {"weather_condition": "Mist"}, {"weather_condition": "Fog"})
    history = frame(spark, {"weather_condition": "mist"}, {"weather_condition": None})
    flagged = activity_flags(forecast, indoor_source=history)
    got = {r["weather_condition"]: r["indoor_activity"] for r in flagged.collect()}
    assert got == {"Mist": "yes", "Fog": "no"}


def test_indoor_set_is_not_trimmed(spark):
    rows = frame(spark, {"weather_condition": "Mist "})
    source = frame(spark, {"weather_condition": "Mist"})
    assert with_indoor_activity(rows, source).first()["indoor_activity"] == "no"


def test_own_rows_as_source_need_no_set(spark):
    """The flag without a set equals the flag with the set of the rows themselves."""
    rows = frame(
        spark,
        *[
            {"city": str(i), "weather_condition": c}
            for i, c in enumerate(["Sunny", " SUNNY", "Mist", " Mist", None, "", "sunny rain"])
        ],
    )
    plain = with_indoor_activity(rows).select("city", "indoor_activity").collect()
    joined = with_indoor_activity(rows, rows).select("city", "indoor_activity").collect()
    assert sorted(plain) == sorted(joined)


def test_condition_counts(spark):
    texts = [" sunny ", "Patchy light rain with thunder", "Mist", None, "Cloudy", "HEAVY RAIN"]
    rows = frame(spark, *[{"weather_condition": t} for t in texts])
    rows = rows.unionByName(frame(spark, {"weather_condition": "Mist", "city": "Cairns"}))
    months = {r["city"]: r for r in condition_count_by_month(rows).collect()}
    assert months["Perth"].asDict() == {
        "year_month": "2022-10",
        "city": "Perth",
        "sunny_day_count_by_month": 1,
        "rain_day_count_by_month": 1,
        "cloudy_day_count_by_month": 1,
        "thunder_day_count_by_month": 1,
    }
    assert list(months["Cairns"])[2:] == [0, 0, 0, 0]
    year = {r["city"]: r for r in condition_count_by_year(rows).collect()}["Perth"]
    assert year["year"] == 2022 and year["thunder_day_count_by_year"] == 1
