"""Documents to rows, unions and selection."""

import json

import pytest
from pyspark.sql import functions as F

from obs_engine import operators as ops
from obs_engine.plans import stage, unify
from obs_engine.plans.staging import STAGED_COLUMNS
from obs_engine.sources import read_population, read_weather

DOCUMENT = {
    "City_Name": "Perth",
    "location": {"name": "dropped"},
    "forecast": {
        "forecastday": [
            {
                "date": "2022-10-05",
                "day": {"maxtemp_c": 21.5, "condition": {"text": "Sunny", "code": 1000}},
                "astro": {"sunrise": "05:30 AM", "moon_phase": "Full Moon"},
            },
            {"date": "2022-10-06", "day": {"maxtemp_c": 20}},
        ]
    },
}


def landed(spark, folder, *documents):
    lines = [(json.dumps(d),) for d in documents]
    spark.createDataFrame(lines, "value string").write.text(folder)
    return folder


def test_weather_documents(spark, folder):
    raw = ops.raw_weather(read_weather(spark, landed(spark, folder, DOCUMENT)))
    assert set(STAGED_COLUMNS) <= set(raw.columns)
    rows = {r["date"]: r for r in raw.collect()}
    assert len(rows) == 2
    assert rows["2022-10-05"]["day.condition.text"] == "Sunny"
    assert rows["2022-10-06"]["day.maxtemp_c"] == 20.0
    assert rows["2022-10-06"]["astro.sunrise"] is None
    assert rows["2022-10-06"]["City_Name"] == "Perth"
    assert rows["2022-10-05"]["arrived_at"] is not None


def test_staging_names(spark, folder):
    raw = ops.raw_weather(read_weather(spark, landed(spark, folder, DOCUMENT)))
    staged = stage(raw)
    assert staged.columns[-2:] == ["astro.moon_phase", "astro.moon_illumination"]
    assert len(staged.columns) == 16
    both = unify(raw, raw)
    assert both.columns[0] == "from_table"
    assert both.columns[-2:] == ["moon_phase", "moon_illumination"]
    counts = {r[0]: r[1] for r in both.groupBy("from_table").count().collect()}
    assert counts == {"historic": 2, "forecast": 2}  # nothing is deduplicated


def test_document_without_days_gives_no_rows(spark, folder):
    empty = {"City_Name": "Perth", "forecast": {"forecastday": []}}
    documents = read_weather(spark, landed(spark, folder, empty))
    assert ops.raw_weather(documents).count() == 0
    assert ops.rejected_weather(documents).count() == 0


def test_error_document_fails(spark, folder):
    documents = read_weather(spark, landed(spark, folder, DOCUMENT, {"City_Name": "Cairns"}))
    with pytest.raises(Exception, match="document without days"):
        ops.raw_weather(documents).collect()
    assert ops.raw_weather(documents, strict=False).count() > 0
    assert [r.City_Name for r in ops.rejected_weather(documents).collect()] == ["Cairns"]


def test_malformed_document(spark, folder):
    landed(spark, folder, DOCUMENT)
    spark.createDataFrame([('{"City_Name": "Cai',)], "value string").write.mode("append").text(
        folder
    )
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read_weather(spark, folder).collect()
    assert read_weather(spark, folder, mode="DROPMALFORMED").count() == 1


def test_population_documents(spark, folder):
    document = {
        "data": [
            {
                "city": city,
                "country": "Australia",
                "populationCounts": [{"year": y, "value": v} for y, v in counts],
            }
            for city, counts in [
                ("Perth", [("2010", "20"), ("2011", "22")]),
                ("Gold Coast", [("2011", "90")]),
                ("Wagga-Wagga", [("2012", "80")]),
                ("Cairns", [("2010", "70")]),
                ("Darwin", [("2011", "9")]),
            ]
        ]
    }
    records = ops.raw_population(read_population(spark, landed(spark, folder, document)))
    assert records.count() == 6
    top = ops.top_entities(records)
    # Filtered names do not set the latest year, and Cairns has no row in it.
    assert [(r["city"], r["year"]) for r in top.collect()] == [("Perth", "2011"), ("Darwin", "2011")]
    first = ops.top_entities(records, n=1).collect()
    assert [r["city"] for r in first] == ["Perth"]
    # The larger cities fill the prefetch before names and years are looked at.
    assert ops.top_entities(records, prefetch=2).collect() == []
    assert [r["city"] for r in ops.top_entities(records, prefetch=3).collect()] == ["Cairns"]


def test_name_filter(spark):
    names = spark.createDataFrame([("Gold Coast",), ("Wagga-Wagga",), ("Perth",)], "city string")
    kept = [r["city"] for r in ops.filter_regex_not(names, "city").collect()]
    assert kept == ["Perth"]
    assert all(" " not in c and "-" not in c for c in kept)


def test_latest_period(spark):
    rows = spark.createDataFrame(
        [("A", "2010"), ("A", "2011"), ("B", "2010")], "city string, year string"
    )
    assert [tuple(r) for r in ops.filter_latest_period(rows, "year").collect()] == [("A", "2011")]


def test_explode_and_flatten(spark):
    df = spark.createDataFrame(
        [(1, ([(2, ("x",), [1, 2])],))],
        "id int, outer struct<inner: array<struct<a: int, b: struct<c: string>, d: array<int>>>>",
    )
    flat = ops.flatten_struct(ops.explode_records(df, "outer.inner", ["id"]))
    assert flat.columns == ["a", "b.c", "d", "id"]
    assert flat.first().asDict() == {"a": 2, "b.c": "x", "d": [1, 2], "id": 1}


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    rows = [r.asDict() for r in ops.union_by_name(a, b).orderBy("x").collect()]
    assert rows == [{"x": 1, "y": 2, "z": None}, {"x": 4, "y": None, "z": 3}]


def test_nan_to_null(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (float("nan"), "b"), (None, "NaN")], "`m.x` double, s string"
    )
    clean = ops.nan_to_null(df)
    assert clean.columns == ["m.x", "s"]
    assert clean.agg(F.avg("`m.x`"), F.count("`m.x`")).first() == (1.0, 1)
    assert clean.where("s = 'NaN'").count() == 1
