"""Whole loads and the stream, on a few documents."""

import datetime as dt
import json
import os
from decimal import Decimal
from pathlib import Path

import pytest

from obs_engine import operators as ops
from obs_engine import plans, sources
from obs_engine.streaming import (
    apply_batch,
    fold_states,
    start_month_states,
    start_weather_upsert,
)


def document(city, day, temp, text="Sunny"):
    return {
        "City_Name": city,
        "forecast": {
            "forecastday": [
                {
                    "date": day,
                    "day": {
                        "maxtemp_c": temp,
                        "mintemp_c": temp - 10,
                        "maxwind_kph": 10.0,
                        "totalprecip_mm": 0.5,
                        "avghumidity": 50.0,
                        "condition": {"text": text},
                    },
                    "astro": {
                        "sunrise": "05:30 AM",
                        "sunset": "07:15 PM",
                        "moon_phase": "Full Moon",
                        "moon_illumination": "90",
                    },
                }
            ]
        },
    }


def land(spark, path, *documents):
    lines = [(json.dumps(d),) for d in documents]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def population(spark, path):
    counts = [("Perth", "2"), ("Cairns", "1")]
    land(
        spark,
        path,
        {
            "data": [
                {
                    "city": city,
                    "country": "Australia",
                    "populationCounts": [{"year": "2021", "value": value}],
                }
                for city, value in counts
            ]
        },
    )
    return sources.read_population(spark, path)


@pytest.mark.parametrize("grain", [sources.MONTH, sources.DAY], ids=["months", "days"])
def test_refresh(spark, folder, grain):
    root = f"{folder}/root"
    cities = population(spark, f"{folder}/cities")
    history, forecast = f"{folder}/history", f"{folder}/forecast"
    land(
        spark,
        history,
        document("Perth", "2022-09-29", 20.0),
        document("Perth", "2022-09-30", 21.0, "Mist"),
        document("Cairns", "2022-09-30", 31.0),
        document("Sydney", "2022-09-30", 25.0),  # not a selected city
        document("Perth", "2022-10-01", 99.0),  # today is not history
    )
    land(spark, forecast, document("Perth", "2022-10-01", 22.0))
    arguments = {
        "cities": cities,
        "historic": sources.read_weather(spark, history),
        "forecast": sources.read_weather(spark, forecast),
        "days_back": 30,
        "grain": grain,
    }
    written = plans.refresh(spark, root, as_of="2022-10-01", **arguments)
    assert written["raw_historic"] == 3 and written["raw_forecast"] == 1
    assert rows(plans.read_model(spark, root, "serving_activities"), "city", "indoor_activity") == [
        ("Cairns", "no"),
        ("Perth", "no"),
        ("Perth", "no"),
        ("Perth", "yes"),
    ]
    ranks = plans.read_model(spark, root, "serving_rank_city_metrics_by_day").where(
        "day = '2022-09-30'"
    )
    assert rows(ranks, "city", "rank_of_city_max_temp_by_day") == [("Cairns", 1), ("Perth", 2)]
    assert sources.last_mark(spark, f"{root}/historic_logs") == "2022-09-30"

    # A day later: the forecast day has become history, the forecast has moved on.
    land(spark, history, document("Cairns", "2022-10-01", 30.0))
    forecast = f"{folder}/forecast2"
    land(spark, forecast, document("Perth", "2022-11-02", 23.0))
    arguments |= {
        "historic": sources.read_weather(spark, history),
        "forecast": sources.read_weather(spark, forecast),
    }
    written = plans.refresh(spark, root, as_of="2022-10-02", **arguments)
    assert written["raw_historic"] == 2
    unified = plans.read_model(spark, root, "staging_historic_and_forecast")
    assert rows(unified, "from_table", "date", "city") == [
        ("forecast", "2022-11-02", "Perth"),
        ("historic", "2022-09-29", "Perth"),
        ("historic", "2022-09-30", "Cairns"),
        ("historic", "2022-09-30", "Perth"),
        ("historic", "2022-10-01", "Cairns"),
        ("historic", "2022-10-01", "Perth"),
    ]
    staged = plans.read_model(spark, root, "staging_forecast")
    assert rows(staged, "date") == [("2022-11-02",)]
    years = plans.read_model(spark, root, "serving_weather_condition_count_by_year")
    assert years.columns[:2] == ["year", "city"]
    assert rows(years, "year", "city", "sunny_day_count_by_year") == [
        (2022, "Cairns", 2),
        (2022, "Perth", 2),
    ]
    # The tables equal those of a whole rebuild.
    names = list(plans.SERVING_MODELS)
    before = {n: rows(plans.read_model(spark, root, n), "*") for n in names}
    plans.build_models(spark, root, grain=grain)
    assert {n: rows(plans.read_model(spark, root, n), "*") for n in names} == before

    ledger = sources.read_table(spark, f"{root}/pipeline_logs")
    assert ledger.count() == 4
    latest = sources.latest_status(ledger)
    assert rows(latest, "run_id", "run_status") == [(1, "Completed"), (2, "Completed")]

    known = plans.register_views(spark, root)
    assert {"raw_cities", "raw_historic", "pipeline_logs", *names} <= set(known)
    hottest = spark.sql(
        """select h.`day.maxtemp_c`, a.picnics from raw_historic h
        join serving_activities a on h.City_Name = a.city and to_date(h.date) = a.date
        where h.city_name in (select city from raw_cities) order by 1 desc limit 1"""
    )
    assert hottest.first() == (99.0, "no")

    # Nothing new: no rows, no mark, the same tables.
    written = plans.refresh(
        spark,
        root,
        as_of="2022-10-02",
        cities=cities,
        historic=arguments["historic"],
        days_back=30,
        grain=grain,
    )
    assert written == {"raw_cities": 2, "raw_historic": 0}
    assert sources.read_marks(spark, f"{root}/historic_logs").count() == 2


def test_month_that_ran_empty(spark, folder):
    """A forecast month without rows in the next load disappears from all tables."""
    root = f"{folder}/root"
    history = f"{folder}/history"
    land(spark, history, document("Perth", "2022-09-30", 20.0))
    for i, day in enumerate(("2022-11-01", "2022-10-02")):
        forecast = f"{folder}/forecast{i}"
        land(spark, forecast, document("Perth", day, 20.0))
        plans.load(
            spark,
            root,
            as_of="2022-10-01",
            historic=sources.read_weather(spark, history),
            forecast=sources.read_weather(spark, forecast),
        )
    for name, column in (
        ("staging_historic_and_forecast", "date"),
        ("serving_rank_city_metrics_by_day", "day"),
    ):
        assert rows(plans.read_model(spark, root, name), column) == [
            ("2022-09-30",),
            ("2022-10-02",),
        ]


@pytest.mark.parametrize("grain", [sources.MONTH, sources.DAY], ids=["months", "days"])
def test_moved_forecast_leaves_other_periods(spark, folder, grain):
    """A forecast that moves on deletes its former periods and writes no untouched one."""
    root, history = f"{folder}/root", f"{folder}/history"
    land(spark, history, document("Perth", "2022-08-30", 20.0), document("Perth", "2022-08-31", 21.0))
    forecasts = [f"{folder}/forecast{i}" for i in range(3)]
    land(spark, forecasts[0], document("Perth", "2022-09-30", 20.0), document("Perth", "2022-10-01", 20.0))
    land(spark, forecasts[1], document("Perth", "2022-10-01", 23.0), document("Perth", "2022-10-02", 20.0))
    land(spark, forecasts[2], {"City_Name": "Perth", "forecast": {"forecastday": []}})
    plans.load(
        spark,
        root,
        as_of="2022-09-01",
        historic=sources.read_weather(spark, history),
        forecast=sources.read_weather(spark, forecasts[0]),
        grain=grain,
    )
    names = ["staging_historic_and_forecast", *plans.SERVING_MODELS]
    untouched = [f for n in names for f in Path(root, n).glob("*=2022*08*/*.parquet")]
    assert untouched
    for forecast, days in ((forecasts[1], ["2022-10-01", "2022-10-02"]), (forecasts[2], [])):
        plans.load(
            spark,
            root,
            as_of="2022-09-01",
            forecast=sources.read_weather(spark, forecast),
            grain=grain,
        )
        unified = plans.read_model(spark, root, names[0])
        assert rows(unified, "date") == [(d,) for d in ["2022-08-30", "2022-08-31", *days]]
        assert all(f.exists() for f in untouched)
        stepwise = {n: rows(plans.read_model(spark, root, n), "*") for n in names}
        again = f"{folder}/again-{len(days)}"
        plans.load(
            spark,
            again,
            as_of="2022-09-01",
            historic=sources.read_weather(spark, history),
            forecast=sources.read_weather(spark, forecast),
            grain=grain,
        )
        assert {n: rows(plans.read_model(spark, again, n), "*") for n in names} == stepwise


def test_one_model_over_another_source(spark, folder):
    root, history, forecast = (f"{folder}/{p}" for p in ("root", "history", "forecast"))
    land(spark, history, document("Perth", "2022-09-30", 20.0, "Fog"))
    days = [document("Perth", "2022-10-01", 20.0), document("Perth", "2022-10-02", 20.0, "fog")]
    land(spark, forecast, *days)
    plans.load(
        spark,
        root,
        as_of="2022-10-01",
        historic=sources.read_weather(spark, history),
        forecast=sources.read_weather(spark, forecast),
    )
    ahead = plans.read_model(spark, root, "staging_historic_and_forecast").where(
        "from_table = 'forecast'"
    )
    assert plans.build_model(spark, root, "serving_activities", ahead) == 2
    flags = plans.read_model(spark, root, "serving_activities")
    assert rows(flags, "weather_condition", "indoor_activity") == [("Sunny", "no"), ("fog", "yes")]
    assert plans.build_model(spark, root, "serving_rank_city_metrics_by_day", ahead) == 2
    with pytest.raises(ValueError, match="serving_mood"):
        plans.build_model(spark, root, "serving_mood", ahead)


@pytest.mark.parametrize("grain", [sources.MONTH, sources.DAY], ids=["months", "days"])
def test_without_forecast(spark, folder, grain):
    """Neither a load without a forecast nor an empty forecast breaks a table."""
    root, history, empty = (f"{folder}/{p}" for p in ("root", "history", "empty"))
    land(spark, history, document("Perth", "2022-09-30", 20.0))
    land(spark, empty, {"City_Name": "Perth", "forecast": {"forecastday": []}})
    arguments = {
        "as_of": "2022-10-01",
        "historic": sources.read_weather(spark, history),
        "grain": grain,
    }
    plans.load(spark, root, **arguments)
    assert "staging_forecast" in plans.register_views(spark, root)
    assert spark.table("staging_forecast").count() == 0
    assert len(spark.table("staging_forecast").columns) == 16
    written = plans.load(
        spark, root, forecast=sources.read_weather(spark, empty), **arguments
    )
    assert written["raw_forecast"] == 0
    plans.build_models(spark, root, grain=grain)
    assert plans.read_model(spark, root, "serving_activities").count() == 1


def test_failed_run(spark, folder):
    root = f"{folder}/root"
    history = f"{folder}/history"
    bad = document("Perth", "2022-09-30", 20.0)
    bad["forecast"]["forecastday"][0]["astro"]["moon_illumination"] = "much"
    land(spark, history, bad)
    with pytest.raises(Exception, match="much"):
        plans.refresh(
            spark,
            root,
            as_of="2022-10-01",
            historic=sources.read_weather(spark, history),
        )
    ledger = sources.read_table(spark, f"{root}/pipeline_logs")
    assert rows(sources.latest_status(ledger), "run_status") == [("Error",)]
    assert "much" in ledger.where("run_status = 'Error'").first()["run_log"]
    # The mark has not moved, so the days are loaded again.
    assert sources.last_mark(spark, f"{root}/historic_logs") is None


def test_stream(spark, folder):
    root, landed, state = (f"{folder}/{p}" for p in ("root", "landed", "state"))

    def drain():
        stream = sources.stream_weather(spark, landed, max_files_per_trigger=1)
        start_weather_upsert(stream, root, state, serve=True).awaitTermination()

    land(spark, landed, document("Perth", "2022-09-30", 20.0), document("Perth", "2022-10-01", 21.0))
    drain()
    land(spark, landed, document("Perth", "2022-09-30", 25.0, "Mist"))
    land(spark, landed, document("Cairns", "2022-09-30", 31.0))
    drain()
    raw = sources.read_table(spark, f"{root}/raw_historic")
    assert rows(raw, "City_Name", "date", "`day.maxtemp_c`") == [
        ("Cairns", "2022-09-30", 31.0),
        ("Perth", "2022-09-30", 25.0),
        ("Perth", "2022-10-01", 21.0),
    ]
    counts = plans.read_model(spark, root, "serving_weather_condition_count_by_month")
    assert rows(counts, "year_month", "city", "sunny_day_count_by_month") == [
        ("2022-09", "Cairns", 1),
        ("2022-09", "Perth", 0),
        ("2022-10", "Perth", 1),
    ]
    drain()  # nothing new has arrived
    assert raw.count() == 3


ERROR = {"City_Name": "Perth", "error": {"code": 9999}}


def test_rejected_document_keeps_its_own_days_open(spark, folder):
    """Four loads: the mark moves on, the document is put aside once, its day is filled later."""
    root, history = f"{folder}/root", f"{folder}/history"
    land(spark, history, document("Perth", "2022-10-01", 20.0), ERROR, document("Perth", "2022-10-03", 22.0))
    names = spark.createDataFrame([("Perth",), ("Hobart",)], "City_Name string")

    def loaded(as_of, **options):
        documents = sources.read_weather(spark, history)
        return plans.load(spark, root, as_of=as_of, days_back=3, historic=documents, **options)

    def still_open(as_of):
        found = plans.open_days(spark, root, names, as_of=as_of, days_back=3)
        return sorted((r[0], str(r[1]), str(r[2])) for r in found.collect())

    with pytest.raises(Exception, match="document without days"):
        loaded("2022-10-04")  # fails once, with the document put aside
    written = loaded("2022-10-04")
    assert written["raw_historic"] == 2 and "raw_rejected" not in written
    assert sources.last_mark(spark, f"{root}/historic_logs") == "2022-10-03"
    assert still_open("2022-10-04") == [("Hobart", "2022-10-01", "2022-10-03"), ("Perth", "2022-10-02", "2022-10-02")]
    assert loaded("2022-10-04")["raw_historic"] == 0
    land(spark, history, document("Perth", "2022-10-02", 21.0), document("Perth", "2022-10-04", 23.0))
    assert loaded("2022-10-05", set_aside=True)["raw_historic"] == 2
    assert still_open("2022-10-05") == [("Hobart", "2022-10-02", "2022-10-04")]
    raw = sources.read_table(spark, f"{root}/raw_historic")
    assert rows(raw, "date") == [(f"2022-10-0{k}",) for k in (1, 2, 3, 4)]
    aside = sources.read_table(spark, f"{root}/raw_rejected")
    assert rows(aside, "origin") == [("historic",)] and "Perth" in aside.first()["document"]
    unified = plans.read_model(spark, root, "staging_historic_and_forecast")
    assert unified.count() == 4


def test_corrections_of_loaded_days_are_left_to_the_stream(spark, folder):
    root, history = f"{folder}/root", f"{folder}/history"
    land(spark, history, document("Perth", "2022-10-01", 20.0))
    plans.load(spark, root, as_of="2022-10-04", historic=sources.read_weather(spark, history))
    land(spark, history, document("Perth", "2022-10-01", 30.0))
    written = plans.load(spark, root, as_of="2022-10-04", historic=sources.read_weather(spark, history))
    assert written == {"raw_historic": 0}


def test_landing_opens_new_files_only(spark, folder):
    """Late files too; a file with days to come is read again, a broken old one is not."""
    root, history = f"{folder}/root", f"{folder}/a history"
    landing = sources.Landing(history)
    ledger = f"{root}/loaded_files"

    def loaded(as_of, source=landing):
        return plans.load(spark, root, as_of=as_of, historic=source, set_aside=True)

    def names(df):
        return {Path(r["path"]).name for r in df.select("path").collect()}

    land(spark, history, document("Perth", "2022-10-01", 20.0))
    land(spark, history, document("Perth", "2022-10-02", 20.0), document("Perth", "2022-10-05", 25.0))
    assert loaded("2022-10-03")["raw_historic"] == 2
    once = names(sources.read_table(spark, ledger))
    assert len(once) == 1  # the other file has a day to come
    old = next(f for f in Path(history).iterdir() if f.name in once)
    text, stat = old.read_text(), old.stat()
    old.write_text("{" * len(text))  # as it is never opened again, nobody notices
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    Path(history, f".{old.name}.crc").unlink(missing_ok=True)
    new = sources.unread(spark, landing, ledger)
    assert not names(new.files) & once
    assert not {Path(f).name for f in new.documents.inputFiles()} & once
    land(spark, history, document("Perth", "2022-09-30", 19.0))  # late
    assert loaded("2022-10-06")["raw_historic"] == 2
    raw = sources.read_table(spark, f"{root}/raw_historic")
    assert rows(raw, "date") == [("2022-09-30",), ("2022-10-01",), ("2022-10-02",), ("2022-10-05",)]
    assert sources.unread(spark, landing, ledger).documents is None
    assert loaded("2022-10-06") == {}
    recent = sources.Landing(history, lateness=dt.timedelta(days=1))
    land(spark, history, document("Perth", "2022-10-06", 19.0))
    assert sources.unread(spark, recent, ledger).files.count() == 1
    assert loaded("2022-10-07", recent)["raw_historic"] == 1
    assert sources.read_table(spark, ledger).count() == 4


def test_more_new_files_than_are_listed(spark, folder, monkeypatch):
    history, ledger = f"{folder}/history", f"{folder}/ledger"
    land(spark, history, document("Perth", "2022-10-01", 20.0))
    landing = sources.Landing(history)
    sources.mark_read(sources.unread(spark, landing, ledger).files, ledger)
    for day in ("2022-10-02", "2022-10-03"):
        land(spark, history, document("Perth", day, 20.0))
    monkeypatch.setattr("obs_engine.sources.landing.MAX_FILES", 1)
    found = sources.unread(spark, landing, ledger).documents
    days = found.selectExpr("forecast.forecastday[0].date as date")
    assert rows(days, "date") == [("2022-10-02",), ("2022-10-03",)]


@pytest.mark.parametrize("grain", [sources.MONTH, sources.DAY], ids=["months", "days"])
def test_stop_before_the_models(spark, folder, monkeypatch, grain):
    """The next load rebuilds what the stopped one had touched."""
    history = f"{folder}/history"
    land(spark, history, document("Perth", "2022-09-30", 20.0))
    forecasts = []
    for number, days in enumerate((["2022-10-30", "2022-10-31"], ["2022-11-01"], ["2022-12-02"])):
        forecasts.append(f"{folder}/forecast{number}")
        land(spark, forecasts[-1], *[document("Perth", d, 20.0) for d in days])

    def loaded(root, number):
        plans.load(
            spark,
            root,
            as_of="2022-10-01",
            historic=sources.read_weather(spark, history),
            forecast=sources.read_weather(spark, forecasts[number]),
            grain=grain,
        )

    stopped, whole = f"{folder}/stopped", f"{folder}/whole"
    for root in (stopped, whole):
        loaded(root, 0)
    land(spark, history, document("Cairns", "2022-08-30", 31.0))
    with monkeypatch.context() as patched:
        patched.setattr("obs_engine.plans.loading.build_models", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loaded(stopped, 1)
    loaded(stopped, 2)
    loaded(whole, 2)
    names = ["staging_historic", "staging_forecast", "staging_historic_and_forecast", *plans.SERVING_MODELS]
    tables = [{n: rows(plans.read_model(spark, r, n), "*") for n in names} for r in (stopped, whole)]
    assert tables[0] == tables[1]
    assert sources.journal.pending(spark, stopped).notes == ()


def test_fields_the_models_do_not_use(spark, folder):
    root, history = f"{folder}/root", f"{folder}/history"
    land(spark, history, document("Perth", "2022-10-01", 20.0))
    plans.load(spark, root, as_of="2022-10-02", historic=sources.read_weather(spark, history))
    more = document("Perth", "2022-10-02", 21.0)
    more["forecast"]["forecastday"][0]["day"]["feelslike_c"] = 18.5
    more["location"] = {"country": "Australia"}
    land(spark, f"{folder}/more", more)
    landing = sources.Landing(f"{folder}/more", fields=sources.FOUND)
    with pytest.raises(ValueError, match="feelslike_c"):
        plans.load(spark, root, as_of="2022-10-03", historic=landing)
    plans.load(spark, root, as_of="2022-10-03", historic=landing, evolve=True)
    raw = sources.read_table(spark, f"{root}/raw_historic")
    assert rows(raw, "date", "`day.feelslike_c`", "`location.country`") == [
        ("2022-10-01", None, None),
        ("2022-10-02", 18.5, "Australia"),
    ]
    assert plans.read_model(spark, root, "staging_historic").count() == 2


def test_cities_of_a_country(spark, folder):
    counts = [("Perth", "Australia", "9"), ("Perth", "Scotland", "8"), ("Hobart", "Australia", "7")]
    land(
        spark,
        f"{folder}/cities",
        {
            "data": [
                {
                    "city": city,
                    "country": country,
                    "populationCounts": [{"year": "2021", "value": value}],
                }
                for city, country, value in counts
            ]
        },
    )
    cities = sources.read_population(spark, f"{folder}/cities")
    plans.load(spark, f"{folder}/a", cities=cities, country="Australia", n=2)
    plans.load(spark, f"{folder}/b", cities=cities, prefetch=2)
    found = [rows(sources.read_table(spark, f"{folder}/{r}/raw_cities"), "city", "country") for r in "ab"]
    assert found == [
        [("Hobart", "Australia"), ("Perth", "Australia")],
        [("Perth", "Australia"), ("Perth", "Scotland")],
    ]


def test_load_up_to_the_current_date(spark, folder):
    """Without ``as_of`` yesterday is the last day of history."""
    root, history = f"{folder}/root", f"{folder}/history"
    today = dt.date.today()
    days = [str(today - dt.timedelta(days=k)) for k in (2, 1, 0)]
    land(spark, history, *[document("Perth", d, 20.0) for d in days])
    written = plans.load(spark, root, historic=sources.read_weather(spark, history), days_back=5)
    loaded = rows(sources.read_table(spark, f"{root}/raw_historic"), "date")
    if dt.date.today() == today:
        assert written["raw_historic"] == 2 and loaded == [(d,) for d in days[:2]]


@pytest.mark.parametrize("start", [start_weather_upsert, start_month_states])
def test_stream_puts_documents_aside(spark, folder, start):
    root, landed, state = (f"{folder}/{p}" for p in ("root", "landed", "state"))
    land(spark, landed, document("Perth", "2022-09-30", 20.0), ERROR)
    with pytest.raises(Exception, match="document without days"):
        start(sources.stream_weather(spark, landed), root, state).awaitTermination()
    for _ in range(2):
        start(sources.stream_weather(spark, landed), root, state, set_aside=True).awaitTermination()
    assert sources.read_table(spark, f"{root}/raw_historic").count() == 1
    assert rows(sources.read_table(spark, f"{root}/raw_rejected"), "origin") == [("stream",)]


@pytest.mark.parametrize("where", ["before the table", "before the states", "after the states"])
def test_changes_of_a_stopped_batch_count_once(spark, folder, monkeypatch, where):
    """A batch repeated after a stop is neither lost nor counted twice."""
    root = f"{folder}/root"

    def raw(*documents):
        path = f"{folder}/in-{len(documents)}-{documents[0]['forecast']['forecastday'][0]['date']}"
        land(spark, path, *documents)
        return ops.raw_weather(sources.read_weather(spark, path))

    first = raw(document("Perth", "2022-09-29", 20.0), document("Perth", "2022-09-30", 21.0), document("Perth", "2022-10-01", 21.0, "Mist"))
    second = raw(document("Perth", "2022-09-30", 25.0, "Mist"), document("Cairns", "2022-09-30", 31.0))
    apply_batch(spark, root, first, "s-0")
    patches = {
        "before the table": ("obs_engine.sources.tables.publish", lambda *a, **k: 1 / 0),
        "before the states": ("obs_engine.streaming.changes.fold_states", lambda *a, **k: 1 / 0),
        "after the states": ("obs_engine.streaming.changes.delete", lambda *a, **k: 1 / 0),
    }
    with monkeypatch.context() as patched:
        patched.setattr(*patches[where])
        with pytest.raises(ZeroDivisionError):
            apply_batch(spark, root, second, "s-1")
    for _ in range(2):
        apply_batch(spark, root, second, "s-1")
    states = sources.read_table(spark, f"{root}/state_months")
    assert rows(ops.counts_of_states(states), "year_month", "city", "sunny_day_count_by_month") == [
        ("2022-09", "Cairns", 1),
        ("2022-09", "Perth", 1),
        ("2022-10", "Perth", 0),
    ]
    means = ops.metrics_of_states(states).where("city = 'Perth'")
    assert rows(means, "year_month", "avg_max_temp_celcuis_by_month") == [("2022-09", Decimal("22.50")), ("2022-10", Decimal("21.00"))]
    staged = plans.stage(sources.read_table(spark, f"{root}/raw_historic"))
    assert rows(ops.month_states(staged), "*") == rows(states.select(ops.month_states(staged).columns), "*")


def test_states_of_days_taken_back_are_gone(spark, folder):
    schema = "date string, city string, weather_condition string, sign int, max_temp_celcius double, min_temp_celcius double, max_wind_kph double, total_rain_mm double"
    days = [("2022-09-30", "Perth", None, 1, 1.5, None, 2.0, 0.1), ("2022-10-01", "Perth", "Fog", 1, 0.1, 0.2, None, None)]
    add = spark.createDataFrame(days, schema)
    back = spark.createDataFrame([(*d[:3], -1, *d[4:]) for d in days], schema)
    path = f"{folder}/states"
    fold_states(spark, path, ops.month_states(add, "sign"))
    found = ops.metrics_of_states(sources.read_table(spark, path))
    assert rows(found.where("year_month = '2022-10'"), "avg_max_wind_kph_by_month", "total_rain_mm_by_month") == [(None, None)]
    fold_states(spark, path, ops.month_states(back.limit(1), "sign"))
    assert rows(sources.read_table(spark, path), "year_month", "days") == [("2022-10", 1)]
    fold_states(spark, path, ops.month_states(back.where("date = '2022-10-01'"), "sign"))
    assert sources.read_table(spark, path).count() == 0
