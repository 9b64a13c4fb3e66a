"""Marks, windows, work lists and the ledger."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obs_engine import operators as ops
from obs_engine import sources

TODAY = "2022-10-10"


def days(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "date string")


def test_window_bounds():
    assert ops.window_bounds(None, TODAY, 3) == (dt.date(2022, 10, 7), dt.date(2022, 10, 10))
    assert ops.window_bounds("2022-10-05", TODAY, 3)[0] == dt.date(2022, 10, 6)


def test_extraction_window(spark):
    rows = days(spark, *[f"2022-10-{d:02d}" for d in range(1, 15)])

    def window(mark, df=rows, days_back=3):
        found = ops.extraction_window(df, "date", mark=mark, as_of=TODAY, days_back=days_back)
        return sorted(str(r["date"]) for r in found.collect())

    assert window(None) == ["2022-10-07", "2022-10-08", "2022-10-09"]
    assert window("2022-10-08") == ["2022-10-09"]
    assert window("2022-10-09") == []  # up to date
    assert window("2022-10-20") == []
    typed = rows.select(F.to_date("date").alias("date"))
    assert window(None, typed) == ["2022-10-07", "2022-10-08", "2022-10-09"]


def test_high_water_mark(spark):
    assert ops.high_water_mark(days(spark, "2022-09-30", "2022-10-01"), "date").first()[0] == (
        "2022-10-01"
    )
    assert ops.high_water_mark(days(spark), "date").first()[0] is None


def test_work_list(spark):
    cities = spark.createDataFrame([("a",), ("b",)], "city string")
    grid = ops.work_list(cities, "2022-10-08", TODAY)
    assert sorted((r["city"], str(r["date"])) for r in grid.collect()) == [
        (c, d) for c in "ab" for d in ("2022-10-08", "2022-10-09")
    ]
    assert ops.work_list(cities, TODAY, TODAY).count() == 0
    assert ops.work_list(cities, "2022-10-11", TODAY).count() == 0
    loaded = spark.createDataFrame(
        [("a", dt.date(2022, 10, 8)), ("a", dt.date(2022, 10, 8))], "city string, date date"
    )
    left = ops.missing_keys(grid, loaded, ["city", "date"])
    assert left.count() == 3


def test_mark_log(spark, folder):
    path = f"{folder}/marks"
    assert sources.last_mark(spark, path) is None
    assert sources.advance_mark(spark, path, days(spark), "date", TODAY) is None
    assert sources.last_mark(spark, path) is None
    loaded = days(spark, "2022-10-08", "2022-10-09")
    assert sources.advance_mark(spark, path, loaded, "date", TODAY) == "2022-10-09"
    sources.advance_mark(spark, path, days(spark, "2022-10-01"), "date", "2022-10-11")
    assert sources.last_mark(spark, path) == "2022-10-09"
    log = sorted(map(tuple, sources.read_marks(spark, path).collect()))
    assert log == [("2022-10-10", "2022-10-09"), ("2022-10-11", "2022-10-01")]


def test_ledger(spark, folder):
    path = f"{folder}/runs"
    assert sources.new_run_id(spark, path) == 1
    config = {"days_back": 3, "as_of": dt.date(2022, 10, 10)}
    for run_id, states in ((1, ["Started", "Error"]), (2, ["Started"])):
        assert sources.new_run_id(spark, path) == run_id
        for i, state in enumerate(states):
            at = dt.datetime(2022, 10, 10, 5, run_id, i)
            sources.append_run(spark, path, run_id, state, config, timestamp=at)
    ledger = sources.read_table(spark, path)
    assert ledger.columns == ["run_timestamp", "run_id", "run_status", "run_config", "run_log"]
    assert json.loads(ledger.first()["run_config"]) == {"as_of": "2022-10-10", "days_back": 3}
    latest = {r["run_id"]: r["run_status"] for r in sources.latest_status(ledger).collect()}
    assert latest == {1: "Error", 2: "Started"}
    assert sources.next_run_id(ledger.limit(0)).first()["run_id"] == 1


DAYS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 12)), max_size=14)


def intervals(spark, parts):
    first = dt.date(2022, 1, 1)
    rows = [(k, first + dt.timedelta(a), first + dt.timedelta(b)) for k, a, b in parts]
    return spark.createDataFrame(rows, "k string, first_day date, last_day date")


def covered(df):
    """Days by entity, each once, or the intervals overlap."""
    first = dt.date(2022, 1, 1)
    days = [(r["k"], (r["first_day"] - first).days + d) for r in df.collect() for d in range((r["last_day"] - r["first_day"]).days + 1)]
    assert len(days) == len(set(days))
    return set(days)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loaded=DAYS, wanted=st.dictionaries(st.sampled_from("abc"), st.tuples(st.integers(0, 6), st.integers(0, 8)), max_size=3))
def test_intervals_like_sets_of_days(spark, loaded, wanted):
    first = dt.date(2022, 1, 1)
    rows = spark.createDataFrame([(k, str(first + dt.timedelta(d))) for k, d in loaded], "k string, day string")
    islands = ops.days_to_intervals(rows, ["k"], "day")
    assert covered(islands) == set(loaded)
    doubled = ops.merge_intervals(islands.unionByName(intervals(spark, [(k, d, d) for k, d in loaded])), ["k"])
    assert sorted(map(tuple, doubled.collect())) == sorted(map(tuple, islands.collect()))
    parts = [(k, a, a + n) for k, (a, n) in wanted.items()]
    left = ops.subtract_intervals(intervals(spark, parts), islands, ["k"])
    asked = {(k, d) for k, a, b in parts for d in range(a, b + 1)}
    assert covered(left) == asked - set(loaded)
    assert ops.count_days(left).first()["days"] == len(asked - set(loaded))
    days = spark.createDataFrame([(k, str(first + dt.timedelta(d))) for k, d in asked], "k string, day string")
    outside = ops.outside_intervals(days, islands, ["k"], "day")
    assert outside.count() == len(asked - set(loaded))
