"""Ranks against brute force, through both plans."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obs_engine.operators import rank_metrics, rank_metrics_by_day, rank_metrics_by_month

SCHEMA = "g string, h int, id int, m double, t string"


def sort_key(value):
    """Descending order has NULL first, then NaN, then values."""
    if value is None:
        return (2, 0)
    if isinstance(value, float) and math.isnan(value):
        return (1, 0)
    return (0, value)


def brute_force(rows, column):
    ranks = {}
    for row in rows:
        group = [r[column] for r in rows if r[:2] == row[:2]]
        ranks[row[2]] = 1 + sum(sort_key(v) > sort_key(row[column]) for v in group)
    return ranks


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    ranked = rank_metrics(df, ["g", "h"], {"m": "rank_m", "t": "rank_t"}, **options)
    assert ranked.columns == [*df.columns, "rank_m", "rank_t"]
    got = ranked.collect()
    assert len(got) == len(rows)
    assert {r["id"]: r["rank_m"] for r in got} == brute_force(rows, 3)
    assert {r["id"]: r["rank_t"] for r in got} == brute_force(rows, 4)


def skewed_rows(n, seed):
    """One group with most rows, one value with a third of them, NULLs and NaN."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        group = pick.choice(["hot", "hot", "hot", "hot", "a", "b", None])
        h = 1 if group == "hot" else pick.choice([1, 2, None])
        value = pick.choice([7.0, 7.0, None, float("nan"), 0.0, -0.0] + [pick.random() * 100] * 6)
        rows.append((group, h, i, value, pick.choice("abcdefgh") * pick.randint(1, 3)))
    return rows


@pytest.mark.parametrize("group_rows", [1, 3, 20, 150, 10_000])
def test_skewed_groups(spark, group_rows):
    check(spark, skewed_rows(400, group_rows), group_rows=group_rows, max_pieces=10_000)


def test_more_splitters_than_a_chunk(spark):
    rows = [("hot", 1, i, float((i * 7919) % 1500), "x") for i in range(1500)]
    check(spark, rows, group_rows=4, max_pieces=10_000)


def test_cut_follows_the_total(spark):
    """With few pieces allowed only large shares of all rows are cut up."""
    check(spark, skewed_rows(300, 3), group_rows=1, max_pieces=4)


def test_rows_are_not_read_again_where_all_groups_are_hot(spark, folder):
    rows = [("a" if i % 2 else "b", float(i % 7)) for i in range(40)]
    spark.createDataFrame(rows, "g string, m double").write.parquet(f"{folder}/input-rows")
    df = spark.read.parquet(f"{folder}/input-rows")
    ranked = rank_metrics(df, ["g"], {"m": "r"}, group_rows=4)
    assert ranked.count() == 40 and not [f for f in ranked.inputFiles() if "input-rows" in f]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rank_metrics(df, ["g"], {"m": "r"}).collect() == []


def test_null_first_gaps_after_ties(spark):
    df = spark.createDataFrame(
        [("2022-10-01", c, v) for c, v in [("a", 5.0), ("b", None), ("c", 7.0)]]
        + [("2022-10-02", c, v) for c, v in [("a", 7.0), ("b", 7.0), ("c", 5.0)]],
        "date string, city string, max_temp_celcius double",
    )
    wide = df.select(
        "*",
        *[
            F.col("max_temp_celcius").alias(c)
            for c in ("min_temp_celcius", "max_wind_kph", "total_rain_mm")
        ],
    )
    ranked = rank_metrics_by_day(wide)
    got = {(r["day"], r["city"]): r["rank_of_city_max_temp_by_day"] for r in ranked.collect()}
    assert [got["2022-10-01", c] for c in "abc"] == [3, 1, 2]
    assert [got["2022-10-02", c] for c in "abc"] == [1, 1, 3]
    assert dict(ranked.dtypes)["rank_of_city_max_temp_by_day"] == "bigint"
    assert dict(ranked.dtypes)["day"] == "string"

    monthly = rank_metrics_by_month(wide)
    assert monthly.columns == [
        "year_month",
        "city",
        "avg_max_temp_celcuis_by_month",
        "rank_of_city_avg_max_temp_by_month",
        "avg_min_temp_celcuis_by_month",
        "rank_of_city_avg_min_temp_by_month",
        "avg_max_wind_kph_by_month",
        "rank_of_city_avg_max_wind_kph_by_month",
        "total_rain_mm_by_month",
        "rank_of_city_total_rain_mm_by_month",
    ]
    by_city = {r["city"]: r for r in monthly.collect()}
    assert by_city["b"]["rank_of_city_avg_max_temp_by_month"] == 1  # 7.00, the NULL left out
    rain = [by_city[c]["rank_of_city_total_rain_mm_by_month"] for c in "abc"]
    assert rain == [1, 3, 1]  # 12, 7 and 12


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    values=st.lists(
        st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e6, 1e6, width=32)),
        min_size=1,
        max_size=60,
    ),
    group_rows=st.integers(1, 20),
)
def test_any_values(spark, values, group_rows):
    rows = [("g", i % 2, i, v, "x") for i, v in enumerate(values)]
    check(spark, rows, group_rows=group_rows, max_pieces=10_000)
