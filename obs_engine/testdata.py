"""Daily observations derived from the order tables, to run the models on.

One row per (ship date, nation of the supplier) with the columns of the unified
staging table. The rows are shaped back into weather and population documents for the
operators that start from documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.functions import quoted
from obs_engine.plans.staging import STAGED_COLUMNS

# Condition text by part key modulo 18 (17 has none).
CONDITIONS = [
    "Sunny",
    " sunny ",
    "Partly cloudy",
    "Overcast",
    "Cloudy",
    "Light drizzle",
    "Patchy rain possible",
    "Moderate or heavy rain shower",
    "Heavy rain",
    "Patchy light rain with thunder",
    "Thundery outbreaks possible",
    "Mist",
    "SUNNY",
    "Light rain",
    "Light rain shower",
    "Moderate rain",
    "Fog",
]
FORECAST_FROM = "2001-06-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations. Ship dates combine per (day, nation) before the shuffle."""
    shipped = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    days = (
        shipped.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("day", "n_name")
        .agg(
            F.max("l_quantity").alias("max_quantity"),
            F.min("l_quantity").alias("min_quantity"),
            F.max("l_discount").alias("max_discount"),
            F.sum(F.col("l_tax").cast("decimal(18,4)")).alias("tax"),
            F.max("l_linenumber").alias("max_line"),
            F.min("l_linenumber").alias("min_line"),
            F.min(F.col("l_partkey") % 18).alias("part"),
        )
    )
    dom = F.dayofmonth("day")
    wind = F.round(F.col("max_discount") * 100).cast("int")
    minutes = F.lpad(dom.cast("string"), 2, "0")
    return days.select(
        F.when(F.col("day") < F.lit(FORECAST_FROM).cast("date"), "historic")
        .otherwise("forecast")
        .alias("from_table"),
        F.col("day").cast("string").alias("date"),
        F.col("n_name").alias("city"),
        F.col("max_quantity").alias("max_temp_celcius"),
        F.col("min_quantity").alias("min_temp_celcius"),
        (F.nullif(wind, F.lit(0)) * 3).cast("double").alias("max_wind_kph"),
        F.col("tax").cast("double").alias("total_rain_mm"),
        (F.col("max_line") * 10).cast("double").alias("average_humity"),
        F.get(F.array(*map(F.lit, CONDITIONS)), F.col("part").cast("int")).alias(
            "weather_condition"
        ),
        F.when(dom % 8 == 0, "Full Moon").otherwise("Waning Crescent").alias("moon_phase"),
        (dom * 3).cast("string").alias("moon_illumination"),
        F.concat(F.lit("0"), (5 + dom % 2).cast("string"), F.lit(":"), minutes, F.lit(" AM")).alias(
            "sunrise"
        ),
        F.concat(F.lit("0"), (5 + dom % 3).cast("string"), F.lit(":"), minutes, F.lit(" PM")).alias(
            "sunset"
        ),
        F.col("max_line").cast("double").alias("average_visibility_km"),
        F.col("min_line").cast("double").alias("uv_rating"),
        F.lit("07:40 PM").alias("moonrise"),
        F.lit("06:10 AM").alias("moonset"),
    )


def historic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).where(F.col("from_table") == "historic")


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).where(F.col("from_table") == "forecast")


def raw(observations: DataFrame) -> DataFrame:
    """Observations with the column names of a raw weather table."""
    return observations.select(
        *[
            F.col(staged.removeprefix("astro.")).alias(name)
            for name, staged in STAGED_COLUMNS.items()
        ]
    )


def _day_struct(raw_rows: DataFrame):
    def nested(prefix: str):
        names = [c for c in raw_rows.columns if c.startswith(prefix) and c != "day.condition.text"]
        fields = [F.col(quoted(c)).alias(c.removeprefix(prefix)) for c in names]
        if prefix == "day.":
            text = F.col(quoted("day.condition.text")).alias("text")
            fields.insert(-1, F.struct(text).alias("condition"))
        return F.struct(*fields)

    return F.struct(
        "date", nested("day.").alias("day"), nested("astro.").alias("astro")
    )


def daily_documents(observations: DataFrame) -> DataFrame:
    """One document per (city, day), as history is requested."""
    rows = raw(observations)
    return rows.select(
        "City_Name", F.struct(F.array(_day_struct(rows)).alias("forecastday")).alias("forecast")
    )


def weekly_documents(observations: DataFrame) -> DataFrame:
    """One document per city and calendar week with its days, as a forecast comes.

    (city, day) is unique in the observations, so a document has at most seven days.
    """
    rows = raw(observations)
    week = F.date_trunc("week", F.to_date("date"))
    return (
        rows.groupBy("City_Name", week.alias("week"))
        .agg(F.sort_array(F.collect_list(_day_struct(rows))).alias("forecastday"))
        .select("City_Name", F.struct("forecastday").alias("forecast"))
    )


def population_records(spark: SparkSession, sf_dir: str, plain: bool = False) -> DataFrame:
    """Order totals by nation and year in the role of populations, with country.

    One name in three gets a space and one a hyphen, for the name filter, unless
    ``plain``.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joint = F.when(F.col("n_nationkey") % 3 == 0, " ").when(F.col("n_nationkey") % 3 == 1, "-")
    marked = F.replace(F.col("n_name"), F.lit("_"), F.coalesce(joint, F.lit("")))
    city = F.col("n_name") if plain else marked
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(
            city.alias("city"),
            F.col("r_name").alias("country"),
            F.year("o_orderdate").cast("string").alias("year"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias("value"))
    )


def population_documents(records: DataFrame) -> DataFrame:
    """One document per country; nations times years bound the arrays."""
    cities = records.groupBy("country", "city").agg(
        F.sort_array(F.collect_list(F.struct("year", "value"))).alias("populationCounts")
    )
    return cities.groupBy("country").agg(
        F.sort_array(F.collect_list(F.struct("city", "country", "populationCounts"))).alias("data")
    ).select("data")
