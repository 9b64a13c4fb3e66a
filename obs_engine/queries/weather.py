"""Shaping, staging and serving models over the observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine import operators as ops
from obs_engine import testdata
from obs_engine.functions import (
    clock_seconds,
    day_of,
    normalised,
    rounded,
    year_month,
    year_of,
)
from obs_engine.operators.conditions import THUNDER
from obs_engine.operators.ranking import GROUP_ROWS
from obs_engine.plans import serving, stage, unify
from obs_engine.queries.registry import decimals_as_double, over_obs, query

STAGED = """date, city, max_temp_celcius, min_temp_celcius, max_wind_kph, total_rain_mm,
  average_visibility_km, average_humity, weather_condition, uv_rating,
  sunrise, sunset, moonrise, moonset"""

# ---- documents to rows -------------------------------------------------------------

RAW_ROWS = over_obs(
    """select date, city as "City_Name", max_temp_celcius as day_maxtemp_c,
  min_temp_celcius as day_mintemp_c, max_wind_kph as day_maxwind_kph,
  total_rain_mm as day_totalprecip_mm, average_visibility_km as day_avgvis_km,
  average_humity as day_avghumidity, weather_condition as day_condition_text,
  uv_rating as day_uv, sunrise as astro_sunrise, sunset as astro_sunset,
  moonrise as astro_moonrise, moonset as astro_moonset, moon_phase as astro_moon_phase,
  moon_illumination as astro_moon_illumination
from obs"""
)


@query(RAW_ROWS)
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = testdata.daily_documents(testdata.obs(spark, sf_dir))
    days = ops.explode_records(documents, "forecast.forecastday", ["City_Name"])
    return ops.flatten_struct(days, sep="_")


@query(
    over_obs(
        """select city as "City_Name", date, max_temp_celcius as maxtemp_c,
  weather_condition as condition_text, moon_phase from obs"""
    )
)
def explode_forecast_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = testdata.weekly_documents(testdata.obs(spark, sf_dir))
    return ops.explode_records(documents, "forecast.forecastday", ["City_Name"]).select(
        "City_Name",
        "date",
        "day.maxtemp_c",
        F.col("day.condition.text").alias("condition_text"),
        "astro.moon_phase",
    )


# ---- staging -----------------------------------------------------------------------


def _undotted(staged: DataFrame) -> DataFrame:
    return staged.withColumnsRenamed(
        {
            "astro.moon_phase": "astro_moon_phase",
            "astro.moon_illumination": "astro_moon_illumination",
        }
    )


def _staging_sql(origin: str) -> str:
    return over_obs(
        f"""select {STAGED}, moon_phase as astro_moon_phase,
  moon_illumination as astro_moon_illumination
from obs where from_table = '{origin}'"""
    )


@query(_staging_sql("historic"))
def staging_historic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _undotted(stage(testdata.raw(testdata.historic(spark, sf_dir))))


@query(_staging_sql("forecast"))
def staging_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = testdata.weekly_documents(testdata.forecast(spark, sf_dir))
    return _undotted(stage(ops.raw_weather(documents)))


@query(over_obs(f"select from_table, {STAGED}, moon_phase, moon_illumination from obs"))
def union_all_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify(
        testdata.raw(testdata.historic(spark, sf_dir)),
        testdata.raw(testdata.forecast(spark, sf_dir)),
    )


@query(
    over_obs(
        """select date, city, case when from_table = 'historic' then sunrise end as sunrise,
  case when from_table = 'forecast' then sunset end as sunset from obs"""
    )
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.union_by_name(
        testdata.historic(spark, sf_dir).select("date", "city", "sunrise"),
        testdata.forecast(spark, sf_dir).select("sunset", "city", "date"),
    )


# ---- scalar functions --------------------------------------------------------------


@query(
    over_obs(
        "select date, city, trim(upper(weather_condition)) as condition from obs",
    )
)
def normalise_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.obs(spark, sf_dir).select(
        "date", "city", normalised("weather_condition").alias("condition")
    )


@query(
    over_obs(
        """select distinct cast(date as date) as day, strftime(cast(date as date), '%Y-%m') as year_month,
  cast(extract(year from cast(date as date)) as int) as year from obs"""
    )
)
def year_month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = testdata.obs(spark, sf_dir).select("date").distinct()
    return dates.select(
        day_of("date").alias("day"),
        year_month("date").alias("year_month"),
        year_of("date").alias("year"),
    )


@query(
    """select l_orderkey, l_linenumber, l_partkey,
  cast(round(cast(l_extendedprice / 8 as decimal(38,10)), 2) as double) as rounded from lineitem"""
)
def round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = testdata.table(spark, sf_dir, "lineitem")
    return decimals_as_double(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            rounded(F.col("l_extendedprice") / 8).alias("rounded"),
        )
    )


@query(
    over_obs(
        """select date, city, date_diff('second', strptime(sunrise, '%I:%M %p'),
  strptime(sunset, '%I:%M %p')) as day_duration_seconds from obs"""
    )
)
def day_duration_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.obs(spark, sf_dir).select(
        "date", "city", clock_seconds("sunset", "sunrise").alias("day_duration_seconds")
    )


@query(
    over_obs("select date, city from obs where trim(upper(weather_condition)) like '%THUNDER%'")
)
def thunder_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.obs(spark, sf_dir)
    return rows.where(normalised("weather_condition").contains(THUNDER)).select("date", "city")


# ---- activities --------------------------------------------------------------------

NON_SUNNY = """select distinct upper(weather_condition) as indoor_time from obs
  where not trim(upper(weather_condition)) = 'SUNNY'"""
MILD = "min_temp_celcius >= 10 and max_temp_celcius <= 30"
FLAG_SQL = {
    "werewolf": """case when trim(upper(moon_phase)) = 'FULL MOON'
  and trim(upper(weather_condition)) = 'SUNNY' then 'yes' else 'no' end""",
    "picnics": f"""case
  when trim(upper(weather_condition)) in ('SUNNY', 'PARTLY CLOUDY') and {MILD} then 'yes'
  when trim(upper(weather_condition)) in ('OVERCAST', 'CLOUDY') and {MILD} then 'maybe'
  else 'no' end""",
    "indoor_activity": """case when upper(weather_condition) in
  (select indoor_time from indoor) then 'yes' else 'no' end""",
    "sailing": "case when max_wind_kph between 9 and 23 then 'yes' else 'no' end",
    "happy": """case when max_temp_celcius <= 25 and average_humity between 30 and 60
  then 'yes' else 'no' end""",
    "moonbathing": "case when cast(moon_illumination as int) >= 80 then 'yes' else 'no' end",
}


def _activities_sql(where: str = "true") -> str:
    flags = ", ".join(f"{sql} as {flag}" for flag, sql in FLAG_SQL.items())
    return over_obs(
        f"""select cast(date as date) as date, city, weather_condition, {flags},
  date_diff('second', strptime(sunrise, '%I:%M %p'), strptime(sunset, '%I:%M %p'))
    as day_duration_seconds
from obs where {where}""",
        f"indoor as ({NON_SUNNY})",
    )


def _flag_sql(flag: str) -> str:
    return over_obs(
        f"select cast(date as date) as date, city, {FLAG_SQL[flag]} as {flag} from obs",
        f"indoor as ({NON_SUNNY})",
    )


def _with_seconds(activities: DataFrame) -> DataFrame:
    """Intervals have no common form in the check; whole seconds do."""
    seconds = (
        F.extract(F.lit("HOUR"), "day_duration") * 3600
        + F.extract(F.lit("MINUTE"), "day_duration") * 60
        + F.extract(F.lit("SECOND"), "day_duration").cast("long")
    ).cast("long")
    return activities.withColumn("day_duration_seconds", seconds).drop("day_duration")


@query(_activities_sql())
def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_seconds(ops.activity_flags(testdata.obs(spark, sf_dir)))


@query(_activities_sql("from_table = 'forecast'"))
def model_on_forecast_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model over another source still takes its indoor set from all rows."""
    return _with_seconds(
        ops.activity_flags(
            testdata.forecast(spark, sf_dir), indoor_source=testdata.obs(spark, sf_dir)
        )
    )


def _flag(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    return ops.activity_flags(testdata.obs(spark, sf_dir)).select("date", "city", flag)


@query(_flag_sql("werewolf"))
def act_werewolf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, "werewolf")


@query(_flag_sql("picnics"))
def act_picnics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, "picnics")


@query(_flag_sql("indoor_activity"))
def act_indoor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, "indoor_activity")


@query(_flag_sql("sailing"))
def act_sailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, "sailing")


@query(_flag_sql("happy"))
def act_happy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, "happy")


@query(_flag_sql("moonbathing"))
def act_moonbathing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag(spark, sf_dir, "moonbathing")


@query(over_obs(NON_SUNNY))
def distinct_non_sunny(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.indoor_conditions(testdata.obs(spark, sf_dir))


FLAG_FROM_FORECAST = over_obs(
    """select date, city, case when upper(weather_condition) in (
  select upper(weather_condition) from obs
  where from_table = 'forecast' and trim(upper(weather_condition)) <> 'SUNNY')
  then 'yes' else 'no' end as indoor_activity
from obs where from_table = 'historic'"""
)


@query(FLAG_FROM_FORECAST)
def in_subquery_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = ops.with_indoor_activity(
        testdata.historic(spark, sf_dir), indoor_source=testdata.forecast(spark, sf_dir)
    )
    return flagged.select("date", "city", "indoor_activity")


# ---- counts ------------------------------------------------------------------------

CATEGORY_SQL = {
    "sunny": "trim(upper(weather_condition)) = 'SUNNY'",
    "rain": """trim(upper(weather_condition)) in ('LIGHT DRIZZLE', 'PATCHY RAIN POSSIBLE',
    'LIGHT RAIN', 'LIGHT RAIN SHOWER', 'MODERATE RAIN', 'MODERATE OR HEAVY RAIN SHOWER',
    'HEAVY RAIN')""",
    "cloudy": "trim(upper(weather_condition)) in ('OVERCAST', 'CLOUDY', 'PARTLY CLOUDY')",
    "thunder": "trim(upper(weather_condition)) like '%THUNDER%'",
}


def _counts_sql(key: str, name: str) -> str:
    counts = ", ".join(
        f"count(case when {sql} then 1 end) as {category}_day_count_by_{name.split('_')[-1]}"
        for category, sql in CATEGORY_SQL.items()
    )
    return over_obs(
        f"select {key} as {name}, city, {counts} from obs where from_table = 'historic' group by all"
    )


@query(_counts_sql("strftime(cast(date as date), '%Y-%m')", "year_month"))
def condition_count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.condition_count_by_month(testdata.historic(spark, sf_dir))


@query(_counts_sql("cast(extract(year from cast(date as date)) as int)", "year"))
def condition_count_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.condition_count_by_year(testdata.historic(spark, sf_dir))


PRIORITIES = {
    "urgent": lambda c: c == "1-URGENT",
    "prompt": lambda c: c.isin("1-URGENT", "2-HIGH"),
    "unspecified": lambda c: c.contains("NOT SPECIFIED"),
}


@query(
    """select strftime(o_orderdate, '%Y-%m') as year_month, o_custkey,
  count(case when o_orderpriority = '1-URGENT' then 1 end) as urgent_orders,
  count(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 end) as prompt_orders,
  count(case when o_orderpriority like '%NOT SPECIFIED%' then 1 end) as unspecified_orders
from orders group by all"""
)
def order_priority_counts_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count operator over orders, one group per customer and month."""
    return ops.condition_counts(
        testdata.table(spark, sf_dir, "orders"),
        year_month("o_orderdate"),
        period_name="year_month",
        suffix="orders",
        group="o_custkey",
        condition="o_orderpriority",
        categories=PRIORITIES,
        count_name="{category}_{suffix}",
    )


# ---- aggregates and ranks ----------------------------------------------------------


def _round_sql(aggregate: str) -> str:
    return f"cast(round(cast({aggregate} as decimal(38,10)), 2) as double)"


MONTHLY_SQL = f"""monthly as (select strftime(cast(date as date), '%Y-%m') as year_month, city,
  {_round_sql("avg(max_temp_celcius)")} as avg_max_temp_celcuis_by_month,
  {_round_sql("avg(min_temp_celcius)")} as avg_min_temp_celcuis_by_month,
  {_round_sql("avg(max_wind_kph)")} as avg_max_wind_kph_by_month,
  {_round_sql("sum(total_rain_mm)")} as total_rain_mm_by_month
from obs group by all)"""


def _ranks_sql(source: str, group: str, ranks: dict[str, str]) -> str:
    columns = ", ".join(
        f"{metric}, rank() over (partition by {group} order by {metric} desc nulls first) as {name}"
        for metric, name in ranks.items()
    )
    return f"select {group}, city, {columns} from {source}"


@query(
    over_obs(
        """select year_month, city, avg_max_temp_celcuis_by_month, avg_min_temp_celcuis_by_month,
  avg_max_wind_kph_by_month from monthly""",
        MONTHLY_SQL,
    )
)
def avg_metrics_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ops.monthly_metrics(testdata.obs(spark, sf_dir))
    return decimals_as_double(metrics.drop("total_rain_mm_by_month"))


@query(over_obs("select year_month, city, total_rain_mm_by_month from monthly", MONTHLY_SQL))
def sum_rain_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ops.monthly_metrics(testdata.obs(spark, sf_dir))
    return decimals_as_double(metrics.select("year_month", "city", "total_rain_mm_by_month"))


DAILY_RANKS_SQL = {
    "max_temp_celcius": "rank_of_city_max_temp_by_day",
    "min_temp_celcius": "rank_of_city_min_temp_by_day",
    "max_wind_kph": "rank_of_city_max_wind_kph_by_day",
    "total_rain_mm": "rank_of_city_total_rain_mm_by_day",
}
MONTHLY_RANKS_SQL = {
    "avg_max_temp_celcuis_by_month": "rank_of_city_avg_max_temp_by_month",
    "avg_min_temp_celcuis_by_month": "rank_of_city_avg_min_temp_by_month",
    "avg_max_wind_kph_by_month": "rank_of_city_avg_max_wind_kph_by_month",
    "total_rain_mm_by_month": "rank_of_city_total_rain_mm_by_month",
}
RANKS_BY_DAY = over_obs(
    _ranks_sql("daily", "day", DAILY_RANKS_SQL), "daily as (select date as day, * from obs)"
)
RANKS_BY_MONTH = over_obs(_ranks_sql("monthly", "year_month", MONTHLY_RANKS_SQL), MONTHLY_SQL)


@query(RANKS_BY_DAY)
def rank_metrics_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rank_metrics_by_day(testdata.obs(spark, sf_dir))


@query(RANKS_BY_MONTH)
def rank_metrics_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(ops.rank_metrics_by_month(testdata.obs(spark, sf_dir)))


RANKS_BY_FLAG = """select l_returnflag, l_orderkey, l_linenumber, l_partkey,
  l_extendedprice,
  rank() over (partition by l_returnflag order by l_extendedprice desc nulls first) as price_rank,
  l_quantity,
  rank() over (partition by l_returnflag order by l_quantity desc nulls first) as quantity_rank
from lineitem"""


def _ranked_by_flag(spark: SparkSession, sf_dir: str, group_rows: int) -> DataFrame:
    lines = testdata.table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        "l_quantity",
    )
    return ops.rank_metrics(
        lines,
        ["l_returnflag"],
        {"l_extendedprice": "price_rank", "l_quantity": "quantity_rank"},
        group_rows=group_rows,
    )


@query(RANKS_BY_FLAG)
def rank_lines_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups, each with a third of all rows, under the default group limit."""
    return _ranked_by_flag(spark, sf_dir, GROUP_ROWS)


@query(RANKS_BY_FLAG)
def rank_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranks with a low limit, so that all three groups are cut up."""
    return _ranked_by_flag(spark, sf_dir, 1_000)


@query(
    """select cast(ts as date) as day, user_id, event_id, value,
  rank() over (partition by cast(ts as date) order by value desc nulls first) as value_rank
from events"""
)
def rank_events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), "user_id", "event_id", "value"
    )
    return ops.rank_metrics(events, ["day"], {"value": "value_rank"})
