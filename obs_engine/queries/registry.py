"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The observations of `obs_engine.testdata.obs` in SQL.
OBS_SQL = """
select
  case when cast(cast(min(l_shipdate) as date) as varchar) < '2001-06-01'
       then 'historic' else 'forecast' end as from_table,
  cast(cast(l_shipdate as date) as varchar) as date,
  n_name as city,
  max(l_quantity) as max_temp_celcius,
  min(l_quantity) as min_temp_celcius,
  cast(nullif(cast(round(max(l_discount) * 100) as int), 0) * 3 as double) as max_wind_kph,
  cast(sum(cast(l_tax as decimal(18,4))) as double) as total_rain_mm,
  cast(max(l_linenumber) * 10 as double) as average_humity,
  case min(l_partkey % 18)
    when 0 then 'Sunny' when 1 then ' sunny ' when 2 then 'Partly cloudy'
    when 3 then 'Overcast' when 4 then 'Cloudy' when 5 then 'Light drizzle'
    when 6 then 'Patchy rain possible' when 7 then 'Moderate or heavy rain shower'
    when 8 then 'Heavy rain' when 9 then 'Patchy light rain with thunder'
    when 10 then 'Thundery outbreaks possible' when 11 then 'Mist'
    when 12 then 'SUNNY' when 13 then 'Light rain' when 14 then 'Light rain shower'
    when 15 then 'Moderate rain' when 16 then 'Fog' end as weather_condition,
  case when extract(day from min(l_shipdate)) % 8 = 0
       then 'Full Moon' else 'Waning Crescent' end as moon_phase,
  cast(extract(day from min(l_shipdate)) * 3 as varchar) as moon_illumination,
  concat('0', cast(5 + extract(day from min(l_shipdate)) % 2 as varchar), ':',
         lpad(cast(extract(day from min(l_shipdate)) as varchar), 2, '0'), ' AM') as sunrise,
  concat('0', cast(5 + extract(day from min(l_shipdate)) % 3 as varchar), ':',
         lpad(cast(extract(day from min(l_shipdate)) as varchar), 2, '0'), ' PM') as sunset,
  cast(max(l_linenumber) as double) as average_visibility_km,
  cast(min(l_linenumber) as double) as uv_rating,
  '07:40 PM' as moonrise,
  '06:10 AM' as moonset
from lineitem
join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey
group by cast(cast(l_shipdate as date) as varchar), n_name
"""


def over_obs(sql: str, *more: str) -> str:
    """SQL over the view ``obs``; ``more`` are further ``name as (...)`` parts."""
    return f"with obs as ({OBS_SQL})" + "".join(f", {m}" for m in more) + "\n" + sql


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its check if there is one."""

    def register(build: Query) -> Query:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Decimals compare as doubles in the check."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
