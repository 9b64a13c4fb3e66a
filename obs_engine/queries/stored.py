"""Queries that write tables, logs and documents derived from the given tables.

Each run writes to a fresh folder of the scratch area and reads it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine import operators as ops
from obs_engine import plans, sources, testdata
from obs_engine.functions import year_month
from obs_engine.queries.registry import decimals_as_double, over_obs, query
from obs_engine.queries.weather import (
    CATEGORY_SQL,
    MONTHLY_RANKS_SQL,
    RAW_ROWS,
    _ranks_sql,
    _round_sql,
)
from obs_engine.session import scratch_path
from obs_engine.streaming import apply_batch, fold_states, start_month_states, start_weather_upsert

# ---- overwrite ---------------------------------------------------------------------


@query(over_obs("select date, city, max_temp_celcius from obs where from_table = 'forecast'"))
def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History first, then the forecast over it: only the latter is left."""
    path = scratch_path(spark, "overwrite")
    for rows in (testdata.historic(spark, sf_dir), testdata.forecast(spark, sf_dir)):
        monthly = rows.withColumn("year_month", year_month("date"))
        sources.overwrite_table(monthly, path, period="year_month", order=["city", "date"])
    return sources.read_table(spark, path).select("date", "city", "max_temp_celcius")


@query("select count(*) as rows_written from lineitem")
def rows_written_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted while they are written, not by reading them again."""
    lines = testdata.table(spark, sf_dir, "lineitem")
    rows = sources.overwrite_table(lines, scratch_path(spark, "metric"))
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows_written"))


# ---- upsert ------------------------------------------------------------------------

KEYS = ["city", "date"]
MEASURES = ["max_temp_celcius", "total_rain_mm", "weather_condition"]
EXISTING_BEFORE, BATCH_FROM = "2000-06-01", "2000-01-01"


def _changed(rows: DataFrame) -> DataFrame:
    """A warmer day, and rain taken back on hot ones."""
    hot = F.col("max_temp_celcius") > 45
    return rows.withColumn("total_rain_mm", F.when(~hot, F.col("total_rain_mm"))).withColumn(
        "max_temp_celcius", F.col("max_temp_celcius") + 1
    )


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = testdata.historic(spark, sf_dir).select(*KEYS, *MEASURES)
    existing = rows.where(F.col("date") < EXISTING_BEFORE)
    return existing, _changed(rows.where(F.col("date") >= BATCH_FROM))


UPSERT_PARTS = (
    f"""existing as (select city, date, {", ".join(MEASURES)} from obs
  where from_table = 'historic' and date < '{EXISTING_BEFORE}')""",
    f"""batch as (select city, date, max_temp_celcius + 1 as max_temp_celcius,
  case when max_temp_celcius <= 45 then total_rain_mm end as total_rain_mm, weather_condition
  from obs where from_table = 'historic' and date >= '{BATCH_FROM}')""",
)
UPSERTED = over_obs(
    """select * from batch union all
select * from existing e where not exists (
  select 1 from batch b where b.city = e.city and b.date = e.date)""",
    *UPSERT_PARTS,
)


def _table_rows(spark: SparkSession, path: str) -> DataFrame:
    return sources.read_table(spark, path).select(*KEYS, *MEASURES)


def _upserted(spark: SparkSession, *batches: DataFrame, **options: int) -> DataFrame:
    path = scratch_path(spark, "upsert")
    for batch in batches:
        sources.upsert_table(spark, path, batch, KEYS, **options)
    return _table_rows(spark, path)


@query(UPSERTED)
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, *_split(spark, sf_dir))


@query(UPSERTED)
def upsert_large_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for batches too large to join outwards from."""
    return _upserted(spark, *_split(spark, sf_dir), small_batch_rows=0)


@query(UPSERTED)
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, batch = _split(spark, sf_dir)
    return _upserted(spark, existing, batch, batch)


@query(
    over_obs(
        f"""select * from existing where date < '{BATCH_FROM}'
union all select * from batch""",
        *UPSERT_PARTS,
    )
)
def upsert_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, batch = _split(spark, sf_dir)
    return _upserted(spark, batch, existing.where(F.col("date") < BATCH_FROM))


@query(
    over_obs(
        """select coalesce(e.city, b.city) as city, coalesce(e.date, b.date) as date,
  case when b.city is null then e.max_temp_celcius else b.max_temp_celcius end
    as max_temp_celcius,
  case when b.city is null then e.total_rain_mm else b.total_rain_mm end as total_rain_mm,
  e.weather_condition
from existing e full join batch b on e.city = b.city and e.date = b.date""",
        *UPSERT_PARTS,
    )
)
def upsert_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without a column leaves it as it is; new rows have NULL there."""
    existing, batch = _split(spark, sf_dir)
    return _upserted(spark, existing, batch.drop("weather_condition"))


@query(
    """select l_orderkey, l_partkey, l_linestatus, l_quantity from (
  select *, row_number() over (partition by l_orderkey
    order by l_shipdate desc, l_partkey desc, l_linestatus desc, l_quantity desc) as place
  from lineitem) where place = 1"""
)
def upsert_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many lines of one order in a batch: the last shipped one stays."""
    lines = testdata.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_partkey", "l_linestatus", "l_quantity"
    )
    path = scratch_path(spark, "upsert")
    sources.upsert_table(spark, path, lines, ["l_orderkey"], period=None, seq="l_shipdate")
    return sources.read_table(spark, path)


MERGED_ORDERS = """select coalesce(e.o_orderkey, b.o_orderkey) as o_orderkey,
  case when b.o_orderkey is null then e.o_orderstatus else 'X' end as o_orderstatus,
  case when b.o_orderkey is null then e.o_totalprice
    when b.o_totalprice > 100000 then b.o_totalprice end as o_totalprice,
  e.o_orderpriority
from (select * from orders where o_orderdate < date '2000-01-01') e
full join (select * from orders where o_orderdate >= date '1999-01-01') b
  on e.o_orderkey = b.o_orderkey"""


def _merged_orders(spark: SparkSession, sf_dir: str, small_batch: bool) -> DataFrame:
    orders = testdata.table(spark, sf_dir, "orders")
    existing = orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("date"))
    batch = orders.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("date"))
    price = F.col("o_totalprice")
    return ops.merge_frames(
        existing.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
        batch.select(
            "o_orderkey",
            F.lit("X").alias("o_orderstatus"),
            F.when(price > 100_000, price).alias("o_totalprice"),
        ),
        ["o_orderkey"],
        small_batch=small_batch,
    )


@query(MERGED_ORDERS)
def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_orders(spark, sf_dir, small_batch=False)


@query(MERGED_ORDERS)
def merge_orders_small_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = testdata.table(spark, sf_dir, "orders").where(
        F.col("o_orderdate") >= F.lit("1999-01-01").cast("date")
    )
    small = batch.count() <= sources.tables.SMALL_BATCH_ROWS
    return _merged_orders(spark, sf_dir, small_batch=small)


# ---- documents ---------------------------------------------------------------------


def _undotted(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


@query(RAW_ROWS)
def src_weather_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "weather")
    testdata.weekly_documents(testdata.obs(spark, sf_dir)).write.json(path)
    raw = ops.raw_weather(sources.read_weather(spark, path))
    return _undotted(raw.drop(sources.ARRIVED_AT))


@query(
    """select replace(n_name, '_', case n_nationkey % 3 when 0 then ' ' when 1 then '-' else '' end)
    as city, r_name as country, cast(extract(year from o_orderdate) as varchar) as year,
  cast(sum(cast(o_totalprice as decimal(18,2))) as varchar) as value
from orders join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by all"""
)
def src_population_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "population")
    records = testdata.population_records(spark, sf_dir)
    testdata.population_documents(records).write.json(path)
    return ops.raw_population(sources.read_population(spark, path))


# ---- logs --------------------------------------------------------------------------


@query(
    over_obs(
        """select substr(date, 1, 7) || '-28' as log_date, max(date) as incremental_value
from obs where from_table = 'historic' group by substr(date, 1, 7)
union all
select '2001-12-31', max(date) from obs where from_table = 'forecast'"""
    )
)
def hwm_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with a mark per month of history, then one more for a new load."""
    path = scratch_path(spark, "marks")
    month = F.substring("date", 1, 7)
    marks = testdata.historic(spark, sf_dir).groupBy(month.alias("month")).agg(
        F.max("date").alias("incremental_value")
    )
    log_date = F.concat("month", F.lit("-28")).alias("log_date")
    sources.append_marks(marks.select(log_date, "incremental_value"), path)
    loaded = testdata.forecast(spark, sf_dir)
    sources.advance_mark(spark, path, loaded, "date", "2001-12-31")
    return sources.read_marks(spark, path)


@query(
    over_obs(
        """select mark, strftime(cast(mark as date) + interval 1 day, '%Y-%m-%d') as load_from
from (select max(date) as mark from obs where from_table = 'historic')"""
    )
)
def src_hwm_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark read back from a CSV log and the day to load from."""
    path = scratch_path(spark, "marks")
    marks = testdata.historic(spark, sf_dir).select(
        F.col("date").alias("log_date"), F.col("date").alias("incremental_value")
    )
    sources.append_marks(marks, path)
    load_from = F.date_add(F.to_date("mark"), 1).cast("string").alias("load_from")
    return ops.high_water_mark(sources.read_marks(spark, path)).select("mark", load_from)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the role of run states."""
    return testdata.table(spark, sf_dir, "events").select(
        F.col("ts").alias("run_timestamp"),
        F.col("user_id").cast("int").alias("run_id"),
        F.col("event_type").alias("run_status"),
    )


@query("select cast(coalesce(max(user_id), 0) + 1 as int) as run_id from events")
def ledger_next_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.next_run_id(_ledger(spark, sf_dir))


@query(
    """select cast(user_id as int) as run_id, event_type as run_status from (
  select *, row_number() over (partition by user_id order by ts desc, event_type desc) as place
  from events) where place = 1"""
)
def ledger_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.latest_status(_ledger(spark, sf_dir))


@query(
    """with ledger as (
  select cast(user_id as int) as run_id, event_type as run_status from events
  union all select max(user_id) + 1, 'Started' from events
  union all select max(user_id) + 1, 'Completed' from events)
select cast(run_id as int) as run_id, count(*) as states,
  count(case when run_status in ('Started', 'Completed') then 1 end) as logged
from ledger group by all"""
)
def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new run after those of the ledger, with its two states."""
    path = scratch_path(spark, "ledger")
    states = _ledger(spark, sf_dir).select(
        F.col("run_timestamp").cast("string").alias("run_timestamp"),
        "run_id",
        "run_status",
        F.lit("{}").alias("run_config"),
        F.lit("").alias("run_log"),
    )
    sources.append_rows(states, path)
    run_id = sources.new_run_id(spark, path)
    sources.append_run(spark, path, run_id, "Started", {"days_back": 365})
    sources.append_run(spark, path, run_id, "Completed", {"days_back": 365}, "loaded")
    return (
        sources.read_table(spark, path)
        .groupBy("run_id")
        .agg(
            F.count("*").alias("states"),
            F.count_if(F.col("run_status").isin("Started", "Completed")).alias("logged"),
        )
    )


# ---- stream ------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, serve: bool) -> str:
    """Documents of history land, are loaded, and then corrected days land."""
    root, landed, checkpoint = (scratch_path(spark, f"stream-{p}") for p in ("root", "in", "state"))
    rows = testdata.historic(spark, sf_dir)
    corrected = _changed(rows.where(F.col("date") >= BATCH_FROM))
    for part in (rows.where(F.col("date") < EXISTING_BEFORE), corrected):
        testdata.daily_documents(part).write.mode("append").json(landed)
        stream = sources.stream_weather(spark, landed)
        start_weather_upsert(stream, root, checkpoint, serve=serve).awaitTermination()
    return root


@query(UPSERTED)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = sources.read_table(spark, f"{_stream(spark, sf_dir, serve=False)}/raw_historic")
    return plans.stage(stored).select(*KEYS, *MEASURES)


@query(
    over_obs(
        "select substr(date, 1, 7) as year_month, city, "
        + ", ".join(
            f"count(case when {sql} then 1 end) as {category}_day_count_by_month"
            for category, sql in CATEGORY_SQL.items()
        )
        + " from obs where from_table = 'historic' group by all"
    )
)
def stream_condition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A serving table kept up to date by the stream."""
    root = _stream(spark, sf_dir, serve=True)
    return plans.read_model(spark, root, "serving_weather_condition_count_by_month")


# ---- whole load --------------------------------------------------------------------

FIRST_AS_OF, SECOND_AS_OF = "2000-03-15", "2001-06-01"


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """Two loads: history up to a day, then the days since, each with a forecast."""
    root, landed = scratch_path(spark, "load"), scratch_path(spark, "landed")
    rows = testdata.obs(spark, sf_dir)
    records = testdata.population_records(spark, sf_dir, plain=True)
    testdata.population_documents(records).write.json(f"{landed}/cities")
    testdata.weekly_documents(rows).write.json(f"{landed}/weather")
    weather = sources.read_weather(spark, f"{landed}/weather")
    for as_of in (FIRST_AS_OF, SECOND_AS_OF):
        plans.refresh(
            spark,
            root,
            as_of=as_of,
            days_back=10_000,
            cities=sources.read_population(spark, f"{landed}/cities"),
            historic=weather,
            forecast=_days_from(weather, F.lit(as_of)),
        )
    return root


def _days_from(documents: DataFrame, first: Column) -> DataFrame:
    """The documents with only the days from ``first`` on."""
    days = F.filter("forecast.forecastday", lambda d: d["date"] >= first)
    return documents.withColumn("forecast", F.struct(days.alias("forecastday")))


TOP_CITIES = """top_ten as (select city from (
  select city, max(value) as size, max(year) as latest from (
    select n_name as city, extract(year from o_orderdate) as year,
      cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    group by all) group by city) where latest = (
      select max(extract(year from o_orderdate)) from orders)
  order by size desc, city limit 10)"""
LOADED = "loaded as (select * from obs where city in (select city from top_ten))"


@query(
    over_obs(
        f"""select 'raw_cities' as name, count(*) as n from top_ten
union all select 'raw_historic', count(*) from loaded where date < '{SECOND_AS_OF}'
union all select 'raw_forecast', count(*) from loaded where date >= '{SECOND_AS_OF}'
union all select 'staging_historic', count(*) from loaded where date < '{SECOND_AS_OF}'
union all select 'staging_forecast', count(*) from loaded where date >= '{SECOND_AS_OF}'
union all select 'staging_historic_and_forecast', count(*) from loaded
union all select 'serving_activities', count(*) from loaded
union all select 'serving_rank_city_metrics_by_day', count(*) from loaded
union all select 'serving_rank_city_metrics_by_month', count(distinct (city, substr(date, 1, 7)))
  from loaded
union all select 'serving_weather_condition_count_by_month',
  count(distinct (city, substr(date, 1, 7))) from loaded where date < '{SECOND_AS_OF}'
union all select 'serving_weather_condition_count_by_year',
  count(distinct (city, substr(date, 1, 4))) from loaded where date < '{SECOND_AS_OF}'
union all select 'pipeline_logs', 4
union all select 'historic_logs', 2""",
        TOP_CITIES,
        LOADED,
    )
)
def refresh_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _refreshed(spark, sf_dir)
    tables = [
        "raw_cities",
        "raw_historic",
        "raw_forecast",
        "staging_historic",
        "staging_forecast",
        "staging_historic_and_forecast",
        *plans.SERVING_MODELS,
        "pipeline_logs",
    ]
    frames = {name: sources.read_table(spark, f"{root}/{name}") for name in tables}
    frames["historic_logs"] = sources.read_marks(spark, f"{root}/historic_logs")
    return ops.union_by_name(
        *[
            df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
            for name, df in frames.items()
        ]
    )


@query(
    over_obs(
        _ranks_sql("monthly", "year_month", MONTHLY_RANKS_SQL),
        TOP_CITIES,
        LOADED,
        f"""monthly as (select substr(date, 1, 7) as year_month, city,
  {_round_sql("avg(max_temp_celcius)")} as avg_max_temp_celcuis_by_month,
  {_round_sql("avg(min_temp_celcius)")} as avg_min_temp_celcuis_by_month,
  {_round_sql("avg(max_wind_kph)")} as avg_max_wind_kph_by_month,
  {_round_sql("sum(total_rain_mm)")} as total_rain_mm_by_month
from loaded group by all)""",
    )
)
def refresh_rank_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A serving table after the second, incremental load."""
    root = _refreshed(spark, sf_dir)
    ranks = plans.read_model(spark, root, "serving_rank_city_metrics_by_month")
    return decimals_as_double(ranks)


# ---- what a load leaves open, reads once and finishes ------------------------------

WEEK_SQL = "datediff('day', date '1990-01-01', cast(date_trunc('week', cast(date as date)) as date)) // 7"


def _week(documents: DataFrame) -> Column:
    first = F.to_date(F.element_at("forecast.forecastday.date", 1))
    return F.floor(F.date_diff(F.date_trunc("week", first), F.lit("1990-01-01").cast("date")) / 7)


@query(
    over_obs(
        """select step, city, count(*) as loaded_days, count(distinct part) as intervals,
  10000 - count(*) as days_open, (select count(distinct (city, week)) from days where week % 5 = 0) as rejected
from (select step, city, day - cast(row_number() over (partition by step, city order by day) as int) as part
  from loaded) group by step, city""",
        f"""days as (select city, cast(date as date) as day, {WEEK_SQL} as week from obs
  where date < '{SECOND_AS_OF}')""",
        """loaded as (select 1 as step, city, day from days where week % 5 <> 0
  union all select 2, city, day from days where week % 5 <> 0 or week % 10 = 0)""",
    )
)
def load_fills_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some weeks come as errors and are put aside; half of them are delivered again."""
    root, landed = scratch_path(spark, "gaps"), scratch_path(spark, "gaps-landed")
    rows = testdata.obs(spark, sf_dir).where(F.col("date") < SECOND_AS_OF)
    documents = testdata.weekly_documents(rows)
    week = _week(documents)
    sound = F.when(week % 5 != 0, F.col("forecast")).alias("forecast")
    # The number of the week keeps errors of one city apart.
    documents.select("City_Name", sound, F.struct(week.alias("week")).alias("request")).write.json(landed)
    cities = rows.select(F.col("city").alias("City_Name")).distinct()
    landing = sources.Landing(landed, fields=T.StructType.fromDDL("request struct<week: bigint>"))
    steps = []
    for step in (1, 2):
        if step == 2:
            documents.where(week % 10 == 0).write.mode("append").json(landed)
        done = plans.load_raw(spark, root, as_of=SECOND_AS_OF, days_back=10_000, historic=landing, set_aside=True)
        plans.commit(spark, root, done, SECOND_AS_OF)
        known = plans.loaded_days(spark, root)
        still_open = plans.open_days(spark, root, cities, as_of=SECOND_AS_OF, days_back=10_000)
        length = F.sum(F.date_diff("last_day", "first_day") + 1)
        loaded = known.groupBy("City_Name").agg(length.alias("loaded_days"), F.count("*").alias("intervals"))
        left = still_open.groupBy("City_Name").agg(length.alias("days_open"))
        both = loaded.join(left, "City_Name").select(
            F.lit(step).alias("step"), F.col("City_Name").alias("city"), "loaded_days", "intervals", "days_open"
        )
        path = scratch_path(spark, f"gaps-step-{step}")
        both.write.parquet(path)  # the ledger is replaced by the next load
        steps.append(spark.read.parquet(path))
    rejected = sources.read_table(spark, f"{root}/raw_rejected").count()
    return ops.union_by_name(*steps).withColumn("rejected", F.lit(rejected).cast("long"))


@query(
    over_obs(
        f"""select city, date, max_temp_celcius from obs
where date >= '{FIRST_AS_OF}' or (date < '{BATCH_FROM}' and substr(date, 9, 2) = '07')"""
    )
)
def src_weather_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second read of a folder: documents that landed since, late days among them."""
    landed, ledger = scratch_path(spark, "landing"), scratch_path(spark, "landing-ledger")
    rows = testdata.obs(spark, sf_dir)
    late = (F.col("date") < BATCH_FROM) & (F.substring("date", 9, 2) == "07")
    second = (F.col("date") >= FIRST_AS_OF) | late
    landing = sources.Landing(landed)
    testdata.daily_documents(rows.where(~second)).write.json(landed)
    sources.mark_read(sources.unread(spark, landing, ledger).files, ledger)
    testdata.daily_documents(rows.where(second)).write.mode("append").json(landed)
    raw = ops.raw_weather(sources.unread(spark, landing, ledger).documents)
    return raw.select(
        F.col("City_Name").alias("city"), "date", F.col("`day.maxtemp_c`").alias("max_temp_celcius")
    )


@query(
    over_obs(
        f"""select 'historic' as from_table, date, city, max_temp_celcius from obs where date < '{FIRST_AS_OF}'
union all
select 'forecast', date, city, max_temp_celcius from obs where date between '2001-01-01' and '2001-03-31'"""
    )
)
def refresh_after_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that ends before its models leaves no stale forecast to the next one."""
    root, landed = scratch_path(spark, "stop"), scratch_path(spark, "stop-landed")
    testdata.weekly_documents(testdata.obs(spark, sf_dir)).write.json(landed)
    weather = sources.read_weather(spark, landed)

    def days(first: str, last: str) -> DataFrame:
        chosen = F.filter("forecast.forecastday", lambda d: d["date"].between(first, last))
        return weather.withColumn("forecast", F.struct(chosen.alias("forecastday")))

    options = {"as_of": FIRST_AS_OF, "days_back": 10_000}
    plans.load(spark, root, historic=weather, forecast=days("2000-03-15", "2000-08-31"), **options)
    plans.load_raw(spark, root, forecast=days("2000-09-01", "2000-10-31"), **options)
    plans.load(spark, root, forecast=days("2001-01-01", "2001-03-31"), **options)
    unified = plans.read_model(spark, root, "staging_historic_and_forecast")
    return unified.select("from_table", F.col("date").cast("string").alias("date"), "city", "max_temp_celcius")


@query(
    over_obs(
        f"""select city, date, max_temp_celcius,
  case when date >= '{BATCH_FROM}' then max_temp_celcius + 0.5 end as feels_like,
  case when date >= '{BATCH_FROM}' then upper(city) end as country
from obs where date < '{SECOND_AS_OF}'"""
    )
)
def src_weather_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that later documents have are added to the table, NULL in earlier rows."""
    landed, path = scratch_path(spark, "fields"), scratch_path(spark, "fields-table")
    rows = testdata.obs(spark, sf_dir).where(F.col("date") < SECOND_AS_OF)
    plain = testdata.daily_documents(rows)
    later = F.element_at("forecast.forecastday.date", 1) >= BATCH_FROM
    days = F.transform(
        "forecast.forecastday", lambda d: d.withField("day.feelslike_c", d["day"]["maxtemp_c"] + 0.5)
    )
    richer = plain.select(
        "City_Name",
        F.struct(days.alias("forecastday")).alias("forecast"),
        F.struct(F.upper("City_Name").alias("country")).alias("location"),
    )
    plain.where(~later).write.json(f"{landed}/1")
    richer.where(later).write.json(f"{landed}/2")
    for part, fields in ((1, None), (2, sources.FOUND)):
        raw = ops.raw_weather(sources.read_weather(spark, f"{landed}/{part}", fields=fields))
        sources.upsert_table(
            spark, path, raw, ["City_Name", "date"], seq=sources.ARRIVED_AT, evolve=True
        )
    return sources.read_table(spark, path).select(
        F.col("City_Name").alias("city"),
        "date",
        F.col("`day.maxtemp_c`").alias("max_temp_celcius"),
        F.col("`day.feelslike_c`").alias("feels_like"),
        F.col("`location.country`").alias("country"),
    )


# ---- states of months --------------------------------------------------------------

CORRECTED = f"""corrected as (select city, date, min_temp_celcius, max_wind_kph, weather_condition,
  max_temp_celcius + case when date >= '{BATCH_FROM}' then 1 else 0 end as max_temp_celcius,
  case when date < '{BATCH_FROM}' or max_temp_celcius <= 45 then total_rain_mm end as total_rain_mm
  from obs where from_table = 'historic')"""
MONTH_COUNTS_SQL = ", ".join(
    f"count(case when {sql} then 1 end) as {category}_day_count_by_month"
    for category, sql in CATEGORY_SQL.items()
)


@query(
    over_obs(
        f"""select substr(date, 1, 7) as year_month, city,
  {_round_sql("avg(max_temp_celcius)")} as avg_max_temp_celcuis_by_month,
  {_round_sql("avg(min_temp_celcius)")} as avg_min_temp_celcuis_by_month,
  {_round_sql("avg(max_wind_kph)")} as avg_max_wind_kph_by_month,
  {_round_sql("sum(total_rain_mm)")} as total_rain_mm_by_month,
  {MONTH_COUNTS_SQL}
from corrected group by all""",
        CORRECTED,
    )
)
def month_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from states: a first part, corrections of its last days, and new days."""
    path = scratch_path(spark, "states")
    rows = testdata.historic(spark, sf_dir)
    first, since = rows.where(F.col("date") < EXISTING_BEFORE), rows.where(F.col("date") >= BATCH_FROM)
    taken_back = first.where(F.col("date") >= BATCH_FROM).withColumn("sign", F.lit(-1))
    signed = taken_back.unionByName(_changed(since).withColumn("sign", F.lit(1)))
    fold_states(spark, path, ops.month_states(first), "load-1")
    for _ in range(2):  # the second time nothing is added
        fold_states(spark, path, ops.month_states(signed, "sign"), "load-2")
    states = sources.read_table(spark, path)
    metrics = ops.metrics_of_states(states).join(ops.counts_of_states(states), ["year_month", "city"])
    return decimals_as_double(metrics)


@query(
    over_obs(f"select substr(date, 1, 7) as year_month, city, {MONTH_COUNTS_SQL} from corrected group by all", CORRECTED)
)
def stream_condition_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept by the changes of a stream: corrected days, and a batch that comes twice."""
    root, landed, checkpoint = (scratch_path(spark, f"changes-{p}") for p in ("root", "in", "state"))
    rows = testdata.historic(spark, sf_dir)
    corrected = _changed(rows.where(F.col("date") >= BATCH_FROM))
    for part in (rows.where(F.col("date") < EXISTING_BEFORE), corrected):
        testdata.daily_documents(part).write.mode("append").json(landed)
        stream = sources.stream_weather(spark, landed)
        start_month_states(stream, root, checkpoint).awaitTermination()
    again = ops.raw_weather(testdata.daily_documents(corrected))
    for _ in range(2):
        apply_batch(spark, root, again, "again-0")
    states = sources.read_table(spark, f"{root}/state_months")
    return ops.counts_of_states(states)
