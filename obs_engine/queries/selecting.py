"""Entity selection and incremental operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine import operators as ops
from obs_engine import testdata
from obs_engine.functions import whole_number
from obs_engine.queries.registry import over_obs, query

RECORDS = """records as (
  select replace(n_name, '_', case n_nationkey % 3 when 0 then ' ' when 1 then '-' else '' end)
      as city,
    r_name as country, cast(extract(year from o_orderdate) as varchar) as year,
    cast(sum(cast(o_totalprice as decimal(18,2))) as varchar) as value
  from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  group by all)"""


@query(f"with {RECORDS} select year, value, city, country from records")
def explode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = testdata.population_records(spark, sf_dir)
    return ops.raw_population(testdata.population_documents(records))


@query(
    f"""with {RECORDS},
largest as (select city as entity, max(cast(value as double)) as size from records
  group by city order by size desc, entity limit 30),
named as (select records.*, size from records join largest on city = entity
  where not regexp_matches(city, ' |-'))
select city, country, year, value from named
where contains(year, (select max(year) from named)) order by size desc, city limit 10"""
)
def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_entities(testdata.population_records(spark, sf_dir))


CUSTOMER_TOTALS = """records as (
  select replace(c_name, '#', '') as name, o_orderstatus as status,
    cast(extract(year from o_orderdate) as varchar) as year,
    sum(cast(o_totalprice as decimal(18,2))) as total
  from orders join customer on o_custkey = c_custkey group by all)"""


@query(
    f"""with {CUSTOMER_TOTALS},
largest as (select name as entity, max(cast(total as double)) as size from records
  group by name order by size desc, entity limit 300),
named as (select records.*, size from records join largest on name = entity)
select name, status, year, cast(total as double) as total from named
where contains(year, (select max(year) from named))
order by size desc, name, total desc limit 100"""
)
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same selection over many entities, with other limits."""
    orders = testdata.table(spark, sf_dir, "orders")
    customer = testdata.table(spark, sf_dir, "customer")
    records = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.replace(F.col("c_name"), F.lit("#"), F.lit("")).alias("name"),
            F.col("o_orderstatus").alias("status"),
            F.year("o_orderdate").cast("string").alias("year"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    )
    top = ops.top_entities(records, name="name", measure="total", prefetch=300, n=100)
    return top.withColumn("total", F.col("total").cast("double"))


@query("select page_id, url from pages where not regexp_matches(url, ' |-')")
def filter_regex_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.filter_regex_not(testdata.table(spark, sf_dir, "pages").select("page_id", "url"), "url")


@query(
    """with dated as (select o_orderkey, cast(extract(year from o_orderdate) as varchar) as year
  from orders)
select o_orderkey, year from dated where contains(year, (select max(year) from dated))"""
)
def filter_latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testdata.table(spark, sf_dir, "orders")
    dated = orders.select("o_orderkey", F.year("o_orderdate").cast("string").alias("year"))
    return ops.filter_latest_period(dated, "year")


@query(over_obs("select max(date) as mark from obs where from_table = 'historic'"))
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.high_water_mark(testdata.historic(spark, sf_dir), "date")


AS_OF = "2001-08-01"


@query(
    over_obs(
        f"""select date, city, max_temp_celcius from obs
where cast(date as date) > (select max(cast(date as date)) from obs where from_table = 'historic')
  and cast(date as date) < date '{AS_OF}'"""
    )
)
def extraction_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.obs(spark, sf_dir)
    mark = ops.high_water_mark(rows.where(F.col("from_table") == "historic"), "date").first()["mark"]
    days = ops.extraction_window(rows, "date", mark=mark, as_of=AS_OF, days_back=365)
    return days.select("date", "city", "max_temp_celcius")


@query(
    f"""select o_orderkey, o_orderdate from orders
where o_orderdate >= date '{AS_OF}' - interval 365 day and o_orderdate < date '{AS_OF}'"""
)
def extraction_window_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No mark yet: a year back, on a typed column, so the bounds reach the scan."""
    orders = testdata.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ops.extraction_window(orders, "o_orderdate", mark=None, as_of=AS_OF, days_back=365)


GRID = """select n_name as city, cast(day as date) as date from nation,
  (select min(cast(l_shipdate as date)) as low, max(cast(l_shipdate as date)) as high
   from lineitem),
  unnest(generate_series(low, high, interval 1 day)) as days(day)"""


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation on every day from the first to the last shipment."""
    span = testdata.table(spark, sf_dir, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("low"),
        F.to_date(F.max("l_shipdate")).alias("high"),
    )
    nation = testdata.table(spark, sf_dir, "nation").select(F.col("n_name").alias("city"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    return ops.work_list(nation, low, F.date_add(high, 1))


@query(GRID)
def date_city_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir)


@query(
    over_obs(
        """select city, date from grid where not exists (
  select 1 from obs where obs.city = grid.city and cast(obs.date as date) = grid.date)""",
        f"grid as ({GRID})",
    )
)
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a nation without any shipment, among those of the whole span."""
    lines = testdata.table(spark, sf_dir, "lineitem")
    supplier = testdata.table(spark, sf_dir, "supplier")
    nation = testdata.table(spark, sf_dir, "nation")
    loaded = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    keys = loaded.select(F.col("n_name").alias("city"), F.to_date("l_shipdate").alias("date"))
    return ops.missing_keys(_grid(spark, sf_dir), keys, ["city", "date"])


@query(
    """with marked as (select l_returnflag, case when l_tax > 0.05 then null
    else l_extendedprice end as price from lineitem)
select l_returnflag, count(*) as lines, count(price) as priced, max(price) as top_price,
  cast(sum(cast(price as decimal(18,2))) as double) as total from marked group by all"""
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = testdata.table(spark, sf_dir, "lineitem")
    price = F.when(F.col("l_tax") > 0.05, float("nan")).otherwise(F.col("l_extendedprice"))
    marked = ops.nan_to_null(lines.select("l_returnflag", price.alias("price")))
    return marked.groupBy("l_returnflag").agg(
        F.count("*").alias("lines"),
        F.count("price").alias("priced"),
        F.max("price").alias("top_price"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(
    """select o_orderkey, cast(trim(concat(' ', cast(o_custkey as varchar), ' ')) as int) as customer,
  cast(round_even(o_totalprice, 0) as int) as price from orders"""
)
def whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with spaces and numbers to INT, the latter rounded."""
    orders = testdata.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("customer"),
        F.col("o_totalprice").alias("price"),
    )
    return orders.select(
        "o_orderkey",
        *[
            whole_number(c, orders.schema[c].dataType).alias(c)
            for c in ("customer", "price")
        ],
    )
