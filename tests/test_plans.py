"""Physical plans: what is shuffled, broadcast and pushed down."""

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from obs_engine import operators as ops
from obs_engine import plans, sources, testdata
from obs_engine.queries import QUERIES


def plan(df):
    """The plan before execution, without the adaptive wrapper's repetition."""
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", text)


@pytest.fixture
def stored_obs(spark, folder):
    testdata.obs(spark, SF_DIR).write.parquet(folder)
    return spark.read.parquet(folder)


def test_four_daily_ranks_share_one_exchange(stored_obs):
    text = plan(ops.rank_metrics_by_day(stored_obs))
    assert exchanges(text) == ["hashpartitioning"]
    assert "ReadSchema: struct<date:string,city:string,max_temp_celcius:double" in text
    assert "weather_condition" not in text


def test_monthly_ranks_combine_before_the_shuffle(stored_obs):
    text = plan(ops.rank_metrics_by_month(stored_obs))
    assert "partial_avg" in text
    assert exchanges(text) == ["hashpartitioning", "hashpartitioning"]


def test_activities_are_one_projection(stored_obs):
    text = plan(ops.activity_flags(stored_obs))
    assert "Exchange" not in text and "Join" not in text


def test_flag_of_other_source_broadcasts_the_counted_set(stored_obs):
    text = plan(ops.with_indoor_activity(stored_obs, stored_obs))
    assert "BroadcastHashJoin" in text
    large = ops.indoor_conditions(stored_obs)
    assert ops.broadcast_if_small(large, max_rows=1) is large
    assert ops.broadcast_if_small(large, max_bytes=1) is large


def test_counts_combine_before_the_shuffle(stored_obs):
    text = plan(plans.condition_count_by_month(stored_obs))
    assert exchanges(text) == ["hashpartitioning"]
    assert "partial_count" in text


def test_extraction_window_reaches_the_scan(spark, stored_obs):
    text = plan(
        ops.extraction_window(stored_obs, "date", mark=None, as_of="2001-08-01", days_back=30)
    )
    assert "GreaterThanOrEqual(date,2001-07-02)" in text
    assert "LessThan(date,2001-08-01)" in text


def test_small_batch_leaves_the_table_unshuffled(spark, stored_obs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = stored_obs.where("date = '2001-05-01'")
        small = plan(ops.merge_frames(stored_obs, batch, ["city", "date"], small_batch=True))
        large = plan(ops.merge_frames(stored_obs, batch, ["city", "date"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanges(small) == [] and "SortMergeJoin" not in small
    assert exchanges(large) == ["hashpartitioning", "hashpartitioning"]


def test_periods_prune_partitions(spark, stored_obs, folder):
    path = f"{folder}-monthly"
    monthly = stored_obs.withColumn("year_month", sources.MONTH.of())
    sources.overwrite_table(monthly, path, period="year_month")
    text = plan(sources.read_table(spark, path).where(F.col("year_month").isin("2001-05")))
    assert re.search(r"PartitionFilters: \[.*year_month", text)


@pytest.mark.parametrize("name", [n for n in QUERIES if not re.match("refresh|stream|upsert", n)])
def test_no_python_rows_and_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "ArrowEval", "BatchEval", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in text
