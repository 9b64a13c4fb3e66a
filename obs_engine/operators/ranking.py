"""Descending ranks within groups, for groups of any size.

``rank()`` over a window sorts each group in one task. That is the right plan while
groups are ordinary, and then it is the plan used: one exchange for all metrics. A
group holding a large share of all rows would hold up the whole job in one task, so
such groups are ranked in pieces instead:

1. count the rows of each distinct value (combines before the shuffle, so a value
   shared by most of the group is one row from here on);
2. cut the distinct values into ordered buckets at splitter values;
3. rank = 1 + rows in higher buckets + rows above the value inside its bucket.

Every step depends on the data alone (splitters are values picked by their hash), so
a recomputed task gives the same buckets again. The rows of such groups are written to the
scratch area first, so that their metrics are the same in every step, and so are the counted
values of each metric, which all further steps read instead of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.functions import rounded, year_month
from obs_engine.operators.joins import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    row_width,
)
from obs_engine.session import scratch_path

# A group up to this size is sorted in one task.
GROUP_ROWS = 2_000_000
# At most this many groups are cut up, and at most about this many splitters exist
# over all of them, so both tables may be broadcast whatever the input size: a group
# is cut up only above 1 / MAX_PIECES of all rows.
MAX_PIECES = 20_000
# Splitters are looked up in two steps: chunk of this length, then place in the chunk.
CHUNK = 64


def rank_metrics(
    df: DataFrame,
    partition: list[str],
    ranks: Mapping[str, str],
    *,
    group_rows: int = GROUP_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Add ``ranks[metric]`` for each metric: descending RANK per group, NULL first.

    Equal values share a rank and leave a gap after it. One small job counts the
    largest group first, to choose the plan.
    """
    sizes = df.groupBy(*partition).agg(F.count("*").alias("_rows"))
    total, largest, least = sizes.agg(F.sum("_rows"), F.max("_rows"), F.min("_rows")).first()
    cut = max(group_rows, (total or 0) // max_pieces)
    if (largest or 0) <= cut:
        return _rank_by_window(df, partition, ranks)

    # Written once: what follows reads the hot rows several times, the input but twice.
    hot = _written(
        sizes.where(F.col("_rows") > cut).select(*[F.col(p).alias(f"_hot_{p}") for p in partition]),
        "hot-groups",
    )
    is_hot = _same([F.col(p) for p in partition], [F.col(f"_hot_{p}") for p in partition])
    hot = F.broadcast(hot)  # fewer than total / cut <= max_pieces rows
    regular = _rank_by_window(df.join(hot, is_hot, "left_anti"), partition, ranks)
    hot_rows = _written(df.join(hot, is_hot, "left_semi"), "hot-rows")
    ranked = hot_rows
    for metric, name in ranks.items():
        values = _written(_value_counts(hot_rows, partition, metric), "hot-values")
        value_ranks = _value_ranks(values, partition, name, cut)
        # Few distinct values: rank the rows where they are. Else both sides are
        # shuffled; with one row per value on the right only the left can be skewed,
        # which adaptive execution splits.
        ranked = ranked.join(
            F.broadcast(value_ranks) if _are_few(values, partition) else value_ranks,
            _same(
                [*[F.col(p) for p in partition], F.col(metric)],
                [*[F.col(k) for k in _keys(partition)], F.col("_value")],
            ),
            "left",
        ).drop(*_keys(partition), "_value")
        # A metric that is computed anew may differ in its last bits: no row may vanish.
        missing = F.raise_error(F.lit(f"{metric} changed between two evaluations"))
        ranked = ranked.withColumn(
            name, F.when(F.col(name).isNull(), missing).otherwise(F.col(name))
        )
    return ranked if least > cut else regular.unionByName(ranked)  # all groups may be hot


def _written(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _rank_by_window(df: DataFrame, partition: list[str], ranks: Mapping[str, str]) -> DataFrame:
    return df.withColumns(
        {
            name: F.rank()
            .over(Window.partitionBy(*partition).orderBy(F.col(metric).desc_nulls_first()))
            .cast("long")
            for metric, name in ranks.items()
        }
    )


def _keys(partition: list[str]) -> list[str]:
    return [f"_key_{i}" for i in range(len(partition))]


def _are_few(values: DataFrame, partition: list[str]) -> bool:
    """Whether the counted values may be broadcast."""
    width = row_width(values.select(*_keys(partition), "_value"))
    rows, widest = values.agg(F.count("*"), F.max(width)).first()
    return rows <= MAX_BROADCAST_ROWS and rows * (widest or 0) <= MAX_BROADCAST_BYTES


def _value_counts(df: DataFrame, partition: list[str], metric: str) -> DataFrame:
    """Rows of each distinct (group, value of the metric)."""
    groups = [F.col(p).alias(k) for p, k in zip(partition, _keys(partition))]
    return df.groupBy(*groups, F.col(metric).alias("_value")).agg(F.count("*").alias("_rows"))


def _value_ranks(values: DataFrame, partition: list[str], name: str, cut: int) -> DataFrame:
    """The rank ``name`` of each counted value in its group."""
    keys = _keys(partition)
    # One value in `cut`, so a bucket holds about `cut` distinct values.
    picked = F.col("_value").isNotNull() & (
        F.pmod(F.xxhash64(*keys, "_value"), F.lit(cut)) == 0
    )
    splitters = (
        values.where(picked)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_value"), asc=False).alias("_splitters"))
        .select(*[F.col(k).alias(f"_s{k}") for k in keys], _in_chunks("_splitters"))
    )
    bucketed = values.join(
        F.broadcast(splitters),
        _same([F.col(k) for k in keys], [F.col(f"_s{k}") for k in keys]),
        "left",
    ).select(*keys, "_value", "_rows", _splitters_above("_value").alias("_bucket"))

    # One row per bucket: no more than splitters plus groups.
    higher = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.sum("_rows").alias("_bucket_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_bucket_rows").over(higher), F.lit(0)))
        .select(*[F.col(k).alias(f"_o{k}") for k in keys], F.col("_bucket").alias("_o_bucket"), "_offset")
    )
    above = Window.partitionBy(*keys, "_bucket").orderBy(
        F.col("_value").desc_nulls_first()
    ).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.withColumn("_above", F.coalesce(F.sum("_rows").over(above), F.lit(0)))
        .join(
            F.broadcast(offsets),
            _same(
                [*[F.col(k) for k in keys], F.col("_bucket")],
                [*[F.col(f"_o{k}") for k in keys], F.col("_o_bucket")],
            ),
        )
        .select(*keys, "_value", (F.lit(1) + F.col("_offset") + F.col("_above")).alias(name))
    )


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)])


def _in_chunks(splitters: str) -> Column:
    chunk = F.lit(CHUNK)
    count = F.ceil(F.size(splitters) / chunk).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.slice(F.col(splitters), i * chunk + 1, chunk),
    ).alias("_chunks")


def _splitters_above(value: str) -> Column:
    """Number of splitters greater than the value; 0 without splitters or for NULL."""
    v, chunks = F.col(value), F.col("_chunks")
    chunk = F.size(F.filter(chunks, lambda c: c[0] > v))
    inside = F.size(F.filter(F.element_at(chunks, chunk), lambda s: s > v))
    return F.when(chunks.isNull() | v.isNull() | (chunk == 0), 0).otherwise(
        (chunk - 1) * CHUNK + inside
    )


# Output columns of the daily and monthly rank tables.
DAILY_RANKS = {
    "max_temp_celcius": "rank_of_city_max_temp_by_day",
    "min_temp_celcius": "rank_of_city_min_temp_by_day",
    "max_wind_kph": "rank_of_city_max_wind_kph_by_day",
    "total_rain_mm": "rank_of_city_total_rain_mm_by_day",
}
MONTHLY_METRICS = {
    "avg_max_temp_celcuis_by_month": (F.avg, "max_temp_celcius"),
    "avg_min_temp_celcuis_by_month": (F.avg, "min_temp_celcius"),
    "avg_max_wind_kph_by_month": (F.avg, "max_wind_kph"),
    "total_rain_mm_by_month": (F.sum, "total_rain_mm"),
}
MONTHLY_RANKS = {
    "avg_max_temp_celcuis_by_month": "rank_of_city_avg_max_temp_by_month",
    "avg_min_temp_celcuis_by_month": "rank_of_city_avg_min_temp_by_month",
    "avg_max_wind_kph_by_month": "rank_of_city_avg_max_wind_kph_by_month",
    "total_rain_mm_by_month": "rank_of_city_total_rain_mm_by_month",
}


def _interleaved(ranks: Mapping[str, str]) -> list[str]:
    return [c for pair in ranks.items() for c in pair]


def rank_metrics_by_day(df: DataFrame, **options: int) -> DataFrame:
    """Cities ranked per day by each metric; the day stays text."""
    daily = df.select(F.col("date").alias("day"), "city", *DAILY_RANKS)
    ranked = rank_metrics(daily, ["day"], DAILY_RANKS, **options)
    return ranked.select("day", "city", *_interleaved(DAILY_RANKS))


def monthly_metrics(df: DataFrame) -> DataFrame:
    """Mean temperatures and wind and total rain per (month, city), to 2 places."""
    return df.groupBy(year_month("date").alias("year_month"), "city").agg(
        *[rounded(f(c)).alias(name) for name, (f, c) in MONTHLY_METRICS.items()]
    )


def rank_metrics_by_month(df: DataFrame, **options: int) -> DataFrame:
    """Cities ranked per month by the rounded metrics, so ties are frequent."""
    ranked = rank_metrics(monthly_metrics(df), ["year_month"], MONTHLY_RANKS, **options)
    return ranked.select("year_month", "city", *_interleaved(MONTHLY_RANKS))
