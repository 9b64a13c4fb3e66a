"""What several operators share: scratch tables, free column names, Python in tasks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import obs_engine

from obs_engine.session import scratch_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers of a session, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(obs_engine.__file__).parent
    archive = Path(tempfile.mkdtemp()) / "obs_engine.zip"  # read by this driver, then served
    with zipfile.ZipFile(archive, "w") as file:
        for source in package.rglob("*.py"):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def in_tasks(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def materialise(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what follows reads files that all executors share, so a lost
    executor costs its running tasks only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and all."""
    return df[f"`{name}`"]


def bucket_of(key: Column, buckets: int) -> Column:
    """crc32 of the decimal text of a key, modulo ``buckets``; null counts as empty."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % buckets).cast("int")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(location, True)
