"""Readers of landed JSON documents (one document per line), batch and stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine.operators.shaping import widened
from obs_engine.schemas import POPULATION, WEATHER


# Arrival time of a document; the later of two documents for one key wins.
ARRIVED_AT = "arrived_at"
# Which file a document is from.
FILE = "file"
# All fields that documents have, found by reading them.
FOUND = "found"


def _with_arrival(documents: DataFrame, file: bool = False) -> DataFrame:
    more = [F.col("_metadata.file_path").alias(FILE)] if file else []
    return documents.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED_AT), *more)


def weather_schema(more: T.StructType) -> T.StructType:
    """The fields the models use, and ``more`` ones anywhere in a document."""
    return widened(WEATHER, more)


def read_weather(
    spark: SparkSession,
    path: str | Sequence[str],
    mode: str = "FAILFAST",
    fields: T.StructType | str | None = None,
    since: dt.datetime | None = None,
    file: bool = False,
) -> DataFrame:
    """Historic or forecast weather documents with their arrival time.

    A malformed document fails the read, so that no day is lost unseen; with the mode
    ``DROPMALFORMED`` it is left out. ``fields`` is a schema of further fields to keep beside
    those the models use; ``FOUND`` keeps all that the documents have, which reads them twice.
    ``since`` leaves files modified before it unopened, ``file`` adds the file of a document.
    """
    reader = spark.read
    if since is not None:
        # The option is exclusive and in whole seconds.
        before = (since - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
        zone = spark.conf.get("spark.sql.session.timeZone")
        reader = reader.option("modifiedAfter", before).option("timeZone", zone)
    paths = path if isinstance(path, str) else list(path)
    if fields == FOUND:
        fields = reader.option("mode", mode).json(paths).schema
    schema = WEATHER if fields is None else weather_schema(fields)
    documents = reader.schema(schema).option("mode", mode).json(paths)
    return _with_arrival(documents, file)


def read_population(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return spark.read.schema(POPULATION).option("mode", mode).json(path)


def stream_weather(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """The same documents as a stream of arriving files."""
    reader = spark.readStream.schema(WEATHER).option("mode", mode)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_arrival(reader.json(path))
