"""Folders where documents land, read once: what was loaded is kept in a ledger of files."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine.sources.documents import FILE, read_weather
from obs_engine.sources.tables import append_once, read_table, table_exists

KNOWN_BY = ["path", "modified", "size"]
# More new files than this are not listed in the plan; the folder is read and filtered.
MAX_FILES = 50_000


@dataclass(frozen=True)
class Landing:
    """A folder of weather documents of which a load takes the files not loaded yet.

    ``lateness`` bounds the listing to files modified since the latest loaded one less that
    span; without it files of any age are found. ``mode`` and ``fields`` are those of
    ``read_weather``.
    """

    path: str
    lateness: dt.timedelta | None = None
    mode: str = "FAILFAST"
    fields: T.StructType | str | None = None


@dataclass(frozen=True)
class Unread:
    """Documents of files not loaded yet, and those files; ``documents`` is None without any."""

    files: DataFrame
    documents: DataFrame | None = field(default=None)


def landed_files(
    spark: SparkSession, path: str, since: dt.datetime | None = None
) -> DataFrame:
    """``path``, ``modified``, ``size`` and ``file`` (as documents name it) of a folder's files.

    None of them is opened.
    """
    reader = spark.read.format("binaryFile")
    if since is not None:
        zone = spark.conf.get("spark.sql.session.timeZone")
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", zone)
    return reader.load(path).select(
        "path",
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
        F.col("_metadata.file_path").alias(FILE),
    )


def unread(spark: SparkSession, landing: Landing, ledger: str) -> Unread:
    """The files of a landing folder that the ledger does not have, as they are now.

    A file that was written again has another time or size, and counts as a new one.
    """
    since = None
    known = None
    if table_exists(spark, ledger):
        known = read_table(spark, ledger).select(*KNOWN_BY)
        latest = known.agg(F.max("modified")).first()[0]
        if landing.lateness is not None and latest is not None:
            since = latest - landing.lateness
            known = known.where(F.col("modified") >= F.lit(since))
    files = landed_files(spark, landing.path, since)
    options = {"mode": landing.mode, "fields": landing.fields, "file": True}
    if known is None:
        return Unread(files, read_weather(spark, landing.path, **options))
    files = files.join(known, KNOWN_BY, "left_anti")
    paths = [r["path"] for r in files.select("path").limit(MAX_FILES + 1).collect()]
    if not paths:
        return Unread(files)
    if len(paths) <= MAX_FILES:
        return Unread(files, read_weather(spark, paths, **options))
    # The time of a file is known without opening it, so old ones are still not read.
    oldest = files.agg(F.min("modified")).first()[0]
    documents = read_weather(spark, landing.path, since=oldest, **options)
    named = files.select(F.col(FILE).alias("_new"))
    return Unread(files, documents.join(named, F.col(FILE) == F.col("_new"), "left_semi"))


def mark_read(files: DataFrame, ledger: str, **about: str) -> int:
    """Add files to the ledger, once each; how many were new."""
    rows = files.select(*KNOWN_BY, *[F.lit(v).alias(k) for k, v in about.items()])
    return append_once(rows, ledger, KNOWN_BY)
