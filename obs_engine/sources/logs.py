"""The high-water-mark log (CSV) and the run ledger (Parquet)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.operators.incremental import high_water_mark
from obs_engine.schemas import INCREMENT_LOG, RUN_LEDGER
from obs_engine.sources.tables import append_rows, read_table, table_exists

# Run states in the ledger.
STARTED, COMPLETED, ERROR = "Started", "Completed", "Error"


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INCREMENT_LOG).option("header", True).csv(path)


def append_marks(marks: DataFrame, path: str) -> None:
    """Append (log_date, incremental_value) rows; the first append creates the log."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in INCREMENT_LOG]
    marks.select(*columns).write.mode("append").option("header", True).csv(path)


def last_mark(spark: SparkSession, path: str) -> str | None:
    """The greatest mark, None for an empty or missing log."""
    if not table_exists(spark, path):
        return None
    return high_water_mark(read_marks(spark, path)).first()["mark"]


def advance_mark(
    spark: SparkSession, path: str, loaded: DataFrame, day: str, log_date: dt.date | str
) -> str | None:
    """Log the greatest day of the rows just loaded; nothing for an empty load.

    Call it after the load has been committed, so a failed load is tried again. A row that
    the log has already is not appended again.
    """
    mark = high_water_mark(loaded, day).where("mark is not null")
    value = mark.first()
    if value is None:
        return None
    row = spark.createDataFrame([(str(log_date), str(value["mark"]))], INCREMENT_LOG)
    if table_exists(spark, path):
        row = row.join(read_marks(spark, path), row.columns, "left_anti")
    if not row.isEmpty():
        append_marks(row.coalesce(1), path)
    return str(value["mark"])


def next_run_id(ledger: DataFrame) -> DataFrame:
    """One row, ``run_id``: the greatest id plus one, 1 for an empty ledger."""
    return ledger.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).alias("run_id"))


def new_run_id(spark: SparkSession, path: str) -> int:
    if not table_exists(spark, path):
        return 1
    return next_run_id(read_table(spark, path)).first()["run_id"]


def append_run(
    spark: SparkSession,
    path: str,
    run_id: int,
    status: str,
    config: dict,
    log: str = "",
    timestamp: dt.datetime | None = None,
) -> None:
    when = (timestamp or dt.datetime.now(dt.timezone.utc)).isoformat(sep=" ")
    row = (when, run_id, status, json.dumps(config, sort_keys=True, default=str), log)
    append_rows(spark.createDataFrame([row], RUN_LEDGER).coalesce(1), path)


def latest_status(ledger: DataFrame, when: str = "run_timestamp") -> DataFrame:
    """The last state of each run. States of the same instant: the greatest text."""
    return ledger.groupBy("run_id").agg(
        F.max_by("run_status", F.struct(when, "run_status")).alias("run_status")
    )
