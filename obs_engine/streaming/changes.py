"""Monthly states kept up to date by the changes that each micro-batch makes.

The upsert writes what it is about to change as rows with the sign -1 (as they were) and +1 (as
they will be). They are added to the stored states, so a corrected day is counted once and no
month is read again. Changes are written before the table is touched and the states remember
the last batch added to them, so a batch repeated after a stop is neither lost nor counted twice.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obs_engine.functions import quoted
from obs_engine.operators.states import add_states, month_states
from obs_engine.plans.staging import STAGED_COLUMNS
from obs_engine.schemas import RAW_WEATHER_KEYS
from obs_engine.sources.documents import ARRIVED_AT
from obs_engine.sources.publish import delete, exists, write_text
from obs_engine.sources.tables import (
    MONTH,
    Period,
    last_token,
    read_table,
    replace_periods,
    table_exists,
    upsert_table,
)
from obs_engine.streaming.upserts import batch_rows, trigger_of

STATES = "state_months"


def fold_states(spark: SparkSession, path: str, delta: DataFrame, token: str | None = None) -> bool:
    """Add states to the stored ones; only their months are read and rewritten.

    ``token`` is ``name-number``; numbers of a name that are not above the last one added are
    known, and nothing is done.
    """
    name, _, number = (token or "").rpartition("-")
    last_name, _, last = (last_token(spark, path) or "").rpartition("-")
    if token and name == last_name and int(number) <= int(last):
        return False
    months = sorted(r[0] for r in delta.select("year_month").distinct().collect())
    parts = [delta]
    if table_exists(spark, path):
        stored = read_table(spark, path)
        parts.append(stored.where(F.col("year_month").isin(months)))
    replace_periods(add_states(*parts), path, "year_month", months, order=["city"], token=token)
    return True


def apply_batch(
    spark: SparkSession, root: str, rows: DataFrame, token: str, grain: Period = MONTH
) -> None:
    """Upsert raw rows and add their changes to the states of months; repeatable by token."""
    changes = f"{root}/_changes/{token}"
    known = exists(spark, f"{changes}.done")
    done = upsert_table(
        spark,
        f"{root}/raw_historic",
        rows,
        RAW_WEATHER_KEYS,
        period=grain,
        seq=ARRIVED_AT if ARRIVED_AT in rows.columns else None,
        changes_to=None if known else changes,
        before_change=None if known else lambda _: write_text(spark, f"{changes}.done", ""),
    )
    if done.rows:
        signed = spark.read.parquet(changes)
        columns = [F.col(quoted(c)).alias(n) for c, n in STAGED_COLUMNS.items() if c in signed.columns]
        states = month_states(signed.select(*columns, "_sign"), "_sign")
        fold_states(spark, f"{root}/{STATES}", states, token)
    delete(spark, f"{changes}.done")
    delete(spark, changes)


def start_month_states(
    documents: DataFrame,
    root: str,
    checkpoint: str,
    *,
    grain: Period = MONTH,
    processing_time: str | None = None,
    set_aside: bool = False,
) -> StreamingQuery:
    """Upsert each micro-batch into ``raw_historic`` and keep ``state_months`` beside it.

    Read the states with ``metrics_of_states`` and ``counts_of_states``. The table must get no
    rows in another way. See ``start_weather_upsert`` for ``set_aside``.
    """
    name = sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch_rows(batch, root, set_aside)
        apply_batch(batch.sparkSession, root, rows, f"{name}-{batch_id}", grain)

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(processing_time))
        .start()
    )
