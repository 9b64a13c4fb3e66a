"""The incremental load as a stream of arriving documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obs_engine.operators.shaping import raw_or_rejected, raw_weather
from obs_engine.plans.loading import build_models, put_aside
from obs_engine.schemas import RAW_WEATHER_KEYS
from obs_engine.session import scratch_path
from obs_engine.sources.documents import ARRIVED_AT
from obs_engine.sources.tables import MONTH, Period, upsert_table


def start_weather_upsert(
    documents: DataFrame,
    root: str,
    checkpoint: str,
    *,
    serve: bool = False,
    grain: Period = MONTH,
    processing_time: str | None = None,
    set_aside: bool = False,
) -> StreamingQuery:
    """Upsert each micro-batch of weather documents into ``raw_historic``.

    The checkpoint takes the place of the mark. A micro-batch repeated after a failure,
    a late day or a corrected one is absorbed by the key. With ``serve`` the models are
    rebuilt for the periods of the batch; ``start_month_states`` keeps monthly counts and
    means without that. Without ``processing_time`` the stream stops when all documents that
    have arrived are loaded. A document without days stops the stream; with ``set_aside`` it
    goes to ``raw_rejected``, once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch_rows(batch, root, set_aside)
        done = upsert_table(
            spark, f"{root}/raw_historic", rows, RAW_WEATHER_KEYS, period=grain, seq=ARRIVED_AT
        )
        if serve and done.rows:
            build_models(spark, root, done.periods, grain)

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(processing_time))
        .start()
    )


def trigger_of(processing_time: str | None) -> dict:
    return {"processingTime": processing_time} if processing_time else {"availableNow": True}


def batch_rows(batch: DataFrame, root: str, set_aside: bool) -> DataFrame:
    """The raw rows of a micro-batch; documents without days raise or are put aside."""
    if not set_aside:
        return raw_weather(batch)
    spark = batch.sparkSession
    path = scratch_path(spark, "stream-rows")
    raw_or_rejected(batch).write.parquet(path)
    rows = spark.read.parquet(path)
    put_aside(spark, root, rows, "stream", dt.date.today())
    return rows.where(F.col("_rejected").isNull()).drop("_rejected")
