"""Exact token counts of a corpus from the histogram of encoded lengths.

Documents are encoded once and aggregated by length; texts and ids go nowhere. Sums from
the longest length down then answer, for every context limit that changes anything, how
many documents and tokens are within it. Suffix sums are taken in two steps, over blocks of
lengths and within each block, so no task gets the whole histogram.

Defined results: null text counts as empty, an empty text has length zero; repeated rows
count each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import column, in_tasks, materialise
from obs_engine.llm.encoding import default_tokenizer, encoder

BLOCK = 1024


def encoded_lengths(
    df: DataFrame, text_column: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """``tokens`` of each row."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            lengths = [len(encode(t.as_py() or "")) // 4 for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["tokens"])

    return in_tasks(df.select(column(df, text_column).alias("text")), run, "tokens long")


def length_histogram(
    df: DataFrame, text_column: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """``tokens`` and ``documents`` of that length."""
    return (
        encoded_lengths(df, text_column, tokenizer)
        .groupBy("tokens")
        .agg(F.count(F.lit(1)).alias("documents"))
    )


def limits(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length as a context limit, exact figures.

    ``documents`` of the length, ``documents_above`` and ``tokens_above`` the limit,
    ``documents_total``, ``tokens_total``, ``quantile`` (share of documents within the
    limit), ``tokens_truncated_total`` (tokens that stay if longer documents are cut).
    """
    rows = materialise(
        histogram.withColumn("block", F.floor(F.col("tokens") / block)), "token-histogram"
    )
    sums = rows.groupBy("block").agg(
        F.sum("documents").alias("d"), F.sum(F.col("documents") * F.col("tokens")).alias("t")
    )
    # One row for each block of lengths, so few, however many documents there are.
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    totals = sums.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_d"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_t"),
        F.sum("d").over(every).alias("documents_total"),
        F.sum("t").over(every).alias("tokens_total"),
    )
    longer = (
        Window.partitionBy("block")
        .orderBy(F.col("tokens").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def above(value: Column, later_blocks: str) -> Column:
        return F.coalesce(F.sum(value).over(longer), F.lit(0)) + F.col(later_blocks)

    found = rows.join(totals, "block").select(
        "tokens",
        "documents",
        above(F.col("documents"), "later_d").alias("documents_above"),
        above(F.col("documents") * F.col("tokens"), "later_t").alias("tokens_above"),
        "documents_total",
        "tokens_total",
    )
    return found.select(
        F.col("tokens").alias("context_limit"),
        "documents",
        "documents_above",
        "tokens_above",
        "documents_total",
        "tokens_total",
        (1 - F.col("documents_above") / F.col("documents_total")).alias("quantile"),
        (
            F.col("tokens_total") - F.col("tokens_above") + F.col("documents_above") * F.col("tokens")
        ).alias("tokens_truncated_total"),
    )


def token_counts(
    df: DataFrame, text_column: str = "text", tokenizer: str | None = None
) -> DataFrame:
    return limits(length_histogram(df, text_column, tokenizer))
