"""Upsert semantics as DataFrame operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine.functions import quoted


def latest_per_key(
    batch: DataFrame,
    keys: list[str],
    seq: str | None = None,
    strict: bool = False,
    counted: bool = False,
) -> DataFrame:
    """One row per key: the one with the greatest ``seq``, which is then dropped.

    A NULL key raises. Two rows with the same key raise when ``strict``, or when there
    is no ``seq`` to say which of them is last. The aggregate combines before the
    shuffle, so a key repeated in much of the batch stays harmless. ``counted`` adds how
    many rows a key had as ``_rows`` and raises on nothing; the keys are then those of the
    exchange, so a join by them needs no other.
    """
    rest = [c for c in batch.columns if c not in keys and c != seq]
    order = [F.col(quoted(seq)).alias("_seq")] if seq else []
    row = F.struct(*order, *[F.col(quoted(c)) for c in rest])
    last = batch.groupBy(*map(quoted, keys)).agg(
        F.max(row).alias("_row"), F.count("*").alias("_rows")
    )
    any_null = reduce(lambda a, b: a | b, [F.col(quoted(k)).isNull() for k in keys])
    checked = F.when(any_null, F.raise_error(F.lit(f"NULL in key {keys}")))
    if (strict or seq is None) and not counted:
        checked = checked.when(
            F.col("_rows") > 1, F.raise_error(F.lit(f"duplicate key {keys} in batch"))
        )
    first_key = F.col(quoted(keys[0]))
    return last.select(
        first_key if counted else checked.otherwise(first_key).alias(keys[0]),
        *[F.col(quoted(k)) for k in keys[1:]],
        *[F.col(f"_row.{quoted(c)}").alias(c) for c in rest],
        *(["_rows"] if counted else []),
    )


def aligned(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """``df`` with the columns and types of ``schema`` and ``more`` of its own.

    What it does not have is NULL.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(quoted(f.name)) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ],
        *more,
    )


def _as_new(batch: DataFrame, keys: list[str], types: dict, **more: Column) -> DataFrame:
    """Keys, and all else in a struct ``_new`` that is never NULL, so that it marks the batch."""
    measures = [c for c in batch.columns if c not in (*keys, "_rows")]
    return batch.select(
        *[F.col(quoted(k)).cast(types[k]).alias(k) for k in keys],
        F.struct(
            F.lit(True).alias("_in_batch"),
            *[c.alias(name) for name, c in more.items()],
            *[F.col(quoted(c)).cast(types[c]).alias(c) for c in measures],
        ).alias("_new"),
    )


def _resolved(existing: DataFrame, batch: DataFrame, keys: list[str]) -> list[Column]:
    """The columns of ``existing``, taken from ``_new`` where it has them."""

    def resolved(c: str) -> Column:
        if c in keys or c not in batch.columns:
            return F.col(quoted(c))
        taken = F.col(f"_new.{quoted(c)}")
        return F.when(F.col("_new").isNotNull(), taken).otherwise(F.col(quoted(c))).alias(c)

    return [resolved(c) for c in existing.columns]


def _types(existing: DataFrame, batch: DataFrame) -> dict:
    unknown = set(batch.columns) - set(existing.columns) - {"_rows"}
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    return {f.name: f.dataType for f in existing.schema}


def merge_frames(
    existing: DataFrame,
    batch: DataFrame,
    keys: list[str],
    small_batch: bool = False,
    inserts: bool = True,
) -> DataFrame:
    """``existing`` with ``batch`` merged in; both must have unique, non-NULL keys.

    A matched key takes every non-key column of the batch, NULLs included; columns the
    batch does not have keep their value. Unmatched rows of either side are kept; without
    ``inserts`` those of the batch are not.

    The general plan is one full outer join. ``small_batch`` is for a batch the caller
    has counted to be small: it is broadcast, which leaves ``existing`` unshuffled. The
    result is the same.
    """
    new = _as_new(batch, keys, _types(existing, batch))
    projection = _resolved(existing, batch, keys)
    if not small_batch:
        return existing.join(new, keys, "full" if inserts else "left").select(*projection)

    updated = existing.join(F.broadcast(new), keys, "left").select(*projection)
    if not inserts:
        return updated
    # No more keys than the batch has.
    matched = F.broadcast(matched_keys(existing, new, keys, small_batch))
    names = [c for c in batch.columns if c not in keys]
    inserted = new.join(matched, keys, "left_anti").select(
        *[F.col(quoted(k)) for k in keys], *[F.col(f"_new.{quoted(c)}").alias(c) for c in names]
    )
    return updated.unionByName(inserted, allowMissingColumns=True)


def merged_in_one_pass(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``merge_frames`` with what an upsert has to know of each row.

    ``batch`` is that of ``latest_per_key`` with counts. ``_matched``: a stored row that the
    batch replaces; ``_added``: one that only the batch has; ``_times``: how often the batch
    had its key. The batch is grouped by the keys of the join, so it is shuffled once.
    """
    new = _as_new(batch, keys, _types(existing, batch), _times=F.col("_rows"))
    stored = existing.withColumn("_stored", F.lit(True))
    joined = stored.join(new, keys, "full")
    in_batch = F.col("_new").isNotNull()
    return joined.select(
        *_resolved(existing, batch, keys),
        (in_batch & F.col("_stored").isNotNull()).alias("_matched"),
        F.col("_stored").isNull().alias("_added"),
        F.coalesce(F.col("_new._times"), F.lit(0)).alias("_times"),
    )


def matched_keys(
    existing: DataFrame, batch: DataFrame, keys: list[str], small_batch: bool = False
) -> DataFrame:
    """The keys of ``existing`` that are in the batch."""
    names = [F.col(quoted(k)) for k in keys]
    wanted = batch.select(*names)
    return existing.select(*names).join(
        F.broadcast(wanted) if small_batch else wanted, keys, "left_semi"
    )
