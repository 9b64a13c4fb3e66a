"""Exact duplicates by two passes with a Bloom filter, in DataFrame functions only.

Pass one counts hits of filter positions, two for each row, and keeps the positions hit
more than once as bitmaps. Pass two looks each row up: a row with an unrepeated position
has no equal, so it goes straight through; only the others shuffle. Counting shuffles
positions (eight bytes, combined before the shuffle), never texts.

The filter has a fixed largest size. Tables with more rows are split by hash into
classes, written once by class, and each class gets a filter of its own, one after
another; so what is broadcast is bounded at any size of the table.

Defined results: null text counts as empty. A null id comes after all others; of rows
with equal text and equal id one stays. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import column, fresh, materialise

POSITIONS_PER_ROW = 8  # for each of the two hashes: one row in 64 is taken for repeated
ROWS_PER_FILTER = 1 << 25  # so a filter has 64 MB at most


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_hash(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _positions(digest: Column, size: int) -> list[Column]:
    """A position in each half of the filter, from 1 on."""
    return [
        F.pmod(F.xxhash64(digest, F.lit(half)), F.lit(size)) + F.lit(half * size + 1)
        for half in (0, 1)
    ]


def _has(bits: Column, position: Column) -> Column:
    """Whether a bitmap, null without any bit, has the bit of a position."""
    at = F.bitmap_bit_position(position).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, at.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1))
    return F.coalesce(bit == 1, F.lit(False))


def _flag_class(rows: DataFrame, count: int) -> DataFrame:
    """Add ``repeated``: false only where no other row has the digest."""
    size = 1 << max(10, (max(count, 1) * POSITIONS_PER_ROW - 1).bit_length())
    hits = rows.select(F.explode(F.array(*_positions(F.col("digest"), size))).alias("position"))
    twice = hits.groupBy("position").count().where("count > 1")
    bitmaps = twice.groupBy(F.bitmap_bucket_number("position").alias("place")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bits")
    )
    out = rows
    for half, position in enumerate(_positions(F.col("digest"), size)):
        named = bitmaps.select(F.col("place").alias(f"place{half}"), F.col("bits").alias(f"bits{half}"))
        out = out.join(
            F.broadcast(named),  # at most 2 * size bits
            F.bitmap_bucket_number(position) == F.col(f"place{half}"),
            "left",
        ).withColumn(f"seen{half}", _has(F.col(f"bits{half}"), position))
        out = out.drop(f"place{half}", f"bits{half}")
    return out.withColumn("repeated", F.col("seen0") & F.col("seen1")).drop("seen0", "seen1")


def _by_class(
    df: DataFrame, build: Callable[[DataFrame], DataFrame], rows_per_filter: int
) -> DataFrame:
    """``build`` over the flagged rows of ``df``, class by class if one filter is too small."""
    total = df.count()
    classes = max(1, -(-total // rows_per_filter))
    if classes == 1:
        return build(_flag_class(materialise(df, "dedup-rows"), total))
    chosen = F.pmod(F.xxhash64("digest", F.lit("class")), F.lit(classes)).cast("int")
    name = fresh(df, "dedup_class")[0]
    by_class = materialise(df.withColumn(name, chosen), "dedup-classes", name)
    found = None
    for k in range(classes):  # one after another: one filter is broadcast at a time
        part = by_class.where(F.col(name) == k).drop(name)
        part = materialise(build(_flag_class(part, rows_per_filter)), "dedup-class")
        found = part if found is None else found.unionByName(part)
    return found


def _kept(repeated: DataFrame) -> DataFrame:
    """For each digest: the row that stays and the number of rows."""
    return repeated.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tag")).alias("first"),
        F.count(F.lit(1)).alias("group_size"),
    )


def mark_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_per_filter: int = ROWS_PER_FILTER,
) -> DataFrame:
    """One row for each row of ``df``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    rows = df.select(
        column(df, id_column).alias("id"),
        text_hash(column(df, text_column)).alias("digest"),
        F.monotonically_increasing_id().alias("tag"),
    )
    return _by_class(rows, lambda flagged: _marked(flagged, id_column), rows_per_filter)


def _marked(flagged: DataFrame, id_column: str) -> DataFrame:
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    alone = flagged.where(~F.col("repeated")).select(
        F.col("id").alias(id_column),
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        digest,
    )
    repeated = flagged.where("repeated")
    # Written first: a join of two plain exchanges can have a large group split, one with
    # an aggregate on a side cannot.
    kept = materialise(_kept(repeated), "dedup-groups")
    groups = repeated.join(kept, "digest").select(
        F.col("id").alias(id_column),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("tag") == F.col("first.tag")).alias("kept"),
        digest,
    )
    return alone.unionByName(groups)


def drop_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_per_filter: int = ROWS_PER_FILTER,
) -> DataFrame:
    """``df`` with one row of each group of equal texts, all columns as they were.

    Rows that the filter passes are not shuffled; of the rest, the rows that stay are
    found by their tag.
    """
    rows = df.select(
        F.struct(*[column(df, c) for c in df.columns]).alias("row"),
        column(df, id_column).alias("id"),
        text_hash(column(df, text_column)).alias("digest"),
        F.monotonically_increasing_id().alias("tag"),
    )
    return _by_class(rows, _dropped, rows_per_filter).select("row.*")


def _dropped(flagged: DataFrame) -> DataFrame:
    repeated = flagged.where("repeated")
    stays = _kept(repeated).select("first.tag")
    return flagged.where(~F.col("repeated")).unionByName(repeated.join(stays, "tag", "left_semi"))
