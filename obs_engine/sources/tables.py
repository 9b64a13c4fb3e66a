"""Parquet tables by path: overwrite, append, rebuild by period, upsert by key, compaction."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from hashlib import sha256
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine.functions import day_of, quoted, year_month, year_of
from obs_engine.operators.merge import (
    aligned,
    latest_per_key,
    matched_keys,
    merge_frames,
    merged_in_one_pass,
)
from obs_engine.operators.shaping import nan_to_null, widened
from obs_engine.session import scratch_root
from obs_engine.sources.publish import (
    COLUMNS,
    TOKEN,
    delete,
    entries,
    exists,
    finish,
    location,
    prepared,
    publish,
    read_text,
    rename,
)

# A batch within both limits is broadcast to the table, else they are both shuffled.
SMALL_BATCH_ROWS = 100_000
SMALL_BATCH_BYTES = 16 * 1024 * 1024
# A batch over this many periods is merged with the whole table instead of a
# partition list; the list goes through the driver and into the plan.
MAX_PERIODS = 5_000
# A period of more files than this, and smaller ones than that, is written anew.
CROWDED_FILES = 16
FILE_BYTES = 64 * 1024 * 1024


# Fixed value: the name Spark gives the folder of a NULL partition value.
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Period:
    """A partition column computed from the day of a row, by default column ``date``.

    ``per_month`` and ``per_year`` give the part of its value that tells the month (as
    ``month_value`` of ``yyyy-MM``) and the year, so that filters on those still prune.
    """

    name: str
    of: Callable[..., Column]
    per_month: Callable[[Column], Column] = lambda c: c
    per_year: Callable[[Column], Column] = lambda c: c
    month_value: Callable[[str], str | int] = lambda month: month

    def in_months(self, months: list[str]) -> Column:
        return self.per_month(F.col(self.name)).isin([self.month_value(m) for m in months])

    def in_years(self, years: list[int]) -> Column:
        return self.per_year(F.col(self.name)).isin(years)


# Partitions of up to some gigabytes are a good size. Months suit small tables; one with
# terabytes per month should use days, so that a daily load rewrites a day.
MONTH = Period(
    "year_month",
    lambda day="date": year_month(day),
    per_year=lambda c: F.substring(c, 1, 4).cast("int"),
)
DAY = Period(
    "day_key",
    lambda day="date": F.date_format(day_of(day), "yyyyMMdd").cast("int"),
    per_month=lambda c: F.floor(c / 100).cast("int"),
    per_year=lambda c: F.floor(c / 10_000).cast("int"),
    month_value=lambda month: int(month.replace("-", "")),
)
YEAR = Period("year", lambda day="date": year_of(day))


@dataclass(frozen=True)
class Upsert:
    """What an upsert did: rows of the batch, and periods rewritten (None: all)."""

    rows: int
    periods: list | None = field(default_factory=list)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there any data? What only a failed first write left behind does not count."""
    return bool(entries(spark, path))


def _stored_bytes(spark: SparkSession, path: str) -> int:
    files, place = location(spark, path)
    return files.getContentSummary(place).getLength()


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a table whose files do not all have them; None if they do."""
    kept = f"{path}/{COLUMNS}"
    return T.StructType.fromJson(json.loads(read_text(spark, kept))) if exists(spark, kept) else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table; columns that came later are NULL in older ones."""
    schema = stored_schema(spark, path)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _laid_out(
    df: DataFrame, period: str | None, order: Sequence[str], spread: bool = True
) -> DataFrame:
    """Evenly sized output files, rows in ``order`` inside each file.

    Rebalancing splits a period that is larger than a file should be and packs small
    ones together, so neither a hot period nor many tiny ones hurt the write. Rows read
    from files that are well laid out already need no ``spread``.
    """
    if spread:
        df = df.hint("rebalance", period) if period else df.hint("rebalance")
    order = [*([period] if period else []), *(c for c in order if c != period)]
    return df.sortWithinPartitions(*map(quoted, order)) if order else df


def _write(df: DataFrame, path: str, *partition_by: str, drop: Sequence[str] = (), **counts: Column) -> dict:
    """Write rows and return counts taken in the writing tasks, ``rows`` among them.

    Columns to ``drop`` are only counted.
    """
    seen = Observation()
    counts = {"rows": F.count(F.lit(1)), **counts}
    counted = df.observe(seen, *[c.alias(name) for name, c in counts.items()]).drop(*drop)
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get


def overwrite_table(
    df: DataFrame,
    path: str,
    *,
    period: str | None = None,
    order: Sequence[str] = (),
    only_periods: bool = False,
    spread: bool = True,
    before_change: Callable[[list[str]], None] | None = None,
) -> int:
    """Replace the table, or with ``only_periods`` just the periods found in ``df``.

    Returns the rows written, counted while writing. The table is touched when all new files
    are there, and ``before_change`` is told the names of the new folders or files; a stop in
    between is finished by the next writer.
    """
    spark = df.sparkSession
    folder = prepared(spark, path)
    layout = [period] if period else []
    rows = _write(_laid_out(df, period, order, spread), f"{folder}/rows", *layout)["rows"]
    if rows == 0 and period and not only_periods:
        # A table without partitions would have no file to tell its columns.
        nothing = df.drop(period).limit(0)
        nothing.write.mode("overwrite").parquet(f"{folder}/rows/{period}={NO_PERIOD}")
    if before_change:
        before_change(list(entries(spark, f"{folder}/rows")))
    if only_periods:
        publish(spark, path)
    else:
        publish(spark, path, list(entries(spark, path)), columns="")
    return rows


def replace_periods(
    df: DataFrame,
    path: str,
    period: str,
    periods: Sequence,
    *,
    order: Sequence[str] = (),
    token: str | None = None,
) -> int:
    """Replace the given periods by the rows of ``df``; one without rows is gone.

    ``token`` is stored with them, in one step, see ``last_token``.
    """
    spark = df.sparkSession
    folder = prepared(spark, path)
    rows = _write(_laid_out(df, period, order), f"{folder}/rows", period)["rows"]
    there = set(entries(spark, path)) | set(entries(spark, f"{folder}/rows"))
    gone = {f"{period}={p}" for p in periods}
    if there <= gone and not entries(spark, f"{folder}/rows"):
        nothing = df.drop(period).limit(0)
        nothing.write.mode("overwrite").parquet(f"{folder}/rows/{period}={NO_PERIOD}")
    publish(spark, path, sorted(gone), token=token)
    return rows


def last_token(spark: SparkSession, path: str) -> str | None:
    """What the last ``replace_periods`` with a token stored with its rows."""
    finish(spark, path)
    kept = f"{path}/{TOKEN}"
    return read_text(spark, kept) if exists(spark, kept) else None


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a table, which is created by the first append."""
    df.write.mode("append").parquet(path)


def append_once(df: DataFrame, path: str, token: Sequence[str]) -> int:
    """Append the rows whose ``token`` columns no stored row has; their number.

    So an append repeated after a stop adds nothing. NULL in a token equals NULL.
    """
    spark = df.sparkSession
    new = df.dropDuplicates(list(token))
    if table_exists(spark, path):
        known = read_table(spark, path).select(*[F.col(quoted(c)).alias(f"_known_{c}") for c in token])
        same = [F.col(quoted(c)).eqNullSafe(F.col(quoted(f"_known_{c}"))) for c in token]
        new = new.join(known, reduce(lambda a, b: a & b, same), "left_anti")
    seen = Observation()
    append_rows(new.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    *,
    period: Period | None = MONTH,
    seq: str | None = None,
    strict: bool = False,
    small_batch_rows: int = SMALL_BATCH_ROWS,
    evolve: bool = False,
    before_change: Callable[[list | None], None] | None = None,
    changes_to: str | None = None,
) -> Upsert:
    """Insert or update the rows of ``batch`` by key; the first upsert creates the table.

    ``period`` must be computed from key columns, so that a key never changes period:
    only periods found in the batch are read and rewritten. NaN becomes NULL. See
    ``latest_per_key`` for duplicates and ``merge_frames`` for what a match replaces. With
    ``evolve`` columns that the table does not have are added to it, NULL in other rows, and
    numeric ones widened. ``before_change`` is told the periods before the table is touched.
    Before that, what changes is written to ``changes_to``: rows as they were with ``_sign``
    -1, and as they will be with 1.

    The batch is written to the scratch area first and read from there, so it is the
    same rows in every step, whatever tasks are repeated. Then one pass merges it with the
    rows stored in its periods and counts matches and repeated keys while it writes: what
    the counts forbid is not published, and a batch without a match only adds files. A
    batch counted to be small is broadcast instead, so that the table is not shuffled, and
    periods not stored yet are not merged at all. One writer per table at a time; a batch
    repeated after a failure gives the same table, wherever the first call stopped.
    """
    scratch = f"{scratch_root(spark)}/obs_engine/upsert-{sha256(path.encode()).hexdigest()[:16]}"
    layout = [period.name] if period else []
    if period:
        batch.select(*map(quoted, keys)).select(period.of())  # raises on any other column
        batch = batch.withColumn(period.name, period.of())
        keys = [*keys, period.name]

    folder = prepared(spark, path)
    any_null = reduce(or_, [F.col(quoted(k)).isNull() for k in keys])
    batch = nan_to_null(batch)
    facts = _write(batch, f"{scratch}/batch", nulls=F.count_if(any_null))
    if facts["rows"] == 0:
        return Upsert(0)
    if facts["nulls"]:
        raise ValueError(f"{facts['nulls']} rows with NULL in key {keys}")
    # With its schema given, reading what was just written takes no job.
    staged = spark.read.schema(batch.schema).parquet(f"{scratch}/batch")
    periods = periods_of(staged, period) if period else None

    there = table_exists(spark, path)
    wider = None
    if there:
        old = read_table(spark, path)
        if evolve:
            wider = widened(old.schema, staged.drop(*[seq] if seq else []).schema)
            wider = None if wider == old.schema else wider
            old = aligned(old, wider) if wider else old
        unknown = set(staged.columns) - {seq} - set(old.columns)
        if unknown:
            raise ValueError(f"columns not in the table: {sorted(unknown)}")
    stored = stored_periods(spark, path, period) if there and period else None

    def check(repeated: int) -> None:
        if repeated and (strict or seq is None):
            delete(spark, folder)
            raise ValueError(f"{repeated} duplicate keys {keys} in batch")

    def lay(df: DataFrame, spread: bool = True) -> DataFrame:
        return _laid_out(df, period.name if period else None, keys, spread)

    unique = latest_per_key(staged, keys, seq, counted=True)
    repeated = F.count_if(F.col("_rows") > 1)
    small = (
        facts["rows"] <= small_batch_rows
        and _stored_bytes(spark, f"{scratch}/batch") <= SMALL_BATCH_BYTES
    )
    matched = 0
    if not there or (stored is not None and periods is not None and not stored & set(periods)):
        new = lay(aligned(unique, old.schema, "_rows") if there else unique)
        found = _write(new, f"{folder}/added", *layout, drop=["_rows"], repeated=repeated)
        check(found["repeated"])
        rows = found["rows"]
    else:
        if periods is not None:
            old = old.where(F.col(period.name).isin(periods))
        if small:
            found = _write(unique, f"{scratch}/unique", repeated=repeated)
            check(found["repeated"])
            rows = found["rows"]
            unique = spark.read.schema(unique.schema).parquet(f"{scratch}/unique").drop("_rows")
            met = matched_keys(old, unique, keys, small_batch=True)
            matched = _write(met, f"{scratch}/matched")["rows"]
            new = unique
            if matched:
                # Around a broadcast the table's own files are mapped to new ones.
                kept = merge_frames(old, unique, keys, small_batch=True, inserts=False)
                _write(lay(kept, spread=not period), f"{folder}/rows", *layout)
                met = spark.read.schema(met.schema).parquet(f"{scratch}/matched")
                new = unique.join(F.broadcast(met), keys, "left_anti")  # no more keys than the batch
            _write(lay(aligned(new, old.schema).coalesce(1), spread=False), f"{folder}/added", *layout)
        else:
            found = _write(
                lay(merged_in_one_pass(old, unique, keys)),
                f"{folder}/both",
                "_added",
                *layout,
                drop=["_matched", "_times"],
                matched=F.count_if(F.col("_matched")),
                inserted=F.count_if(F.col("_added")),
                repeated=F.count_if(F.col("_times") > 1),
            )
            check(found["repeated"])
            matched, rows = found["matched"], found["matched"] + found["inserted"]
            if matched:  # otherwise what is stored stays as it is
                rename(spark, f"{folder}/both/_added=false", f"{folder}/rows")
            if found["inserted"]:
                rename(spark, f"{folder}/both/_added=true", f"{folder}/added")

    if changes_to:
        unique = unique.drop("_rows")
        after = aligned(unique, old.schema) if there else unique
        changes = after.withColumn("_sign", F.lit(1))
        if matched:
            met = F.broadcast(unique) if small else unique
            before = old.join(met.select(*map(quoted, keys)), keys, "left_semi")
            after = merge_frames(before, unique, keys)
            was = before.withColumn("_sign", F.lit(-1))
            changes = was.unionByName(after.withColumn("_sign", F.lit(1)))
        changes.write.mode("overwrite").parquet(changes_to)
    if before_change:
        before_change(periods)
    # Without periods all stored files are replaced, if any row is.
    gone = list(entries(spark, path)) if matched and not period else []
    publish(spark, path, gone, json.dumps(wider.jsonValue()) if wider else None)
    _compact_touched(spark, path, period, periods, keys)
    return Upsert(rows, periods)


def _crowded(spark: SparkSession, path: str, files_max: int) -> bool:
    """More small files than a folder should have; one large file is never a reason."""
    files, place = location(spark, path)
    if not files.exists(place):
        return False
    sizes = sorted(e.getLen() for e in files.listStatus(place) if e.isFile())
    needed = -(-sum(sizes) // FILE_BYTES)
    return len(sizes) > files_max and len(sizes) > 2 * needed


def _compact_touched(
    spark: SparkSession, path: str, period: Period | None, periods: list | None, keys: list[str]
) -> None:
    if period is None:
        compact_table(spark, path, order=keys)
    elif periods is not None:
        compact_table(spark, path, period, periods, order=keys)


def compact_table(
    spark: SparkSession,
    path: str,
    period: Period | None = None,
    periods: Sequence | None = None,
    *,
    order: Sequence[str] = (),
    files_max: int = CROWDED_FILES,
) -> list:
    """Write periods of many small files anew, in few; those rewritten are returned.

    Rows are packed into files of about the advisory size of a partition. ``periods`` (all
    stored ones, if not given) are looked at; others are not touched. A table without a
    period is one folder.
    """
    finish(spark, path)
    if period is None:
        if not _crowded(spark, path, files_max):
            return []
        overwrite_table(read_table(spark, path), path, order=order)
        return [None]
    looked_at = stored_periods(spark, path, period) or set() if periods is None else periods
    crowded = sorted(p for p in looked_at if _crowded(spark, f"{path}/{period.name}={p}", files_max))
    if crowded:
        rows = read_table(spark, path).where(F.col(period.name).isin(crowded))
        overwrite_table(rows, path, period=period.name, order=order, only_periods=True)
    return crowded


def periods_of(df: DataFrame, period: Period) -> list | None:
    """The distinct periods, or None if they are too many to list."""
    found = df.select(period.name).distinct().limit(MAX_PERIODS + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= MAX_PERIODS else None


def stored_periods(spark: SparkSession, path: str, period: Period) -> set | None:
    """The periods of a table by its folders, without a job; None if too many to list."""
    values = period_values(entries(spark, path), period)
    return values if len(values) <= MAX_PERIODS else None


def period_values(folders: Iterable[str], period: Period) -> set:
    """The periods that names of folders tell."""
    values = {n.removeprefix(f"{period.name}=") for n in folders if n.startswith(f"{period.name}=")}
    values.discard(NO_PERIOD)
    return {int(v) if v.isdigit() else v for v in values}


def drop_periods(spark: SparkSession, path: str, period: Period, gone: set) -> None:
    """Delete whole periods of a table; a table left without any stays readable."""
    if not gone:
        return
    nothing = read_table(spark, path).drop(period.name).limit(0)
    for value in sorted(gone):
        delete(spark, f"{path}/{period.name}={value}")
    if not table_exists(spark, path):
        nothing.write.mode("overwrite").parquet(f"{path}/{period.name}={NO_PERIOD}")
