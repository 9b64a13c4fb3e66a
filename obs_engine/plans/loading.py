"""One load: raw tables, the models over them, the mark and the run ledger.

Tables are Parquet folders below ``root``. Models are rebuilt only for the periods a
load touched; that gives the same tables as rebuilding them whole.
"""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obs_engine.functions import quoted
from obs_engine.operators.activities import activity_flags
from obs_engine.operators.incremental import Day, window_bounds
from obs_engine.operators.intervals import (
    days_to_intervals,
    merge_intervals,
    outside_intervals,
    subtract_intervals,
)
from obs_engine.operators.joins import MAX_BROADCAST_ROWS
from obs_engine.operators.selection import top_entities
from obs_engine.operators.shaping import (
    nan_to_null,
    raw_or_rejected,
    raw_population,
)
from obs_engine.plans.serving import SERVING_MODELS
from obs_engine.plans.staging import stage, unify
from obs_engine.schemas import RAW_WEATHER_KEYS
from obs_engine.session import scratch_path
from obs_engine.sources.documents import ARRIVED_AT, FILE
from obs_engine.sources.journal import forget, note, pending
from obs_engine.sources.landing import Landing, mark_read, unread
from obs_engine.sources.logs import (
    COMPLETED,
    ERROR,
    STARTED,
    advance_mark,
    append_run,
    last_mark,
    new_run_id,
)
from obs_engine.sources.publish import entries, finish
from obs_engine.sources.tables import (
    append_once,
    DAY,
    MONTH,
    YEAR,
    Period,
    drop_periods,
    overwrite_table,
    period_values,
    read_table,
    stored_periods,
    table_exists,
    upsert_table,
)

RUN_LEDGER_TABLE = "pipeline_logs"
INCREMENT_LOG_TABLE = "historic_logs"
DAY_LEDGER = "loaded_days"
FILE_LEDGER = "loaded_files"
UNIFIED = "staging_historic_and_forecast"
STAGING = ["staging_historic", "staging_forecast", UNIFIED]


@dataclass(frozen=True)
class Served:
    """Where a serving model reads from and how its table is laid out.

    ``period`` is a column of the model, or None for a table with a row per
    observation, which is laid out by the period of the staging tables.
    """

    source: str
    period: Period | None
    order: tuple[str, ...]
    day: str = "date"


SERVED = {
    "serving_activities": Served(UNIFIED, None, ("city",)),
    "serving_rank_city_metrics_by_day": Served(UNIFIED, None, ("day",), day="day"),
    "serving_rank_city_metrics_by_month": Served(UNIFIED, MONTH, ("city",)),
    "serving_weather_condition_count_by_month": Served("staging_historic", MONTH, ("city",)),
    "serving_weather_condition_count_by_year": Served("staging_historic", YEAR, ("city",)),
}


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with the columns of its model, in the model's order."""
    stored = read_table(spark, f"{root}/{name}")
    own = SERVED[name].period if name in SERVED else None
    layout = own.name if own else next(p.name for p in (MONTH, DAY) if p.name in stored.columns)
    others = [F.col(quoted(c)) for c in stored.columns if c != layout]
    return stored.select(*([layout] if own else []), *others)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Make each table of ``root`` known to SQL under its own name."""
    tables = ["raw_cities", "raw_historic", "raw_forecast", RUN_LEDGER_TABLE]
    models = [*STAGING, *SERVED]
    known = []
    for name in [*tables, *models]:
        if table_exists(spark, f"{root}/{name}"):
            df = (read_model if name in models else _read)(spark, root, name)
            df.createOrReplaceTempView(name)
            known.append(name)
    return known


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/{name}")


def build_models(
    spark: SparkSession, root: str, periods: list | None = None, grain: Period = MONTH
) -> dict[str, int]:
    """Rebuild the staging and serving tables, all of them or the given periods.

    ``grain`` is the period the raw tables are laid out by. Tables by month or year are
    rebuilt for the months or years of the given periods. The partitions of a given
    period that no longer has any rows are deleted. Returns the rows written per table.
    """
    historic, forecast = f"{root}/raw_historic", f"{root}/raw_forecast"
    raw_historic = read_table(spark, historic) if table_exists(spark, historic) else None
    raw_forecast = read_table(spark, forecast) if table_exists(spark, forecast) else None
    if raw_historic is None and raw_forecast is None:
        return {}
    raw_historic = raw_historic if raw_historic is not None else raw_forecast.limit(0)
    raw_forecast = raw_forecast if raw_forecast is not None else raw_historic.limit(0)

    built = all(table_exists(spark, f"{root}/{name}") for name in [UNIFIED, *SERVED])
    stored: dict[str, set] = {}
    if periods is not None:
        past, coming = (stored_periods(spark, path, grain) for path in (historic, forecast))
        if not built or past is None or coming is None:
            periods = None
        else:
            stored = {"staging_historic": past, UNIFIED: past | coming}

    def part(df: DataFrame) -> DataFrame:
        return df if periods is None else df.where(F.col(grain.name).isin(periods))

    def write_staging(name: str, model: DataFrame, whole: bool) -> int:
        rows = overwrite_table(
            model.withColumn(grain.name, grain.of()),
            f"{root}/{name}",
            period=grain.name,
            order=["city", "date"],
            only_periods=periods is not None and not whole,
        )
        if periods is not None and not whole:
            drop_periods(spark, f"{root}/{name}", grain, set(periods) - stored[name])
        return rows

    def write_serving(name: str) -> int:
        served = SERVED[name]
        source = read_table(spark, f"{root}/{served.source}")
        if periods is None:
            return _write_model(SERVING_MODELS[name](source), root, name, grain)
        result = SERVING_MODELS[name](source.where(_touched(served.period, grain, periods)))
        rows = _write_model(result, root, name, grain, only_periods=True)
        left = _own_periods(served.period, stored[served.source])
        gone = _own_periods(served.period, periods) - left
        drop_periods(spark, f"{root}/{name}", served.period or grain, gone)
        return rows

    both = unify(part(raw_historic), part(raw_forecast))
    staging = {
        "staging_historic": partial(write_staging, model=stage(part(raw_historic)), whole=False),
        # A load replaces the forecast, so its former periods may be gone.
        "staging_forecast": partial(write_staging, model=stage(raw_forecast), whole=True),
        UNIFIED: partial(write_staging, model=both, whole=False),
    }
    return _all_written(staging) | _all_written(dict.fromkeys(SERVING_MODELS, write_serving))


def _all_written(writers: dict[str, Callable[[str], int]]) -> dict[str, int]:
    """Rows per table. The tables do not depend on each other, so no one waits."""
    with ThreadPoolExecutor(len(writers)) as pool:
        # The threads inherit the job group and the scheduler pool of this one.
        write = inheritable_thread_target(SparkSession.active())(lambda w: w[1](w[0]))
        return dict(zip(writers, pool.map(write, writers.items())))


def build_model(
    spark: SparkSession, root: str, name: str, source: DataFrame, grain: Period = MONTH
) -> int:
    """Rebuild one serving table over another source than its usual one.

    The indoor set of the activities is still that of all observations.
    """
    if name not in SERVING_MODELS:
        raise ValueError(f"there is no model {name}, only {sorted(SERVING_MODELS)}")
    if name == "serving_activities":
        everything = read_table(spark, f"{root}/{UNIFIED}")
        result = activity_flags(source, indoor_source=everything)
    else:
        result = SERVING_MODELS[name](source)
    return _write_model(result, root, name, grain)


def _write_model(
    result: DataFrame, root: str, name: str, grain: Period, only_periods: bool = False
) -> int:
    served = SERVED[name]
    if served.period is None:
        result = result.withColumn(grain.name, grain.of(served.day))
    return overwrite_table(
        result,
        f"{root}/{name}",
        period=(served.period or grain).name,
        order=served.order,
        only_periods=only_periods,
    )


def _touched(period: Period | None, grain: Period, periods: list) -> Column:
    """A filter on the partitions of ``grain`` that covers the table's own periods."""
    if period is None:
        return F.col(grain.name).isin(periods)
    months = sorted({_month_text(p) for p in periods})
    if period is MONTH:
        return grain.in_months(months)
    return grain.in_years(sorted({int(m[:4]) for m in months}))


def _own_periods(period: Period | None, values: list | set) -> set:
    """The months, years, or (None) same periods that given periods of the grain lie in."""
    if period is None:
        return set(values)
    months = {_month_text(v) for v in values}
    return months if period is MONTH else {int(m[:4]) for m in months}


def _month_text(period: str | int) -> str:
    text = str(period).replace("-", "")
    return f"{text[:4]}-{text[4:6]}"


def load(
    spark: SparkSession,
    root: str,
    *,
    as_of: Day | None = None,
    days_back: int = 365,
    cities: DataFrame | None = None,
    historic: DataFrame | Landing | None = None,
    forecast: DataFrame | Landing | None = None,
    grain: Period = MONTH,
    country: str | None = None,
    prefetch: int = 30,
    n: int = 10,
    set_aside: bool = False,
    evolve: bool = False,
) -> dict[str, int]:
    """Load the raw tables from landed documents, rebuild the models, advance the mark.

    ``cities`` are population documents and replace the city table; the other two are
    weather documents, cut to those cities if given, or a ``Landing`` folder, of which only
    files not loaded yet are opened. Historic days are those of the last ``days_back`` days
    before ``as_of`` (default: today), or since the mark if that is earlier, that are not
    loaded yet for their city; they are upserted. The forecast replaces the former one. Then
    the models are rebuilt for the periods touched, by this load or by one that was stopped
    before its models were. A root keeps one ``grain``. Returns the rows written per table.

    The city table has the ``n`` largest cities, of ``country`` if given, among the
    ``prefetch`` largest. A weather document without days is put in ``raw_rejected``, once,
    and fails the load that met it first; with ``set_aside`` the load goes on. Its days stay
    open, see ``open_days``, until another document brings them. ``evolve`` adds columns that
    the documents have and the raw tables have not.
    """
    as_of = as_of or dt.date.today()
    for name in entries(spark, root):
        finish(spark, f"{root}/{name}")  # what a stopped load had ready
    written = load_raw(
        spark,
        root,
        as_of=as_of,
        days_back=days_back,
        cities=cities,
        historic=historic,
        forecast=forecast,
        grain=grain,
        country=country,
        prefetch=prefetch,
        n=n,
        set_aside=set_aside,
        evolve=evolve,
    )
    rows = written.rows | build_pending(spark, root, grain)
    commit(spark, root, written, as_of, grain)
    return rows


@dataclass
class Raw:
    """What the first half of a load wrote, and what is recorded when the second is done."""

    rows: dict[str, int]
    loaded: list | None = field(default_factory=list)
    days: DataFrame | None = None
    files: list[tuple[str, DataFrame]] = field(default_factory=list)


def load_raw(
    spark: SparkSession,
    root: str,
    *,
    as_of: Day,
    days_back: int = 365,
    cities: DataFrame | None = None,
    historic: DataFrame | Landing | None = None,
    forecast: DataFrame | Landing | None = None,
    grain: Period = MONTH,
    country: str | None = None,
    prefetch: int = 30,
    n: int = 10,
    set_aside: bool = False,
    evolve: bool = False,
) -> Raw:
    """The raw tables of ``load``; the periods to rebuild are noted before a table changes."""
    done = Raw({})
    selected = None
    if cities is not None:
        path = f"{root}/raw_cities"
        records = raw_population(cities)
        if country is not None:
            records = records.where(F.col("country") == country)
        largest = top_entities(records, within=["country"], prefetch=prefetch, n=n)
        done.rows["raw_cities"] = overwrite_table(largest, path)
        selected = read_table(spark, path).select(F.col("city").alias("City_Name"))

    def staged(source: DataFrame | Landing | None, origin: str) -> DataFrame | None:
        """The raw rows of new documents, written once; documents without days are put aside."""
        documents = source
        if isinstance(source, Landing):
            new = unread(spark, source, f"{root}/{FILE_LEDGER}")
            documents = new.documents
            if documents is not None:
                done.files.append((origin, new.files))
        if documents is None:
            return None
        path = scratch_path(spark, f"load-{origin}")
        seen = Observation()
        count = F.count(F.col("_rejected")).alias("rejected")
        raw_or_rejected(documents).observe(seen, count).write.parquet(path)
        rows = spark.read.parquet(path)
        if seen.get["rejected"]:
            new = put_aside(spark, root, rows, origin, as_of)
            if new:
                done.rows["raw_rejected"] = done.rows.get("raw_rejected", 0) + new
                if not set_aside:
                    raise ValueError(f"document without days: {new} of {origin} in raw_rejected")
        if FILE in rows.columns:
            late = rows.where(F.col("date") >= str(as_of)).select(FILE).distinct()
            if origin == "historic":  # a file with days still to come is read again
                name, files = done.files.pop()
                done.files.append((name, files.join(late, FILE, "left_anti")))
        rows = rows.where(F.col("_rejected").isNull()).drop("_rejected", FILE)
        if selected is None:
            return rows
        wanted = F.broadcast(selected) if n <= MAX_BROADCAST_ROWS else selected
        return rows.join(wanted, "City_Name", "left_semi")

    rows = staged(historic, "historic")
    if rows is not None:
        mark = last_mark(spark, f"{root}/{INCREMENT_LOG_TABLE}")
        batch = _open_rows(spark, root, rows, mark, as_of, days_back)
        seq = ARRIVED_AT if ARRIVED_AT in batch.columns else None
        upsert = upsert_table(
            spark,
            f"{root}/raw_historic",
            batch,
            RAW_WEATHER_KEYS,
            period=grain,
            seq=seq,
            evolve=evolve,
            before_change=partial(note, spark, root),
        )
        done.rows["raw_historic"], done.loaded = upsert.rows, upsert.periods
        done.days = batch.select(*RAW_WEATHER_KEYS) if upsert.rows else None
    rows = staged(forecast, "forecast")
    if rows is not None:
        path = f"{root}/raw_forecast"
        before = stored_periods(spark, path, grain)
        done.rows["raw_forecast"] = overwrite_table(
            nan_to_null(rows.drop(ARRIVED_AT)).withColumn(grain.name, grain.of()),
            path,
            period=grain.name,
            order=RAW_WEATHER_KEYS,
            before_change=lambda after: note(
                spark, root, None if before is None else sorted(before | period_values(after, grain))
            ),
        )
    return done


def put_aside(spark: SparkSession, root: str, rows: DataFrame, origin: str, as_of: Day) -> int:
    """Append rejected documents that ``raw_rejected`` does not have; how many are new."""
    documents = rows.where(F.col("_rejected").isNotNull()).select(
        F.col("_rejected").alias("document"),
        F.sha2("_rejected", 256).alias("document_id"),
        F.lit(origin).alias("origin"),
        F.lit(str(as_of)).alias("as_of"),
    )
    return append_once(documents, f"{root}/raw_rejected", ["document_id", "origin"])


def _wanted(mark: str | None, as_of: Day, days_back: int) -> tuple[dt.date, dt.date]:
    """The days a load looks at: the last ``days_back``, more if the mark is older."""
    start, end = window_bounds(None, as_of, days_back)
    return (start if mark is None else min(start, window_bounds(mark, as_of, days_back)[0])), end


def loaded_days(spark: SparkSession, root: str) -> DataFrame | None:
    """Intervals of the days in ``raw_historic`` by city, None before the first load."""
    ledger, table = f"{root}/{DAY_LEDGER}", f"{root}/raw_historic"
    if table_exists(spark, ledger):
        return read_table(spark, ledger)
    if table_exists(spark, table):  # loaded before there was a ledger
        return days_to_intervals(read_table(spark, table), ["City_Name"], "date")
    return None


def _open_rows(
    spark: SparkSession, root: str, rows: DataFrame, mark: str | None, as_of: Day, days_back: int
) -> DataFrame:
    start, end = _wanted(mark, as_of, days_back)
    batch = rows.where((F.col("date") >= str(start)) & (F.col("date") < str(end)))
    loaded = loaded_days(spark, root)
    if loaded is None:
        return batch
    near = loaded.where(F.col("last_day") >= F.lit(start))
    return outside_intervals(batch, near, ["City_Name"], "date")


def open_days(
    spark: SparkSession, root: str, cities: DataFrame, *, as_of: Day, days_back: int = 365
) -> DataFrame:
    """The days of ``cities`` (``City_Name``) that are still to load, as intervals."""
    mark = last_mark(spark, f"{root}/{INCREMENT_LOG_TABLE}")
    start, end = _wanted(mark, as_of, days_back)
    wanted = cities.select(
        "City_Name",
        F.lit(start).alias("first_day"),
        F.lit(end - dt.timedelta(days=1)).alias("last_day"),
    ).where(F.col("first_day") <= F.col("last_day"))
    loaded = loaded_days(spark, root)
    return wanted if loaded is None else subtract_intervals(wanted, loaded, ["City_Name"])


def build_pending(spark: SparkSession, root: str, grain: Period = MONTH) -> dict[str, int]:
    """The second half of a load: models for all periods noted, whichever load noted them."""
    todo = pending(spark, root)
    if not todo.notes:
        return {}
    periods = None if todo.periods is None else sorted(todo.periods)
    written = build_models(spark, root, periods, grain)
    forget(spark, root, todo)
    return written


def commit(spark: SparkSession, root: str, done: Raw, as_of: Day, grain: Period = MONTH) -> None:
    """Record what was loaded: days, mark, files. Each step may be repeated after a stop."""
    if done.days is not None:
        _record_days(spark, root, done.days)
    if done.rows.get("raw_historic"):
        history = read_table(spark, f"{root}/raw_historic")
        if done.loaded is not None:
            history = history.where(F.col(grain.name).isin(sorted(done.loaded)))
        advance_mark(spark, f"{root}/{INCREMENT_LOG_TABLE}", history, "date", as_of)
    for origin, files in done.files:
        mark_read(files, f"{root}/{FILE_LEDGER}", origin=origin, as_of=str(as_of))


def _record_days(spark: SparkSession, root: str, days: DataFrame) -> None:
    new = days_to_intervals(days, ["City_Name"], "date")
    known = loaded_days(spark, root)
    both = new if known is None else known.unionByName(new)
    overwrite_table(merge_intervals(both, ["City_Name"]), f"{root}/{DAY_LEDGER}", order=["City_Name"])


def refresh(spark: SparkSession, root: str, **arguments) -> dict[str, int]:
    """``load`` with its start and its end recorded in the run ledger."""
    ledger = f"{root}/{RUN_LEDGER_TABLE}"
    run_id = new_run_id(spark, ledger)
    config = {
        k: v.name if isinstance(v, Period) else v
        for k, v in arguments.items()
        if not isinstance(v, DataFrame)
    }
    append_run(spark, ledger, run_id, STARTED, config)
    try:
        written = load(spark, root, **arguments)
    except Exception:
        append_run(spark, ledger, run_id, ERROR, config, traceback.format_exc())
        raise
    log = "\n".join(f"{table}: {n} rows" for table, n in written.items())
    append_run(spark, ledger, run_id, COMPLETED, config, log)
    return written
