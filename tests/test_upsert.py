"""Upsert rules: frames, tables, and repeated or concurrent forms of a batch."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obs_engine.operators import latest_per_key, merge_frames, merged_in_one_pass
from obs_engine.session import scratch_path, scratch_root
from obs_engine.sources import publish, tables
from obs_engine.sources import (
    MONTH,
    Period,
    append_once,
    overwrite_table,
    read_table,
    table_exists,
    upsert_table,
)

SCHEMA = "city string, date string, m double, note string"
KEYS = ["city", "date"]


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def stored(spark, path):
    rows = read_table(spark, path).select(*KEYS, "m", "note").collect()
    return sorted(tuple(r) for r in rows)


def files(spark, path, month=""):
    return {f for f in read_table(spark, path).inputFiles() if f"year_month={month}" in f}


OLD = [("a", "2022-10-01", 5.0, "x"), ("b", "2022-10-01", 6.0, "y"), ("a", "2022-11-01", 7.0, "z")]


@pytest.mark.parametrize("small_batch", [True, False])
def test_merge_rules(spark, small_batch):
    batch = frame(spark, ("a", "2022-10-01", None, "x2"), ("c", "2022-10-01", 1.0, None))
    merged = merge_frames(frame(spark, *OLD), batch, KEYS, small_batch=small_batch)
    assert merged.columns == ["city", "date", "m", "note"]
    assert sorted(map(tuple, merged.collect())) == [
        ("a", "2022-10-01", None, "x2"),  # NULL replaces
        ("a", "2022-11-01", 7.0, "z"),
        ("b", "2022-10-01", 6.0, "y"),
        ("c", "2022-10-01", 1.0, None),
    ]


@pytest.mark.parametrize("small_batch", [True, False])
def test_merge_missing_column(spark, small_batch):
    batch = frame(
        spark,
        ("a", "2022-10-01", 9),
        ("c", "2022-10-01", 1),
        schema="city string, date string, m int",
    )
    merged = merge_frames(frame(spark, *OLD), batch, KEYS, small_batch=small_batch)
    rows = {tuple(r)[:2]: tuple(r)[2:] for r in merged.collect()}
    assert rows["a", "2022-10-01"] == (9.0, "x")  # kept, and cast to the table's type
    assert rows["c", "2022-10-01"] == (1.0, None)


def test_merge_unknown_column(spark):
    with pytest.raises(ValueError, match="extra"):
        merge_frames(frame(spark, *OLD), frame(spark, *OLD).withColumn("extra", F.lit(1)), KEYS)


def test_latest_per_key(spark):
    batch = frame(
        spark,
        ("a", "d", 1.0, "1"),
        ("a", "d", 2.0, "3"),
        ("a", "d", 3.0, "2"),
        ("b", "d", 4.0, None),
    )
    got = latest_per_key(batch, KEYS, seq="note")
    assert got.columns == ["city", "date", "m"]
    assert sorted(map(tuple, got.collect())) == [("a", "d", 2.0), ("b", "d", 4.0)]
    for options in ({}, {"seq": "note", "strict": True}):
        with pytest.raises(PySparkException, match="duplicate key"):
            latest_per_key(batch, KEYS, **options).collect()
    with pytest.raises(PySparkException, match="NULL in key"):
        latest_per_key(frame(spark, ("a", None, 1.0, "1")), KEYS, seq="note").collect()


def test_table(spark, folder):
    path = f"{folder}/t"
    assert not table_exists(spark, path)
    first = upsert_table(spark, path, frame(spark, *OLD), KEYS)
    assert first.rows == 3 and first.periods == ["2022-10", "2022-11"]
    assert stored(spark, path) == sorted(OLD)

    november = files(spark, path, "2022-11")
    update = frame(spark, ("a", "2022-10-01", float("nan"), "n"))
    done = upsert_table(spark, path, update, KEYS)
    assert done.rows == 1 and done.periods == ["2022-10"]
    after = [("a", "2022-10-01", None, "n"), *OLD[1:]]  # NaN came in as NULL
    assert stored(spark, path) == sorted(after)
    # The other month was not touched.
    assert files(spark, path, "2022-11") == november

    upsert_table(spark, path, update, KEYS)
    assert stored(spark, path) == sorted(after)  # twice is once

    before = files(spark, path)
    upsert_table(spark, path, frame(spark, ("z", "2022-10-09", 1.0, "new")), KEYS)
    assert stored(spark, path) == sorted([*after, ("z", "2022-10-09", 1.0, "new")])
    # Only new keys: the files before are still there.
    assert before < files(spark, path)

    nothing = upsert_table(spark, path, frame(spark), KEYS)
    assert nothing.rows == 0 and nothing.periods == []


def test_table_appends_missing_columns_as_null(spark, folder):
    path = f"{folder}/t"
    upsert_table(spark, path, frame(spark, *OLD), KEYS)
    narrow = frame(spark, ("q", "2022-12-01"), schema="city string, date string")
    upsert_table(spark, path, narrow, KEYS)
    assert ("q", "2022-12-01", None, None) in stored(spark, path)


def test_table_duplicates(spark, folder):
    schema = SCHEMA + ", seq int"
    batch = frame(
        spark,
        ("a", "2022-10-01", 1.0, "first", 1),
        ("a", "2022-10-01", 2.0, "second", 2),
        schema=schema,
    )
    path = f"{folder}/t"
    with pytest.raises(ValueError, match="duplicate"):
        upsert_table(spark, path, batch, KEYS, seq="seq", strict=True)
    with pytest.raises(ValueError, match="duplicate"):
        upsert_table(spark, path, batch.drop("seq"), KEYS)
    assert not table_exists(spark, path)
    assert upsert_table(spark, path, batch, KEYS, seq="seq").rows == 1
    assert stored(spark, path) == [("a", "2022-10-01", 2.0, "second")]


def test_table_null_key(spark, folder):
    with pytest.raises(ValueError, match="NULL"):
        upsert_table(spark, f"{folder}/t", frame(spark, (None, "2022-10-01", 1.0, "x")), KEYS)


def test_period_must_come_from_keys(spark, folder):
    by_note = Period("note_period", lambda: F.col("note"))
    with pytest.raises(PySparkException):
        upsert_table(spark, f"{folder}/t", frame(spark, *OLD), KEYS, period=by_note)


def test_table_without_periods(spark, folder):
    path = f"{folder}/t"
    for rows in (OLD, [("a", "2022-10-01", 0.0, "o")], [("n", "2022-10-01", 0.0, "o")]):
        upsert_table(spark, path, frame(spark, *rows), KEYS, period=None)
    assert stored(spark, path) == sorted(
        [("a", "2022-10-01", 0.0, "o"), ("n", "2022-10-01", 0.0, "o"), *OLD[1:]]
    )


class Stop(Exception):
    """The driver is lost."""


def stopping_after(monkeypatch, calls):
    """Renames and deletions of a publish stop after so many."""
    left = [calls]

    def counted(real):
        def run(spark, *paths):
            if left[0] == 0:
                raise Stop
            left[0] -= 1
            return real(spark, *paths)

        return run

    for name in ("rename", "delete"):
        monkeypatch.setattr(f"obs_engine.sources.publish.{name}", counted(getattr(publish, name)))
    return left


@pytest.mark.parametrize("period", [None, MONTH])
@pytest.mark.parametrize("small", [100_000, 0])
def test_interrupted_upsert(spark, folder, monkeypatch, period, small):
    """Wherever a call stops, a retry gives the table of an uninterrupted one."""
    monkeypatch.setattr("obs_engine.sources.publish.RENAMES_AT_ONCE", 1)
    batch = frame(spark, ("a", "2022-10-01", 0.0, "o"), ("n", "2022-11-03", 1.0, "n"), ("n", "2022-12-01", 2.0, "n"))
    options = {"period": period, "small_batch_rows": small}
    upsert_table(spark, f"{folder}/whole", frame(spark, *OLD), KEYS, period=period)
    upsert_table(spark, f"{folder}/whole", batch, KEYS, **options)
    wanted = stored(spark, f"{folder}/whole")
    calls, stops = 0, 0
    while True:
        path = f"{folder}/t{calls}"
        upsert_table(spark, path, frame(spark, *OLD), KEYS, period=period)
        with monkeypatch.context() as patched:
            left = stopping_after(patched, calls)
            try:
                upsert_table(spark, path, batch, KEYS, **options)
            except Stop:
                stops += 1
        done = left[0] > 0
        upsert_table(spark, path, batch, KEYS, **options)
        assert stored(spark, path) == wanted, calls
        if done:
            break
        calls += 3
    assert stops >= 2


def test_interrupted_overwrite(spark, folder, monkeypatch):
    """An overwrite leaves the old rows or the new ones, once the next writer is through."""
    monkeypatch.setattr("obs_engine.sources.publish.RENAMES_AT_ONCE", 1)
    old, new = frame(spark, *OLD), frame(spark, ("z", "2022-12-01", 1.0, "new"))
    with_period = [df.withColumn("year_month", MONTH.of()) for df in (old, new)]
    seen = set()
    for calls in range(0, 14, 2):
        path = f"{folder}/t{calls}"
        overwrite_table(with_period[0], path, period="year_month")
        with monkeypatch.context() as patched:
            stopping_after(patched, calls)
            try:
                overwrite_table(with_period[1], path, period="year_month")
            except Stop:
                pass
        publish.finish(spark, path)
        rows = stored(spark, path)
        assert rows in (sorted(OLD), [("z", "2022-12-01", 1.0, "new")])
        seen.add(len(rows))
    assert seen == {1, 3}


@pytest.mark.parametrize("small", [100_000, 0])
@pytest.mark.parametrize("period", [None, MONTH])
def test_forbidden_batch_leaves_the_table(spark, folder, period, small):
    path = f"{folder}/t"
    upsert_table(spark, path, frame(spark, *OLD), KEYS, period=period)
    before = files(spark, path)
    twice = frame(spark, OLD[0], OLD[0], ("new", "2022-10-05", 1.0, "n"))
    with pytest.raises(ValueError, match="1 duplicate"):
        upsert_table(spark, path, twice, KEYS, period=period, small_batch_rows=small)
    assert files(spark, path) == before and stored(spark, path) == sorted(OLD)


def test_new_keys_only_add_files(spark, folder):
    path = f"{folder}/t"
    upsert_table(spark, path, frame(spark, *OLD), KEYS)
    before = files(spark, path)
    for number, small in enumerate((100_000, 0)):
        batch = frame(spark, (f"new{number}", "2022-10-05", 1.0, "n"))
        done = upsert_table(spark, path, batch, KEYS, small_batch_rows=small)
        assert done.rows == 1 and before < files(spark, path)
        before = files(spark, path)


@pytest.mark.parametrize("small", [100_000, 0])
def test_an_upsert_is_few_jobs_and_one_shuffle_of_each_side(spark, folder, small):
    path = f"{folder}/t"
    wide = spark.range(2000).selectExpr(
        "concat('c', id) as city", "'2022-10-01' as date", "cast(id as double) as m", "'n' as note"
    )
    upsert_table(spark, path, wide, KEYS)
    spark.sparkContext.setJobGroup(f"upsert-{small}", "jobs of one upsert")
    try:
        upsert_table(spark, path, wide.where("m >= 1000").union(frame(spark, OLD[0])), KEYS, small_batch_rows=small)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"upsert-{small}")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 12
    stored_rows = read_table(spark, path).drop("year_month")
    batch = latest_per_key(stored_rows, KEYS, counted=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = merged_in_one_pass(stored_rows, batch, KEYS)
        text = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


def test_many_small_batches_leave_few_files(spark, folder):
    path = f"{folder}/t"
    upsert_table(spark, path, frame(spark, ("z", "2022-09-01", 1.0, "x")), KEYS)
    untouched = files(spark, path, "2022-09")
    for k in range(20):
        upsert_table(spark, path, frame(spark, (f"c{k}", "2022-10-01", float(k), "x")), KEYS)
    assert len(files(spark, path, "2022-10")) <= tables.CROWDED_FILES
    assert read_table(spark, path).count() == 21
    assert files(spark, path, "2022-09") == untouched
    assert tables.compact_table(spark, path, MONTH, files_max=0, order=KEYS) == ["2022-10"]
    assert len(files(spark, path, "2022-10")) == 1 and read_table(spark, path).count() == 21


def test_columns_are_added_and_widened(spark, folder):
    path = f"{folder}/t"
    upsert_table(spark, path, frame(spark, ("a", "2022-10-01", 1), schema="city string, date string, m int"), KEYS)
    wider = frame(spark, ("b", "2022-10-01", 2.5, "new"), ("a", "2022-11-01", 3.5, None))
    with pytest.raises(ValueError, match="note"):
        upsert_table(spark, path, wider, KEYS)
    upsert_table(spark, path, wider, KEYS, evolve=True)
    assert stored(spark, path) == [("a", "2022-10-01", 1.0, None), ("a", "2022-11-01", 3.5, None), ("b", "2022-10-01", 2.5, "new")]
    upsert_table(spark, path, frame(spark, ("a", "2022-10-01", 7), schema="city string, date string, m int"), KEYS)
    assert stored(spark, path)[0] == ("a", "2022-10-01", 7.0, None)
    with pytest.raises(ValueError, match="m is double"):
        text = frame(spark, ("a", "2022-10-01", "x"), schema="city string, date string, m string")
        upsert_table(spark, path, text, KEYS, evolve=True)


def test_append_once(spark, folder):
    path = f"{folder}/t"
    rows = frame(spark, ("a", None, 1.0, "x"), ("b", "d", 2.0, "y"), ("b", "d", 2.0, "y"))
    assert append_once(rows, path, ["city", "date"]) == 2
    assert append_once(rows, path, ["city", "date"]) == 0
    assert append_once(frame(spark, ("a", "d", 1.0, "x")), path, ["city", "date"]) == 1
    assert read_table(spark, path).count() == 3


def test_hot_key(spark, folder):
    """One key with a third of the batch."""
    batch = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('c', id) end as city",
        "'2022-10-01' as date",
        "cast(id as double) as m",
        "'n' as note",
        "id as seq",
    )
    path = f"{folder}/t"
    assert upsert_table(spark, path, batch, KEYS, seq="seq").rows == 2001
    assert read_table(spark, path).where("city = 'hot'").select("m").collect() == [(2997.0,)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session)
    Session.conf.get = staticmethod(lambda key, default: "hdfs://shared/")
    assert scratch_root(Session) == "hdfs://shared"


def test_too_many_periods_to_list(spark, folder, monkeypatch):
    monkeypatch.setattr("obs_engine.sources.tables.MAX_PERIODS", 1)
    path = f"{folder}/t"
    upsert_table(spark, path, frame(spark, *OLD), KEYS)
    done = upsert_table(spark, path, frame(spark, *[(c, d, 0.0, "o") for c, d, *_ in OLD]), KEYS)
    assert done.periods is None
    assert {r[2] for r in stored(spark, path)} == {0.0}


def test_overwrite(spark, folder):
    path = f"{folder}/t"
    monthly = frame(spark, *OLD).withColumn("year_month", MONTH.of())
    assert overwrite_table(monthly, path, period="year_month") == 3
    october = monthly.where("year_month = '2022-10'").limit(1)
    assert overwrite_table(october, path, period="year_month", only_periods=True) == 1
    assert read_table(spark, path).count() == 2
    assert overwrite_table(october, path, period="year_month") == 1
    assert read_table(spark, path).count() == 1
    assert overwrite_table(monthly.limit(0), f"{folder}/empty", order=KEYS) == 0
    assert read_table(spark, f"{folder}/empty").count() == 0


KEY = st.tuples(st.sampled_from("abc"), st.sampled_from(["2022-10-01", "2022-10-02", "2022-11-01"]))
BATCH = st.dictionaries(KEY, st.one_of(st.none(), st.floats(-10, 10)), max_size=6)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(old=BATCH, new=BATCH, small=st.booleans())
def test_like_a_dictionary(spark, old, new, small):
    def rows(d):
        return frame(spark, *[(*k, v, None) for k, v in d.items()])

    merged = merge_frames(rows(old), rows(new), KEYS, small_batch=small)
    assert {(r[0], r[1]): r[2] for r in merged.collect()} == old | new


def test_disjoint_batches_in_any_order(spark):
    one = frame(spark, OLD[0], ("c", "2022-12-01", 1.0, None))
    other = frame(spark, *OLD[1:])
    results = []
    for batches in ((one, other), (other, one)):
        path = scratch_path(spark, "order")
        for batch in batches:
            upsert_table(spark, path, batch, KEYS)
        results.append(stored(spark, path))
    assert results[0] == results[1]
