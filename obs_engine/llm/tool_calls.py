"""Tool-call linking: calls and results joined by identifier, ordered, checked, serialised.

Calls and results meet in a hash join on conversation and identifier. A call may wait for the
results of any number of other calls of its conversation; its level is one more than the
highest of theirs. Ordering a conversation by level, turn and identifier puts each call behind
all it waits for. Levels are found by peeling: calls that wait for nothing unresolved are
resolved, again and again. A task does that for each conversation of at most ``TOGETHER``
calls and needs; a larger one is peeled by joins, one level in each round, so no task
ever holds it.

Arguments are checked against the schema of the tool (see ``schemas_json`` for the keywords; an
unknown one raises), and each link is one line of canonical JSON: keys sorted, no spaces, numbers
without a trailing fraction of zero.

Defined results: of repeated identifiers the first turn is linked, then the smaller name or
content; every further call or result comes out by itself with ``status`` ``repeated``; rows
with a null conversation or identifier with ``no_id``; a result without call is an ``orphan``, a
call without result ``unanswered``, a result before its call ``early``; calls that wait for each
other in a circle, or for one of these, have a null level; waiting for an unknown call is a
problem but no obstacle, waiting twice for one call is waiting once; null arguments or JSON that
can't be read is a problem; an empty table gives no rows. Columns that are not named don't count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import in_tasks, materialise
from obs_engine.llm.schemas_json import canonical, check_schema, problems, read_json

TOGETHER = 20_000
AT_ONCE = 10_000  # rows of a batch of results


def peeled(calls: list[str], needs: list[tuple[str, str]]) -> dict[str, int]:
    """Levels of the calls that are in no circle and wait for none; ``needs`` of known calls."""
    waiting: dict[str, list[str]] = {}
    left = dict.fromkeys(calls, 0)
    for call, need in needs:
        waiting.setdefault(need, []).append(call)
        left[call] += 1
    level = {call: 0 for call, n in left.items() if n == 0}
    queue = list(level)
    for call in queue:
        for other in waiting.get(call, ()):
            level[other] = max(level.get(other, 0), level[call] + 1)
            left[other] -= 1
            if left[other] == 0:
                queue.append(other)
    done = set(queue)
    return {call: n for call, n in level.items() if call in done}


def levels(calls: DataFrame, together: int = TOGETHER) -> DataFrame:
    """``conv_id``, ``call_id``, ``level`` and ``unknown_need`` of unique calls with ``needs``.

    ``needs`` is an array of identifiers.
    """
    keys = ["conv_id", "call_id"]
    edges = calls.select(*keys, F.explode(F.array_distinct("needs")).alias("need"))
    edges = edges.where(F.col("need").isNotNull())
    known = calls.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("exists"))
    edges = materialise(edges.join(known, ["conv_id", "need"], "left"), "calls-needs")
    unknown = edges.where("exists is null").select(*keys, F.lit(True).alias("unknown_need")).distinct()
    inner = edges.where("exists").select("conv_id", "call_id", "need")
    rows = calls.select(*keys, F.lit(None).cast("string").alias("need")).unionByName(inner)
    rows = materialise(rows, "calls-graph")
    sizes = rows.groupBy("conv_id").count()
    large = materialise(sizes.where(F.col("count") > together).select("conv_id"), "calls-large")
    few = rows.join(large, "conv_id", "left_anti")
    kind = dict(calls.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, calls_of, needs_of = None, [], []
        convs, found, kind_of = [], [], None

        def solve() -> None:
            new = peeled(calls_of, needs_of)
            convs.extend([conv] * len(new))
            found.extend(new.items())

        def flushed() -> pa.RecordBatch:
            arrays = [
                pa.array(convs, kind_of),
                pa.array([call for call, _ in found], pa.string()),
                pa.array([n for _, n in found], pa.int64()),
            ]
            convs.clear()
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "call_id", "level"])

        for batch in batches:
            kind_of = batch.schema.field(0).type
            for own, call, need in zip(*(c.to_pylist() for c in batch.columns)):
                if own != conv and calls_of:
                    solve()
                    calls_of, needs_of = [], []
                    if len(found) >= AT_ONCE:
                        yield flushed()
                conv = own
                if need is None:
                    calls_of.append(call)
                else:
                    needs_of.append((call, need))
        if calls_of:
            solve()
        if found:
            yield flushed()

    schema = f"conv_id {kind}, call_id string, level long"
    ordered = few.repartition("conv_id").sortWithinPartitions("conv_id", F.col("need").asc_nulls_first())
    solved = in_tasks(ordered.select("conv_id", "call_id", "need"), run, schema)
    if not large.isEmpty():
        solved = solved.unionByName(_peeled_by_joins(rows.join(large, "conv_id", "left_semi")))
    solved = materialise(solved, "calls-levels")
    found = calls.select(*keys).join(solved, keys, "left").join(unknown, keys, "left")
    return found.select(*keys, "level", F.coalesce("unknown_need", F.lit(False)).alias("unknown_need"))


def _peeled_by_joins(rows: DataFrame) -> DataFrame:
    """Levels by rounds: what waits for nothing unresolved has the level of the round."""
    keys = ["conv_id", "call_id"]
    edges = materialise(rows.where("need is not null"), "calls-edges")
    waiting = materialise(edges.select(*keys).distinct(), "calls-waiting")
    ready = rows.where("need is null").join(waiting, keys, "left_anti").select(*keys)
    solved, level = None, 0
    while True:
        ready = materialise(ready, "calls-ready")
        if ready.isEmpty():
            return solved if solved is not None else ready.withColumn("level", F.lit(0).cast("long"))
        new = ready.withColumn("level", F.lit(level).cast("long"))
        solved = new if solved is None else solved.unionByName(new)
        level += 1
        done = ready.select("conv_id", F.col("call_id").alias("need"))
        touched = edges.join(done, ["conv_id", "need"], "left_semi").select(*keys).distinct()
        edges = materialise(edges.join(done, ["conv_id", "need"], "left_anti"), "calls-edges")
        ready = touched.join(edges, keys, "left_anti")
        if level % 20 == 0:  # a union of as many tables as levels would slow planning down
            solved = materialise(solved, "calls-solved")


def _firsts(rows: DataFrame, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each identifier, and all others."""
    tagged = rows.select("conv_id", "call_id", *order, F.monotonically_increasing_id().alias("tag"))
    tagged = materialise(tagged, f"calls-{label}")
    first = tagged.groupBy("conv_id", "call_id").agg(F.min(F.struct(*order, "tag")).alias("first"))
    first = materialise(first, f"calls-{label}-first")
    again = tagged.join(first.select("conv_id", "call_id", F.col("first.tag").alias("of")), ["conv_id", "call_id"])
    unique = first.select("conv_id", "call_id", *[F.col(f"first.{c}").alias(c) for c in order])
    return unique, again.where("tag != of").drop("tag", "of")


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Links of ``calls`` (conv_id, turn, call_id, name, arguments, needs) and ``results``
    (conv_id, turn, call_id, content).

    Columns: ``conv_id``, ``call_id``, ``name``, ``level``, ``call_turn``, ``result_turn``,
    ``status``, ``problems`` and ``line``, the canonical JSON; sorted by conversation, level,
    turn and identifier over all files.
    """
    for name, schema in schemas.items():
        check_schema(schema, name)
    if dict(calls.dtypes)["needs"] == "string":  # one call at most
        one = F.when(F.col("needs").isNotNull(), F.array("needs"))
        calls = calls.withColumn("needs", F.coalesce(one, F.array().cast("array<string>")))
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    unique, more_calls = _firsts(calls.where(has_id), ["turn", "name", "arguments", "needs"], "unique")
    unique = unique.withColumnRenamed("turn", "call_turn")
    first_result, more_results = _firsts(results.where(has_id), ["turn", "content"], "results")
    linked = (
        unique.join(levels(unique.select("conv_id", "call_id", "needs")), ["conv_id", "call_id"])
        .join(
            first_result.withColumnRenamed("turn", "result_turn").withColumn("answered", F.lit(True)),
            ["conv_id", "call_id"],
            "full_outer",
        )
        .withColumn(
            "status",
            F.when(F.col("unknown_need").isNull(), "orphan")
            .when(F.col("answered").isNull(), "unanswered")
            .when(F.col("result_turn") < F.col("call_turn"), "early")
            .otherwise("linked"),
        )
        .drop("answered")
    )
    none = lambda kind: F.lit(None).cast(kind)
    types = dict(unique.dtypes) | dict(results.dtypes)

    def calls_alone(rows: DataFrame, status: str) -> DataFrame:
        return rows.select(
            "conv_id", "call_id", F.col("turn").alias("call_turn"), "name", "arguments", "needs",
            none("long").alias("level"), none("boolean").alias("unknown_need"),
            none(types["turn"]).alias("result_turn"), none(types["content"]).alias("content"),
            F.lit(status).alias("status"),
        )

    def results_alone(rows: DataFrame, status: str) -> DataFrame:
        return rows.select(
            "conv_id", "call_id", none(types["call_turn"]).alias("call_turn"),
            none("string").alias("name"), none("string").alias("arguments"),
            none(types["needs"]).alias("needs"), none("long").alias("level"),
            none("boolean").alias("unknown_need"), F.col("turn").alias("result_turn"), "content",
            F.lit(status).alias("status"),
        )

    without = (
        calls_alone(calls.where(~has_id), "no_id")
        .unionByName(results_alone(results.where(~has_id), "no_id"))
        .unionByName(calls_alone(more_calls, "repeated"))
        .unionByName(results_alone(more_results, "repeated"))
    )
    every = linked.unionByName(without)
    names = ["conv_id", "call_id", "name", "level", "call_turn", "result_turn", "status"]
    inner = ["arguments", "content", "needs", "unknown_need"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            faults, lines = [], []
            for row in batch.to_pylist():
                fault, line = _line(row, schemas)
                faults.append(fault)
                lines.append(line)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in range(len(names))],
                    pa.array(faults, pa.list_(pa.string())),
                    pa.array(lines, pa.string()),
                ],
                [*names, "problems", "line"],
            )

    kinds = dict(every.dtypes)
    schema = ", ".join(f"{n} {kinds[n]}" for n in names)
    written = in_tasks(
        every.select(*names, *inner), run, f"{schema}, problems array<string>, line string"
    )
    return materialise(written, "calls-lines").orderBy(
        "conv_id", "level", "call_turn", "call_id", "result_turn", "line"
    )


def _line(row: dict, schemas: dict[str, dict]) -> tuple[list[str], str]:
    found, arguments = [], None
    if row["status"] != "orphan" and (row["name"] is not None or row["arguments"] is not None):
        schema = schemas.get(row["name"])
        if schema is None:
            found.append("no such tool")
        try:
            arguments = read_json(row["arguments"])
            canonical(arguments)
        except ValueError:
            arguments = None
            found.append("arguments are no JSON")
        else:
            found += [] if schema is None else problems(arguments, schema)
    if row["unknown_need"]:
        found.append("waits for an unknown call")
    if row["status"] in ("linked", "unanswered", "early") and row["level"] is None:
        found.append("waits in a circle")
    try:
        content = read_json(row["content"])
        canonical(content)
    except ValueError:
        content = row["content"]
    kept = {k: row[k] for k in ("conv_id", "call_id", "name", "level", "needs", "status")}
    line = canonical(kept | {"arguments": arguments, "result": content, "problems": sorted(found)})
    return sorted(found), line
