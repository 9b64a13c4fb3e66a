"""A manifest of hashes: one tree for each group of rows, one tree over the groups.

A tree has sixteen children to a node. It is cut into aligned blocks of three levels (4,096
leaves): a block is one row, made by one task, and its top is a leaf of the next stage of
blocks, until a group has one block left. The tops of the groups are the leaves of a last tree of
the same kind. So no task ever has more than a block, however large a group is.

Trees are persistent: a changed leaf makes a version of its block in which only the ancestors
of that leaf are new nodes; they share all other children with the version before (``Block``).
Above the block a version goes on along the path of the block's top, which is the same for all
leaves below it: siblings are read, never copied, and each level adds one node to the version.
``versions`` lists the new nodes.

The place of a row in its group comes from range partitions of (group, id): each task numbers
its own rows, and the counts of earlier tasks are added. A group may span any number of tasks.

Defined results: null fields are marked ``-``, so they differ from empty ones; a null id comes
first and is never tampered with; a null group is a group of its own and comes first; rows with
equal ids are in the order of their leaves, and equal rows are leaves each; an empty table
gives no rows. Columns that are not named don't count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import column, in_tasks, materialise

FAN = 16
LEVELS = 3  # of a block
TAMPER = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64  # characters of a digest
# The letters that tampering changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


class Block:
    """A tree over the leaves of a block, whose versions share nodes.

    ``levels[k][i]`` is node ``i`` of level ``k`` in the first version; the last level has the
    top. In a group of several blocks each goes up to the same level, where a last run of one
    node is hashed as well; a group's only block ends at its first single node.
    """

    def __init__(self, leaves: Sequence[bytes], total: int, height: int):
        self.levels = [list(leaves)]
        several = total > FAN**height
        while len(self.levels) <= height if several else len(self.levels[-1]) > 1:
            nodes = self.levels[-1]
            self.levels.append([digest(b"".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)])

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def path(self, leaf: int) -> list[tuple[int, bytes]]:
        """For each level the place among siblings, and the siblings from left to right."""
        found = []
        for nodes in self.levels[:-1]:
            first = leaf - leaf % FAN
            others = nodes[first:leaf] + nodes[leaf + 1 : first + FAN]
            found.append((leaf - first, b"".join(others)))
            leaf //= FAN
        return found


def copied(leaf: bytes, path: list[tuple[int, bytes]]) -> list[bytes]:
    """The new nodes of a version, from the parent of its new leaf to the root."""
    nodes = []
    for place, others in path:
        cut = place * HEX
        leaf = digest(others[:cut] + leaf + others[cut:])
        nodes.append(leaf)
    return nodes


def packed(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes((place, len(others) // HEX)) + others for place, others in path)


def unpacked(data: bytes) -> list[tuple[int, bytes]]:
    path, at = [], 0
    while at < len(data):
        end = at + 2 + data[at + 1] * HEX
        path.append((data[at], data[at + 2 : end]))
        at = end
    return path


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of fields, each ``-`` if null, else its length in bytes, a colon, and its text."""
    texts = [f.cast("string") for f in fields]
    marked = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def _leaves(df: DataFrame, fields: Sequence[str], group: str, order: str, text: str, every: int) -> DataFrame:
    """``grp``, ``id``, ``leaf`` and, of tampered rows, ``changed``; ``tie`` tells equal rows apart."""
    named = {f: column(df, f) for f in fields}
    tampered = named | {text: F.translate(named[text].cast("string"), UPPER, LOWER)}
    chosen = F.crc32(column(df, order).cast("string").cast("binary")) % every == 0
    return df.select(
        column(df, group).cast("string").alias("grp"),
        column(df, order).alias("id"),
        leaf_hash(list(named.values())).alias("leaf"),
        F.when(chosen, leaf_hash(list(tampered.values()))).alias("changed"),
        F.monotonically_increasing_id().alias("tie"),
    )


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Written rows with ``idx``, their place in ``grp`` by ``order``, and its size ``total``."""
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    at = rows.columns.index("grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count = object(), 0
        for batch in batches:
            places = []
            for group in batch.column(at).to_pylist():
                count = count + 1 if group == last else 0
                last = group
                places.append(count)
            arrays = [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "part", "place"])

    placed = materialise(in_tasks(ranged, run, f"{fields}, part int, place long"), "merkle-placed")
    # One row for each group and each task it spans.
    counts = materialise(placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n")), "merkle-counts")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("grp").alias("of"),
        F.col("part").alias("in_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("grp")).alias("total"),
    )
    same = F.col("grp").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part"))
    found = placed.join(materialise(starts, "merkle-starts"), same)
    return found.select(*rows.columns, (F.col("start") + F.col("place")).alias("idx"), "total")


def _blocks(nodes: DataFrame, label: str, height: int) -> DataFrame:
    """Nodes (``grp``, ``idx``, ``total``, ``id``, ``leaf``, ``changed``) as one row for each block.

    ``top`` is the node above the block: ``height`` levels up, or the top of a group's only block.
    """
    span = FAN**height
    id_type = nodes.schema["id"].dataType.simpleString()
    ordered = (
        nodes.select("grp", F.floor(F.col("idx") / span).alias("block"), "idx", "total", "id", "leaf", "changed")
        .repartition("grp", "block")
        .sortWithinPartitions("grp", "block", "idx")
    )
    out = (
        f"grp string, block long, total long, ids array<{id_type}>, leaves binary,"
        " changed array<string>, top string"
    )

    def made(key: tuple, rows: list, id_arrow: pa.DataType) -> pa.RecordBatch:
        leaves = [r[1].encode() for r in rows]
        block = Block(leaves, key[2], height)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]], pa.string()),
                pa.array([key[1]], pa.int64()),
                pa.array([key[2]], pa.int64()),
                pa.array([[r[0] for r in rows]], pa.list_(id_arrow)),
                pa.array([b"".join(leaves)], pa.binary()),
                pa.array([[r[2] for r in rows]], pa.list_(pa.string())),
                pa.array([block.top.decode()], pa.string()),
            ],
            ["grp", "block", "total", "ids", "leaves", "changed", "top"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, kind = None, [], None
        for batch in batches:
            kind = batch.schema.field(4).type
            keys = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)))
            values = zip(*(batch.column(i).to_pylist() for i in (4, 5, 6)))
            for own, value in zip(keys, values):
                if own != key and rows:
                    yield made(key, rows, kind)
                    rows = []
                key = own
                rows.append(value)
        if rows:
            yield made(key, rows, kind)

    return materialise(in_tasks(ordered, run, out), label)


def _stages(nodes: DataFrame, label: str, height: int) -> list[DataFrame]:
    """Blocks over nodes, blocks over the tops of those, until each group has one block."""
    span = FAN**height
    stages = [_blocks(nodes, f"{label}-0", height)]
    while True:
        rest = stages[-1].where(F.col("total") > span)
        if rest.isEmpty():
            return stages
        above = rest.select(
            "grp",
            F.col("block").alias("idx"),
            F.ceil(F.col("total") / span).alias("total"),
            F.lit(None).cast("long").alias("id"),
            F.col("top").alias("leaf"),
            F.lit(None).cast("string").alias("changed"),
        )
        stages.append(_blocks(above, f"{label}-{len(stages)}", height))


def _tops(stages: list[DataFrame], height: int) -> DataFrame:
    """The top of each group."""
    done = [s.where(F.col("total") <= FAN**height).select("grp", F.col("top").alias("subroot")) for s in stages]
    return reduce(DataFrame.unionByName, done)


def _block_of(total: int, leaves: bytes, height: int) -> Block:
    return Block([leaves[i : i + HEX] for i in range(0, len(leaves), HEX)], total, height)


def _paths(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """``grp``, ``idx`` and ``path`` (to the root) of the nodes of blocks; ``above``: of the blocks."""
    joined = _with_path(blocks, above).select("grp", "block", "total", "leaves", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, number, total, leaves, upper in zip(*(c.to_pylist() for c in batch.columns)):
                block = _block_of(total, leaves, height)
                size = len(block.levels[0])
                paths = [packed(block.path(i)) + upper for i in range(size)]
                places = [number * FAN**height + i for i in range(size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([grp] * size, pa.string()),
                        pa.array(places, pa.int64()),
                        pa.array(paths, pa.binary()),
                    ],
                    ["grp", "idx", "path"],
                )

    return in_tasks(joined, run, "grp string, idx long, path binary")


def _with_path(blocks: DataFrame, above: DataFrame) -> DataFrame:
    upper = above.select(F.col("grp").alias("of"), F.col("idx").alias("at"), "path")
    return blocks.join(upper, F.col("grp").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))


def _down(stages: list[DataFrame], tops: DataFrame, label: str, height: int) -> DataFrame:
    """Paths of the blocks of the first stage; ``tops``: of the tops of the groups."""
    above = None
    for number in range(len(stages) - 1, -1, -1):
        last = stages[number].where(F.col("total") <= FAN**height).select("grp", "block")
        ends = _with_path(last, tops).select("grp", F.col("block").alias("idx"), "path")
        above = ends if above is None else above.unionByName(ends)
        if number:
            above = materialise(_paths(stages[number], above, height), f"{label}-paths-{number}")
    return above


def manifest(
    df: DataFrame,
    *,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    text: str = "text",
    every: int = TAMPER,
    height: int = LEVELS,
) -> DataFrame:
    """One row for each row of ``df``: its leaf, its proof, and the root of its own version.

    ``folded_root`` is the root recomputed from the tampered leaf, else the original one, and
    the original siblings; ``copies`` has the new nodes of that version, from the leaf's parent
    to the root, and is null for rows not tampered with. ``proof_sha256`` is the hash of the
    siblings from the leaf to the root. Blocks have ``height`` levels.
    """
    id_type = df.schema[order].dataType.simpleString()
    leaves = materialise(_leaves(df, fields, group, order, text, every), "merkle-leaves")
    stages = _stages(numbered(leaves, ["id", "leaf", "tie"]), "merkle", height)
    subroots = materialise(_tops(stages, height), "merkle-subroots")
    groups = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "subroot")
    named = materialise(numbered(groups, ["name"]), "merkle-groups")
    upper = _stages(
        named.select("grp", "idx", "total", F.lit(None).cast("long").alias("id"), F.col("subroot").alias("leaf"), F.lit(None).cast("string").alias("changed")),
        "merkle-upper",
        height,
    )
    top = _tops(upper, height).first()  # one row, none for an empty table
    start = F.lit("").alias("grp"), F.lit(0).cast("long").alias("idx"), F.lit(b"").alias("path")
    one = df.sparkSession.range(1).select(*start)
    places = _paths(upper[0], _down(upper, one, "merkle-upper", height), height)
    of_groups = materialise(
        places.withColumnRenamed("grp", "tree").join(named.select("idx", "name"), "idx")
        .select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("idx"), "path"),
        "merkle-group-paths",
    )
    above = _down(stages, of_groups, "merkle", height)
    root = F.lit(top["subroot"] if top else None).cast("string").alias("root")
    facts = subroots.select(F.col("grp").alias("named"), "subroot", root)
    joined = _with_path(stages[0], above).join(facts, F.col("grp").eqNullSafe(F.col("named")))
    joined = joined.select("total", "ids", "leaves", "changed", "path", "subroot", "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field(1).type.value_type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                yield _proved(*row, kind, height)

    out = f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string"
    out += ", folded_root string, copies array<string>"
    found = in_tasks(joined, run, out)
    return found.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", order)


def _proved(total, ids, leaves, changed, path, subroot, root, kind, height) -> pa.RecordBatch:
    """The rows of a block."""
    block = _block_of(total, leaves, height)
    upper = unpacked(path)
    proofs, folded, copies = [], [], []
    for number, (leaf, other) in enumerate(zip(block.levels[0], changed)):
        way = block.path(number) + upper
        proofs.append(hashlib.sha256(b"".join(others for _, others in way)).hexdigest())
        new = leaf if other is None else other.encode()
        nodes = [n.decode() for n in copied(new, way)]
        folded.append(nodes[-1] if nodes else new.decode())
        copies.append(None if other is None else nodes)
    size = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, kind),
            pa.array([n.decode() for n in block.levels[0]], pa.string()),
            pa.array([subroot] * size, pa.string()),
            pa.array([root] * size, pa.string()),
            pa.array(proofs, pa.string()),
            pa.array(folded, pa.string()),
            pa.array(copies, pa.list_(pa.string())),
        ],
        ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "copies"],
    )


def versions(found: DataFrame, order: str = "doc_id") -> DataFrame:
    """The new nodes of each version in a manifest: id of the tampered row, ``level`` and ``node``."""
    return found.select(F.col(f"`{order}`"), F.posexplode("copies").alias("height", "node")).select(
        F.col(f"`{order}`"), (F.col("height") + 1).alias("level"), "node"
    )
