"""Training order: every sequence gets a global slot, and shards hold slots in order.

Documents are encoded and cut into sequences of a fixed number of ids, numbered without
gaps by the partition that made them. A keyed Feistel network permutes the smallest
square-sized range of bits that holds all numbers; a value outside the numbers is permuted
again until it is inside (cycle-walking), which gives a permutation of exactly the
numbers. So the order depends on a key, takes no sort by random values, and can be
computed for any slot. Shards are ranges of slots, one folder each, in rows of a fixed
stride sorted by slot. They are Parquet files, so a place in a shard is a row, not a byte; a
reader goes on from any slot by its shard and row, and gets rows in the order of slots. The
size of a shard is written beside them, so a reader can't take another one.

Defined results: null text counts as empty, and an empty text is one sequence with its end
id alone; null ids and repeated rows are carried along, each row by itself; an empty table
gives no rows and no shards.
"""

from __future__ import annotations

from collections.abc import Iterator

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, LongType, StructField, StructType

from obs_engine.llm.common import column, in_tasks, materialise
from obs_engine.llm.encoding import default_tokenizer, encoder
from obs_engine.session import scratch_path

SEQUENCE_TOKENS = 512
SEQUENCES_PER_SHARD = 16_384
ROUNDS = 4
WALK = 160
END_ID = 1
ABOUT = "sequences_per_shard long, sequence_tokens long, sequences long"


def feistel(value: Column, count: int, key: int, rounds: int = ROUNDS) -> Column:
    """The place of ``value`` in a permutation of ``range(count)`` that the key chooses.

    The network permutes up to four times as many values; one that comes out beyond ``count``
    goes through again. Each time that is three in four at most, so that ``WALK`` steps are too
    few for one in 10^20 values; such a value raises.
    """
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    keys = np.random.SeedSequence(key).generate_state(rounds, np.uint64).view(np.int64).tolist()

    def one_round(pair: Column, k: int) -> Column:
        mixed = F.shiftrightunsigned(F.xxhash64(pair["right"], F.lit(k)), 16).bitwiseAND(F.lit(mask))
        return F.struct(pair["right"].alias("left"), pair["left"].bitwiseXOR(mixed).alias("right"))

    def once(x: Column) -> Column:
        halves = F.struct(F.shiftright(x, half).alias("left"), x.bitwiseAND(F.lit(mask)).alias("right"))
        # Lambdas name what is used twice, so that no expression doubles with each round.
        out = reduce(lambda pair, k: F.transform(pair, lambda p: one_round(p, k)), keys, F.array(halves))
        return F.transform(out, lambda p: F.shiftleft(p["left"], half).bitwiseOR(p["right"]))[0]

    start = value.cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        once(start),
        lambda x, _: F.when(x >= count, once(x)).otherwise(x),
    )
    too_long = F.raise_error(F.lit(f"no place below {count} in {WALK} steps"))
    return F.transform(F.array(walked), lambda x: F.when(x < count, x).otherwise(too_long.cast("long")))[0]


def sequences(
    df: DataFrame, id_column: str, text_column: str, path: str, size: int, end_id: int
) -> DataFrame:
    """``id``, ``sequence_no`` in its document, ``n_tokens``, ``ids``; ``part`` and ``place``."""
    rows = df.select(column(df, id_column).alias("id"), column(df, text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "sequence_no", "n_tokens", "ids", "part", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, encode = TaskContext.get().partitionId(), 0, encoder(path).encode
        for batch in batches:
            at, numbers, lengths, blocks = [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.frombuffer(encode(text.as_py() or ""), "<u4")
                count = len(ids) // size + 1  # with the end id
                padded = np.zeros(count * size, "<u2")
                padded[: len(ids)] = ids
                padded[len(ids)] = end_id
                whole = padded.tobytes()
                at += [row] * count
                numbers += range(count)
                lengths += [size] * (count - 1) + [len(ids) % size + 1]
                blocks += [whole[i : i + 2 * size] for i in range(0, len(whole), 2 * size)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(numbers, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(blocks, pa.binary()),
                    pa.array([part] * len(at), pa.int64()),
                    pa.array(range(place, place + len(at)), pa.int64()),
                ],
                names,
            )
            place += len(at)

    return in_tasks(
        rows,
        run,
        f"id {kind}, sequence_no long, n_tokens long, ids binary, part long, place long",
    )


def write_training_order(
    df: DataFrame,
    key: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    sequences_per_shard: int = SEQUENCES_PER_SHARD,
    end_id: int = END_ID,
    path: str | None = None,
) -> str:
    """Write the shards and return their folder.

    Columns: ``shard`` (a folder each), ``slot``, ``id``, ``sequence_no``, ``n_tokens`` and
    ``ids``, a block of two bytes for each of ``sequence_tokens`` ids, padded with zeros.
    """
    spark, source = df.sparkSession, tokenizer or default_tokenizer()
    if encoder(source).size > 1 << 16:
        raise ValueError("ids of this vocabulary take more than two bytes")
    made = materialise(
        sequences(df, id_column, text_column, source, sequence_tokens, end_id), "order-sequences"
    )
    total = made.count()
    # One row for each task that encoded, however many sequences it made.
    sizes = made.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    # ``first`` has a row for each task.
    number = F.col("first") + F.col("place")
    placed = made.join(F.broadcast(first), "part").withColumn("slot", feistel(number, total, key))
    placed = placed.withColumn("shard", F.floor(F.col("slot") / sequences_per_shard))
    shards = max(1, -(-total // sequences_per_shard))
    out = path or scratch_path(spark, "order-shards")
    (
        placed.select("shard", "slot", "id", "sequence_no", "n_tokens", "ids")
        .repartitionByRange(shards, "shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .option("compression", "zstd")
        .mode("overwrite")
        .parquet(f"{out}/shards")
    )
    about = [(sequences_per_shard, sequence_tokens, total)]
    spark.createDataFrame(about, ABOUT).coalesce(1).write.mode("overwrite").json(f"{out}/about")
    return out


def read_training_order(
    spark: SparkSession, path: str, id_type: DataType, from_slot: int = 0, ordered: bool = True
) -> DataFrame:
    """The written columns from a slot on, and ``place``, the row in the shard.

    Shards before the slot are not opened. Rows come in the order of their slots; without
    ``ordered`` only those of a file do, which takes no shuffle.
    """
    kinds = [
        ("slot", LongType()),
        ("id", id_type),
        ("sequence_no", LongType()),
        ("n_tokens", LongType()),
        ("ids", BinaryType()),
        ("shard", LongType()),
    ]
    schema = StructType([StructField(name, kind) for name, kind in kinds])
    each = spark.read.schema(ABOUT).json(f"{path}/about").first()["sequences_per_shard"]
    rows = spark.read.schema(schema).parquet(f"{path}/shards")
    rows = rows.where((F.col("shard") >= from_slot // each) & (F.col("slot") >= from_slot))
    rows = rows.withColumn("place", F.col("slot") % each)
    return rows.orderBy("slot") if ordered else rows
