"""Near duplicates by SimHash: fingerprints, Golay-code keys, links, components.

A fingerprint has 64 bits in three segments of 23, 23 and 18 bits. If two fingerprints
differ in at most two bits, one of the segment pairs (first, second), (second, third),
(third, first) has no error in its one segment and at most one in its other. The other
is decoded by the perfect [23, 12] Golay code: the nearest codeword of one of the two is
within four errors of the other. So each fingerprint gets a key for each codeword within
four errors (one or six) beside each exact segment, and pairs that share a key, of which
one has it by its nearest codeword, are verified by their differing bits.

A key with more fingerprints than ``PAIRED`` is not paired: its fingerprints get their 65
neighbours at up to one bit as keys instead. Two of them share a neighbour if and only if
they differ in at most two bits, and each is linked to the smallest that has it, so the
work is proportional to the number of fingerprints and no link between components is lost.

Equal fingerprints are one node from the start. Defined results: null text counts as
empty; a text without words has fingerprint zero and links like any other; a null id comes
after all others; repeated rows fall together; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import column, in_tasks, materialise

SEED = 42
DISTANCE = 2
PAIRED = 32
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((0, 23), (23, 23), (46, 18))
FAMILIES = ((0, 1), (1, 2), (2, 0))  # exact segment, decoded segment
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The fingerprint of one text in UTF-8."""
    words = (text or b"").translate(LOWER).split()  # splits at \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        spans = [b" ".join(words)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        joined = b" ".join(words)
        last = len(words) - shingle + 1
        spans = [joined[a:b] for a, b in zip(starts[:last].tolist(), ends[shingle - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), AT_ONCE):
        part = spans[at : at + AT_ONCE]
        hashes = np.array([digest(s, SEED) for s in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    ones = np.flatnonzero(2 * counts > len(spans))
    return int(np.bitwise_or.reduce(np.uint64(1) << ones.astype(np.uint64))) if len(ones) else 0


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprints(df: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """``id``, ``tag`` (unique) and ``print`` of each row."""
    rows = df.select(
        column(df, id_column).alias("id"),
        F.monotonically_increasing_id().alias("tag"),
        F.encode(column(df, text_column), "UTF-8").alias("text"),
    )
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _signed(found)], ["id", "tag", "print"]
            )

    return in_tasks(rows, run, f"id {kind}, tag long, print long")


@lru_cache(maxsize=1)
def nearby() -> np.ndarray:
    """For each syndrome the errors that lead to its codewords within four: one or six.

    The nearest comes first; where there is but one, it is repeated.
    """
    bits = 1 << np.arange(23)
    weights: dict[int, list[int]] = {}
    by_weight = [np.zeros(1, np.int64)]
    for _ in range(4):
        grown = (by_weight[-1][:, None] | bits[None, :]).ravel()
        of = np.bitwise_count(grown)
        by_weight.append(np.unique(grown[of == np.bitwise_count(by_weight[-1][0]) + 1]))
    for errors in by_weight:
        for error, syndrome in zip(errors.tolist(), syndromes(errors).tolist()):
            weights.setdefault(syndrome, []).append(error)
    table = np.zeros((2048, 6), np.int64)
    for syndrome, errors in weights.items():
        table[syndrome] = [*errors, *[errors[0]] * (6 - len(errors))]
    return table


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = rest ^ ((rest >> bit & 1) * (GENERATOR << (bit - 11)))
    return rest


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, key, and whether by the nearest codeword, of all keys of fingerprints."""
    values = prints.view(np.uint64)
    part = [
        (values >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)
        for at, width in SEGMENTS
    ]
    rows, keys, nearest = [], [], []
    for family, (exact, decoded) in enumerate(FAMILIES):
        errors = nearby()[syndromes(part[decoded])]
        index = (part[decoded][:, None] ^ errors) >> 11  # twelve bits tell the codeword
        key = (np.int64(family) << 36 | part[exact] << 12)[:, None] | index
        real = np.ones(errors.shape, bool)
        real[:, 1:] = errors[:, 1:] != errors[:, :1]
        row, place = np.nonzero(real)
        rows.append(row)
        keys.append(key[row, place])
        nearest.append(place == 0)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(nearest)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        rows, keys, nearest = golay_keys(prints)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(prints[rows]), pa.array(nearest)], ["key", "print", "nearest"]
        )


def links(nodes: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ in at most two bits.

    They connect all that such pairs connect; between the fingerprints of a crowded key
    not each pair is among them.
    """
    keyed = materialise(
        in_tasks(nodes.select("print"), _keyed, "key long, print long, nearest boolean"),
        "simhash-keys",
    )
    # Aggregates are written before they are joined, here and in ``connected``: a join of
    # two plain exchanges can have a crowded key split, one with an aggregate cannot.
    sizes = materialise(keyed.groupBy("key").count().where("count > 1"), "simhash-sizes")
    shared = materialise(keyed.join(sizes, "key"), "simhash-shared")
    few = shared.where(F.col("count") <= paired)
    left = few.where("nearest").select("key", F.col("print").alias("p"))
    right = few.select("key", F.col("print").alias("q"))
    differ = F.bit_count(F.col("p").bitwiseXOR(F.col("q")))
    pairs = left.join(right, "key").where((F.col("p") != F.col("q")) & (differ <= DISTANCE))
    pairs = pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    crowded = shared.where(F.col("count") > paired).select("print").distinct()
    flips = F.array(
        F.col("print"), *[F.col("print").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), k)) for k in range(64)]
    )
    spread = crowded.select("print", F.explode(flips).alias("key"))
    lowest = spread.groupBy("key").agg(F.min("print").alias("a"), F.count(F.lit(1)).alias("n"))
    stars = spread.join(lowest.where("n > 1"), "key").where(F.col("a") != F.col("print"))
    stars = stars.select("a", F.col("print").alias("b"))
    return pairs.unionByName(stars).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for nodes other than roots.

    Alternating large-star and small-star rounds; each is an aggregation and a join, and
    the number of rounds grows with the logarithm of the largest component.
    """
    edges = materialise(edges.select("a", "b"), "simhash-links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        low = materialise(low, "simhash-low")
        large = both.join(low, "a").where("b > a").select(F.col("low").alias("a"), "b")
        large = materialise(large.where("a < b").distinct(), "simhash-large")
        down = materialise(large.groupBy("b").agg(F.min("a").alias("low")), "simhash-down")
        small = large.join(down, "b").where("a > low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        small = small.unionByName(down.select(F.col("low").alias("a"), "b")).distinct()
        edges = materialise(small, "simhash-small")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state


def components(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3
) -> DataFrame:
    """For each row of ``df``: ``id``, ``tag``, ``print``, and ``first`` of its component.

    ``first`` has ``id`` and ``tag`` of the row with the smallest id. Tags number the rows
    of ``df`` as ``monotonically_increasing_id`` does.
    """
    prints = materialise(fingerprints(df, id_column, text_column, shingle), "simhash-prints")
    nodes = materialise(
        prints.groupBy("print").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tag")).alias("first")
        ),
        "simhash-nodes",
    )
    star = connected(links(nodes))
    rooted = nodes.join(star, nodes["print"] == star["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    labels = rooted.join(lowest, "root").select("print", F.col("lowest").alias("first"))
    return prints.join(labels, "print").select("id", "tag", "print", "first.id", "first.tag").toDF(
        "id", "tag", "print", "first_id", "first_tag"
    )


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3
) -> DataFrame:
    """One row for each row of ``df``: id, ``fingerprint``, ``component_id``."""
    return components(df, id_column, text_column, shingle).select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("first_id").alias("component_id"),
    )


def drop_near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3
) -> DataFrame:
    """``df`` with one row of each component, that of the smallest id."""
    staged = materialise(
        df.select(
            F.struct(*[column(df, c) for c in df.columns]).alias("row"),
            column(df, id_column).alias("id"),
            F.monotonically_increasing_id().alias("stage_tag"),
        ),
        "simhash-rows",
    )
    # The staged tag takes the place of the id, so that rows with equal ids stay apart.
    ranked = staged.select(F.struct(F.col("id").isNull().alias("no_id"), "id", "stage_tag").alias("id"), F.col("row")[text_column].alias("text"))
    found = components(ranked, "id", "text", shingle)
    stays = found.where(F.col("id") == F.col("first_id")).select("id.stage_tag")
    return staged.join(stays, "stage_tag", "left_semi").select("row.*")
