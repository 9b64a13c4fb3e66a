"""Near duplicates by MinHash with sequential Bayesian verification.

A text is the set of its distinct shingles. Equal sets are one node from the start. The
signature of a node has a minimum for each of ``HASHES`` hash functions; nodes that agree on all
rows of a band are candidates. A candidate pair is compared one batch of the signatures after
another. After n positions with m agreements, and all similarities equally likely before, the
similarity is at least t with the probability that a binomial variable of n + 1 trials at t is at
most m; as soon as that falls below ``miss``, the pair is given up. Survivors are verified on
their full sets.

Bands lose a pair that is just similar enough with a probability of (1 - t^rows)^bands, here 7 in
a million at 0.8 and far less above.

No bucket of a band is paired as a whole. First each node is compared with the smallest of its
bucket only, and the links found are contracted. Of buckets that still hold several components
the nodes get longer signatures, of one bit for each of ``LONG`` functions (of equal size they
tell more than longer minima of fewer functions), and a task compares a block of a bucket with
itself or another one, as arrays: pairs of one component are left out. No pair is written, only
the nodes that have one left. These meet again in blocks with their full sets, where a pair is
verified in the first bucket it shares; a link found joins two components in the task, so that a
block gives fewer links than it has nodes. A bucket of more than ``BLOCK`` nodes, or of as many
long sets, is several blocks, so no task holds more than two, and no link between components is
lost, whatever the size.

Defined results: null, empty and wordless texts have no shingles and are linked with nothing;
a text with fewer words than a shingle has one; a null id comes after all others as a component's
smallest; rows that repeat are equal sets; an empty table gives no rows. Shingles are compared by
64-bit hashes of their words; the number of shingles is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import column, in_tasks, materialise
from obs_engine.llm.simhash import LOWER, connected

SHINGLE = 2
PERCENT = 80
HASHES = 160
ROWS, BANDS = 5, 30
BATCH = 32  # positions of signatures compared at once
MISS = 1e-6
LONG = 5120  # bits
LONG_BATCH = 512
BLOCK = 1024
LONG_SET = 2048  # shingles that count as one more node of a block
DENSE = 8  # survivors of a node, beyond which the best go first
CHUNK = 512  # shingles hashed at once
WORDS = 1 << 18  # words remembered by a task
FEW_NODES = 2_000_000  # numbers of nodes that are broadcast, 16 bytes each
BYTES = 1 << 24  # of sets in one batch of results


@lru_cache(maxsize=2)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers and increments of so many hash functions, and room for their values."""
    made = np.random.default_rng(count).integers(0, 1 << 32, (2, count), np.uint32)
    return made[0] | np.uint32(1), made[1], np.empty((CHUNK, count), np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that leaves no pattern in the high bits."""
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


class Words:
    """Numbers of words with their hashes; forgets all when too many."""

    def __init__(self):
        self.hashes = np.zeros(1024, np.uint64)
        self.number: dict[bytes, int] = {}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > WORDS:
            self.number.clear()
        known = self.number
        found = list(map(known.get, words))
        if None in found:
            for word in words:
                if word not in known:
                    at = len(known)
                    if at == len(self.hashes):
                        self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
                    known[word] = at
                    self.hashes[at] = xxhash.xxh64_intdigest(word)
            found = list(map(known.__getitem__, words))
        return np.array(found, np.int64)


def shingles(text: bytes | None, words: Words, size: int = SHINGLE) -> tuple[int, np.ndarray]:
    """The number of distinct shingles, and their sorted hashes."""
    found = (text or b"").translate(LOWER).split()  # splits at \x20 and \x09-\x0D
    if not found:
        return 0, np.zeros(0, np.uint64)
    numbers = words.numbers(found)
    size = min(size, len(numbers))
    if size <= 2:  # two numbers fit in one
        codes = numbers[: len(numbers) - size + 1] << 32 | numbers[size - 1 :]
        codes.sort()
        codes = codes[np.append(True, codes[1:] != codes[:-1])]
        places = (codes >> 32, codes & 0xFFFFFFFF)[:size]
    else:
        spans = np.lib.stride_tricks.sliding_window_view(numbers, size)
        places = np.unique(spans, axis=0).T
    mixed = np.full(len(places[0]), size, np.uint64)
    for place in places:
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + words.hashes[place])
    mixed.sort()
    return len(mixed), mixed


def signature(hashes: np.ndarray, count: int = HASHES) -> np.ndarray:
    """The least value of each hash function over a set; 32 bits each."""
    times, plus, room = _functions(count)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), CHUNK):
        part = short[at : at + CHUNK, None]
        values = room[: len(part)]
        np.multiply(part, times, out=values)
        np.add(values, plus, out=values)
        np.minimum(least, values.min(axis=0), out=least)
    return least.astype("<u4")


def prints(df: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """``id``, ``tag`` (unique), ``n_shingles``, and digest, signature and hashes of the set."""
    rows = df.select(
        column(df, id_column).alias("id"),
        F.monotonically_increasing_id().alias("tag"),
        F.encode(column(df, text_column).cast("string"), "UTF-8").alias("text"),
    )
    out = f"id {dict(rows.dtypes)['id']}, tag long, n_shingles long, digest binary, signature binary, hashes array<long>"

    def made(ids: pa.Array, tags: pa.Array, found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        sets = [hashes for _, hashes in found]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = np.concatenate(sets).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                ids,
                tags,
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ],
            ["id", "tag", "n_shingles", "digest", "signature", "hashes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            found, first, held = [], 0, 0
            for at, text in enumerate(batch.column(2)):
                found.append(shingles(text.as_py(), words, size))
                held += found[-1][1].nbytes
                if held > BYTES:
                    yield made(*(batch.column(i).slice(first, len(found)) for i in (0, 1)), found)
                    found, first, held = [], at + 1, 0
            if found:
                yield made(*(batch.column(i).slice(first, len(found)) for i in (0, 1)), found)

    return in_tasks(rows, run, out)


@lru_cache(maxsize=8)
def least_agreements(
    percent: int, miss: float, hashes: int = HASHES, batch: int = BATCH, values: float = 2.0**32
) -> tuple[int, ...]:
    """For each batch the least number of agreements up to its end that keeps a pair.

    Positions of few ``values`` also agree by chance, which is part of the limit.
    """
    t = percent / 100
    t += (1 - t) / values
    least = []
    for n in range(batch, hashes + 1, batch):
        chance, m = 0.0, 0
        while True:
            ways = lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m)
            chance += exp(ways + m * log(t) + (n + 1 - m) * log1p(-t)) if t < 1 else float(m > n)
            if chance >= miss:
                break
            m += 1
        least.append(m)
    return tuple(least)


def promising(left: np.ndarray, right: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which pairs of signatures (rows) are not given up, batch after batch."""
    alive = np.arange(len(right))
    agreements = np.zeros(len(right), np.int64)
    for number, wanted in enumerate(least):
        part = slice(number * BATCH, (number + 1) * BATCH)
        agreements = agreements + np.count_nonzero(left[alive, part] == right[alive, part], axis=1)
        stays = agreements >= wanted
        alive, agreements = alive[stays], agreements[stays]
    return alive


def promising_bits(
    one: np.ndarray, others: np.ndarray, least: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Which of the longer signatures, in 64-bit words, are not given up beside ``one``.

    And in how many bits they agree.
    """
    alive = np.arange(len(others))
    agreements = np.zeros(len(others), np.int64)
    words = LONG_BATCH // 64
    for number, wanted in enumerate(least):
        part = slice(number * words, (number + 1) * words)
        differ = np.bitwise_count(others[alive, part] ^ one[part]).sum(axis=1, dtype=np.int64)
        agreements = agreements + LONG_BATCH - differ
        stays = agreements >= wanted
        alive, agreements = alive[stays], agreements[stays]
        if not len(alive):
            break
    return alive, agreements


def _in_pairs(rows: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """The rows whose key is in a pair, so that no others are shuffled to the pairs.

    More than ``FEW_NODES`` are not broadcast; then all rows are shuffled once.
    """
    met = pairs.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    met = materialise(met, "minhash-met")
    few = met.limit(FEW_NODES + 1).count() <= FEW_NODES
    return rows.join(F.broadcast(met) if few else met, key, "left_semi")


def _surviving(pairs: DataFrame, nodes: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs ``a``, ``b`` that their signatures do not rule out."""
    nodes = _in_pairs(nodes.select("node", "signature"), "node", pairs)
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("of_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("of_b"))
    signed = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")

    least = least_agreements(percent, miss)

    def matrix(values: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(values.to_pylist()), "<u4").reshape(-1, HASHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = promising(matrix(batch.column(2)), matrix(batch.column(3)), least)
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return in_tasks(signed, run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    sets = _in_pairs(sets, "tag", pairs)
    left = sets.select(F.col("tag").alias("a"), F.col("hashes").alias("set_a"))
    right = sets.select(F.col("tag").alias("b"), F.col("hashes").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * either).select("a", "b")


def _keys() -> Column:
    """The key of each band."""
    width = 4 * ROWS
    return F.array(
        *[F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(BANDS)]
    )


def _keyed(nodes: DataFrame) -> DataFrame:
    """Each node under the key of each of its bands."""
    return nodes.select("node", "n_shingles", F.explode(_keys()).alias("key"))


def _pairs(left: Column, right: Column, percent: int) -> Column:
    """Sets whose sizes allow the similarity."""
    return 100 * F.least(left, right) >= percent * F.greatest(left, right)


def _long_signatures(sets: DataFrame) -> DataFrame:
    """``node`` and its longer signature, the low bit of each minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for hashes in batch.column(1):
                values = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found.append(np.packbits(signature(values, LONG) & 1).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["node", "long"]
            )

    return in_tasks(sets.select("tag", "hashes"), run, "node long, long binary")


def compared(
    nodes: np.ndarray,
    sizes: np.ndarray,
    roots: np.ndarray,
    long: np.ndarray,
    blocks: np.ndarray,
    percent: int,
    least: tuple[int, ...],
) -> list[tuple[int, int, int]]:
    """Pairs ``a < b`` of one block, or of two different ones, that are not given up.

    With the number of bits in which they agree.

    Only pairs of different components whose sizes allow the similarity are compared.
    """
    apart = blocks[0] != blocks[-1]
    rows = np.flatnonzero(blocks == blocks[0]) if apart else np.arange(len(nodes))
    found = []
    for row in rows.tolist():
        others = np.flatnonzero(blocks != blocks[row]) if apart else np.arange(row + 1, len(nodes))
        small, large = np.minimum(sizes[others], sizes[row]), np.maximum(sizes[others], sizes[row])
        others = others[(roots[others] != roots[row]) & (100 * small >= percent * large)]
        if len(others):
            keep, agree = promising_bits(long[row], long[others], least)
            mine = int(nodes[row])
            kept = zip(nodes[others[keep]].tolist(), agree.tolist())
            found += [(min(mine, other), max(mine, other), n) for other, n in kept]
    return found


def linked(
    nodes: np.ndarray,
    roots: np.ndarray,
    long: np.ndarray,
    blocks: np.ndarray,
    keys: np.ndarray,
    key: int,
    sets: list[np.ndarray],
    percent: int,
    least: tuple[int, ...],
) -> list[tuple[int, int]]:
    """Pairs ``a < b`` of similar sets that join components, of one block or two different ones.

    A pair is compared where ``key`` is the first that both have.
    """
    apart = blocks[0] != blocks[-1]
    rows = np.flatnonzero(blocks == blocks[0]) if apart else np.arange(len(nodes))
    roots, sizes = roots.copy(), np.array([len(s) for s in sets])
    found = []
    for row in rows.tolist():
        others = np.flatnonzero(blocks != blocks[row]) if apart else np.arange(row + 1, len(nodes))
        small, large = np.minimum(sizes[others], sizes[row]), np.maximum(sizes[others], sizes[row])
        others = others[(roots[others] != roots[row]) & (100 * small >= percent * large)]
        first = (keys[others] == keys[row]).argmax(axis=1)
        others = others[keys[row][first] == key]
        if not len(others):
            continue
        keep, agree = promising_bits(long[row], long[others], least)
        best = others[keep][np.argsort(-agree, kind="stable")]
        for part in (best[:DENSE], best[DENSE:]):
            part = part[roots[part] != roots[row]]
            for other in part[_similar(row, part, sets, sizes, percent)].tolist():
                if roots[other] != roots[row]:
                    found.append(tuple(sorted((int(nodes[row]), int(nodes[other])))))
                    roots[roots == roots[other]] = roots[row]
    return found


def _similar(row: int, others: np.ndarray, sets: list[np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the other sets are similar enough, by all their shingles."""
    both = np.zeros(len(others), np.int64)
    at_once = max(1, (1 << 20) // max(sizes[others], default=1))
    for k in range(0, len(others), at_once):
        part = others[k : k + at_once]
        flat = np.concatenate([sets[other] for other in part.tolist()])
        place = np.minimum(np.searchsorted(sets[row], flat), sizes[row] - 1)
        starts = np.cumsum(sizes[part]) - sizes[part]
        both[k : k + at_once] = np.add.reduceat((sets[row][place] == flat).astype(np.int64), starts)
    return 100 * both >= percent * (sizes[row] + sizes[others] - both)


def _by_block(members: DataFrame, of_block, out: str) -> DataFrame:
    """``of_block`` of the members in each block of a bucket, and in each two."""
    count = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), count).cast("int")
    others = [c for c in members.columns if c not in ("key", "n")]
    dealt = members.select("key", *others, own.alias("own"), count.alias("count"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("other"))
    ordered = (
        dealt.select(
            "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", *others
        )
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "own", "node")
    )
    names = [field.split()[0] for field in out.split(", ")]

    def made(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        own = rows.column("own").to_numpy()
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        both = low == high or (own[0] == low and own[-1] == high)  # a block may be empty
        found = of_block(rows) if both else []
        columns = zip(*found) if found else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2)]
            changes = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            starts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
            for start, end in zip(starts, starts[1:]):
                group = tuple(int(c[start]) for c in columns)
                if group != key and held:
                    yield made(held)
                    held = []
                key = group
                held.append(batch.slice(start, end - start))
        if held:
            yield made(held)

    return in_tasks(ordered, run, out)


def _bits(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("long").to_pylist()), np.uint64).reshape(-1, LONG // 64)


def _in_block(rows: pa.Table, percent: int, least: tuple[int, ...]) -> list[tuple[int, int, int]]:
    own, nodes, sizes, roots = (rows.column(k).to_numpy() for k in ("own", "node", "n_shingles", "root"))
    return compared(nodes, sizes, roots, _bits(rows), own, percent, least)


def _in_blocks(members: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs that survive in members (``key``, ``n``, ``node``, ``n_shingles``, ``root``, ``long``)."""
    least = least_agreements(percent, miss, LONG, LONG_BATCH, 2.0)
    return _by_block(members, lambda rows: _in_block(rows, percent, least), "a long, b long, agree long").distinct()


def _with_survivors(members: DataFrame, percent: int, miss: float) -> DataFrame:
    """``key`` and ``node`` of the members that are in a pair that survives."""
    least = least_agreements(percent, miss, LONG, LONG_BATCH, 2.0)

    def of_block(rows: pa.Table) -> list[tuple[int, int]]:
        key = rows.column("key")[0].as_py()
        return [(key, node) for node in {n for a, b, _ in _in_block(rows, percent, least) for n in (a, b)}]

    return _by_block(members, of_block, "key long, node long").distinct()


def _linked_in_blocks(members: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links that join components among members with ``keys`` and ``hashes`` too."""
    least = least_agreements(percent, miss, LONG, LONG_BATCH, 2.0)

    def of_block(rows: pa.Table) -> list[tuple[int, int]]:
        own, nodes, roots = (rows.column(k).to_numpy() for k in ("own", "node", "root"))
        keys = np.array(rows.column("keys").to_pylist(), np.int64)
        sets = [s.values.to_numpy().view(np.uint64) for s in rows.column("hashes")]
        return linked(
            nodes, roots, _bits(rows), own, keys, rows.column("key")[0].as_py(), sets, percent, least
        )

    return _by_block(members, of_block, "a long, b long").distinct()


def links(nodes: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs ``a < b`` of similar nodes that connect all that similar pairs connect."""
    sizes = materialise(
        _keyed(nodes).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "n_shingles")).alias("leader")).where("n > 1"),
        "minhash-sizes",
    )
    members = materialise(_keyed(nodes).join(sizes, "key"), "minhash-members")
    first = members.where(F.col("node") != F.col("leader.node"))
    first = first.where(_pairs(F.col("n_shingles"), F.col("leader.n_shingles"), percent))
    pairs = first.select(F.col("leader.node").alias("a"), F.col("node").alias("b")).distinct()
    pairs = materialise(pairs, "minhash-pairs")
    left = materialise(_surviving(pairs, nodes, percent, miss), "minhash-surviving")
    found = materialise(_verified(left, sets, percent), "minhash-links")

    members = members.where("n > 2").select("key", "n", "node", "n_shingles")
    rooted = members.join(connected(found), "node", "left").select(
        *members.columns, F.coalesce("root", "node").alias("root")
    )
    rooted = materialise(rooted, "minhash-rooted")
    state = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = materialise(state.where("low != high").select("key"), "minhash-mixed")
    rest = materialise(rooted.join(mixed, "key"), "minhash-rest")
    if rest.isEmpty():
        return found
    ends = rest.select(F.col("node").alias("a"), F.col("node").alias("b"))
    long = materialise(_long_signatures(_in_pairs(sets, "tag", ends)), "minhash-long")
    rest = rest.join(long, "node")
    left = materialise(_with_survivors(rest, percent, miss), "minhash-left")
    if left.isEmpty():
        return found
    ends = left.select(F.col("node").alias("a"), F.col("node").alias("b"))
    whole = _in_pairs(sets, "tag", ends).select(F.col("tag").alias("node"), "hashes")
    keys = _in_pairs(nodes, "node", ends).select("node", _keys().alias("keys"))
    crowds = left.join(rest.select("key", "node", "n_shingles"), ["key", "node"]).groupBy("key").agg(
        F.greatest(F.count(F.lit(1)), F.floor(F.sum("n_shingles") / LONG_SET)).alias("n")
    )
    rest = left.join(rest.drop("n"), ["key", "node"]).join(materialise(crowds, "minhash-crowds"), "key")
    more = _linked_in_blocks(rest.join(keys, "node").join(whole, "node"), percent, miss)
    return materialise(found.unionByName(more), "minhash-found")


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    miss: float = MISS,
) -> DataFrame:
    """One row for each row of ``df``: id, ``n_shingles``, ``component_id``, ``kept``."""
    made = materialise(prints(df, id_column, text_column, shingle), "minhash-prints")
    filled = made.where("n_shingles > 0")
    # Equal sets are one node; of equal signatures any is the same.
    nodes = materialise(
        filled.groupBy("digest").agg(
            F.min("tag").alias("node"),
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("first"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
        ),
        "minhash-nodes",
    )
    found = links(nodes.select("node", "signature", "n_shingles"), made.select("tag", "hashes"), percent, miss)
    star = connected(found)
    rooted = nodes.join(star, "node", "left").select(
        "digest", "first", F.coalesce("root", "node").alias("root")
    )
    lowest = materialise(rooted.groupBy("root").agg(F.min("first").alias("lowest")), "minhash-lowest")
    labels = materialise(
        rooted.join(lowest, "root").select("digest", F.col("lowest.id").alias("component_id")),
        "minhash-labels",
    )
    linked = filled.join(labels, "digest").select("id", "n_shingles", "component_id")
    alone = made.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
