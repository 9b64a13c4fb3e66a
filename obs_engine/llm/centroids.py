"""K-means rounds that skip most distances by bounds on the drift of centroids.

Each vector carries its cluster, an upper bound of the distance to that centroid and a lower
bound of the distance to any other. When centroids move, the upper bound grows by the drift
of the own one. The lower bound need not shrink by the largest drift of the others: all
vectors of a cluster lie in a sphere around its centroid, and how much nearer a moved
centroid can have come to any point of that sphere is a question in a plane. There the old
and the new place of the moved centroid are the foci of hyperbolas on which the difference of
the distances is constant, and a point that is seen from the middle between the foci at an
angle w from the direction of the move gains at most ``drift * cos(w)`` (nothing beyond a right
angle). The tangent from the middle to the sphere gives the smallest such angle. A vector whose
bounds leave its cluster in doubt gets its own distance, then all of them.

Vectors are integers, so distances and means are exact; bounds are kept on the safe side of
rounding. Each round is one pass that writes vectors with their bounds, and one row for each
task and cluster with sums; no vector is shuffled. What goes through the driver is bounded by
clusters times dimensions.

Defined results: a vector that is null, has another number of components, or a null or
non-finite one is left out; an id that is null counts as empty text in the hash, and equal
hashes are in the order of the vectors; repeated rows count as often as they occur; with fewer
vectors than clusters there are as many clusters as vectors; a table without vectors gives no
rows. A component beyond ``LARGEST`` after scaling is an error, as its squares would leave
64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.llm.common import column, discard, in_tasks
from obs_engine.session import scratch_path

LARGEST = 1 << 26  # up to 512 squares of differences of such stay below 2^63
ROUNDING = 1e-12  # far more than a few operations in double precision lose
SLACK = 1e-6  # radians; near its ends the inverse sine has half of the digits


@dataclass(frozen=True)
class Centroids:
    """Where the centroids are, and what moving there from the last place did to bounds.

    ``drift``: how far each one moved. ``loosening``: how much nearer any other one may have
    come to a vector of the cluster. ``half``: half of the distance to the next centroid.
    """

    places: np.ndarray
    drift: np.ndarray
    loosening: np.ndarray
    half: np.ndarray

    @staticmethod
    def at(places: np.ndarray) -> Centroids:
        zero = np.zeros(len(places))
        return Centroids(places, zero, zero, half_gaps(places))

    def moved(self, places: np.ndarray, radius: np.ndarray) -> Centroids:
        drift = np.sqrt(((places - self.places).astype(float) ** 2).sum(axis=1))
        return Centroids(
            places,
            drift * (1 + ROUNDING),
            loosening(self.places, places, radius),
            half_gaps(places),
        )


def half_gaps(places: np.ndarray) -> np.ndarray:
    """Half of the distance from each centroid to the nearest other; infinite for one alone."""
    found = np.full(len(places), np.inf)
    for i in range(len(places)):
        gaps = np.sqrt(((places - places[i]).astype(float) ** 2).sum(axis=1))
        gaps[i] = np.inf
        found[i] = gaps.min() / 2
    return found * (1 - ROUNDING)


def approach(centre: np.ndarray, radius: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each sphere, how much nearer to any point of it ``new`` can be than ``old``."""
    move = (new - old).astype(float)
    drift = np.sqrt((move**2).sum())
    if drift == 0:
        return np.zeros(len(centre))
    seen = centre - (old + new) / 2  # from the middle between the two places
    far = np.sqrt((seen**2).sum(axis=1))
    wide = radius * (1 + 1e-9)
    outside = far > wide
    safe = np.where(outside, far, 1.0)
    direction = np.arccos(np.clip(seen @ (move / drift) / safe, -1, 1))
    tangent = direction - np.arcsin(np.clip(np.where(outside, wide, 0) / safe, 0, 1)) - SLACK
    gain = np.cos(np.clip(tangent, 0, np.pi / 2))
    return drift * (1 + ROUNDING) * np.where(outside, gain, 1.0)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster the greatest approach of any other centroid to its sphere."""
    greatest = np.zeros(len(old))
    for j in range(len(old)):
        near = approach(old, radius, old[j], new[j])
        near[j] = 0
        greatest = np.maximum(greatest, near)
    return greatest


def squared(vectors: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to centroids."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(places).max(initial=0)))
    if 4 * vectors.shape[1] * largest**2 < 1 << 53:  # whole numbers that doubles can hold
        v, p = vectors.astype(float), places.astype(float)
        found = (v * v).sum(axis=1)[:, None] - 2 * (v @ p.T) + (p * p).sum(axis=1)
        return found.astype(np.int64)
    return np.stack([own_squared(vectors, np.broadcast_to(p, vectors.shape)) for p in places], axis=1)


def own_squared(vectors: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((vectors - places) ** 2).sum(axis=1)


@dataclass
class Assigned:
    """Clusters and bounds of some vectors; ``scanned`` of them needed all distances."""

    cluster: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    scanned: int


def scan(vectors: np.ndarray, places: np.ndarray) -> Assigned:
    """Nearest centroids by all distances; of equally near ones the smaller number."""
    found = squared(vectors, places)
    cluster = found.argmin(axis=1)
    rows = np.arange(len(vectors))
    upper = np.sqrt(found[rows, cluster].astype(float)) * (1 + ROUNDING)
    others = found.astype(float)
    others[rows, cluster] = np.inf
    lower = np.sqrt(others.min(axis=1)) * (1 - ROUNDING)
    return Assigned(cluster.astype(np.int32), upper, lower, len(vectors))


def reassign(vectors: np.ndarray, before: Assigned, to: Centroids) -> Assigned:
    """Nearest centroids after a move, where the bounds allow without their distances."""
    cluster = before.cluster.copy()
    upper = (before.upper + to.drift[cluster]) * (1 + ROUNDING)
    lower = before.lower - to.loosening[cluster]
    lower -= ROUNDING * np.abs(before.lower)
    sure = np.maximum(lower, to.half[cluster])
    doubt = np.flatnonzero(~(upper < sure))
    if len(doubt):
        own = own_squared(vectors[doubt], to.places[cluster[doubt]])
        upper[doubt] = np.sqrt(own.astype(float)) * (1 + ROUNDING)
        doubt = doubt[~(upper[doubt] < sure[doubt])]
    if len(doubt):
        found = scan(vectors[doubt], to.places)
        cluster[doubt], upper[doubt], lower[doubt] = found.cluster, found.upper, found.lower
    return Assigned(cluster, upper, lower, len(doubt))


class Sums:
    """Sums of a task by cluster: rows, components, largest upper bound, squared distances."""

    def __init__(self, clusters: int, dimension: int):
        self.rows = np.zeros(clusters, np.int64)
        self.parts = np.zeros((clusters, dimension), np.int64)
        self.radius = np.zeros(clusters)
        self.distance = [0] * clusters
        self.scanned = 0

    def add(self, vectors: np.ndarray, found: Assigned, distance: np.ndarray | None) -> None:
        for c in np.unique(found.cluster).tolist():
            chosen = found.cluster == c
            self.rows[c] += chosen.sum()
            self.parts[c] += vectors[chosen].sum(axis=0)
            self.radius[c] = max(self.radius[c], found.upper[chosen].max())
            if distance is not None:
                self.distance[c] += sum(distance[chosen].tolist())
        self.scanned += found.scanned


def _schema(id_type: str, last: bool) -> str:
    state = "distance long" if last else "vector binary, upper double, lower double"
    return (
        f"id {id_type}, cluster int, {state}, n long, parts array<long>, radius double,"
        " total decimal(38,0), scanned long"
    )


def _arrow(id_type: pa.DataType, last: bool) -> pa.Schema:
    state = (
        [("distance", pa.int64())]
        if last
        else [("vector", pa.binary()), ("upper", pa.float64()), ("lower", pa.float64())]
    )
    sums = [
        ("n", pa.int64()),
        ("parts", pa.list_(pa.int64())),
        ("radius", pa.float64()),
        ("total", pa.decimal128(38, 0)),
        ("scanned", pa.int64()),
    ]
    return pa.schema([("id", id_type), ("cluster", pa.int32()), *state, *sums])


def _rows(ids: pa.Array, vectors: np.ndarray, found: Assigned, distance, schema: pa.Schema):
    size = len(vectors)
    columns = {"id": ids, "cluster": pa.array(found.cluster)}
    if distance is None:
        width = 4 * vectors.shape[1]
        data = pa.py_buffer(np.ascontiguousarray(vectors, "<i4").tobytes())
        offsets = pa.py_buffer(np.arange(0, (size + 1) * width, width, dtype=np.int32).tobytes())
        columns |= {
            "vector": pa.Array.from_buffers(pa.binary(), size, [None, offsets, data]),
            "upper": pa.array(found.upper),
            "lower": pa.array(found.lower),
        }
    else:
        columns["distance"] = pa.array(distance)
    arrays = [columns.get(f.name, pa.nulls(size, f.type)) for f in schema]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def _summary(sums: Sums, last: bool, schema: pa.Schema) -> pa.RecordBatch:
    """One row for each cluster that the task met, told by its count."""
    met = np.flatnonzero(sums.rows).tolist()
    known = {
        "cluster": met,
        "n": sums.rows[met].tolist(),
        "parts": [None if last else sums.parts[c].tolist() for c in met],
        "radius": sums.radius[met].tolist(),
        "total": [sums.distance[c] for c in met],
        "scanned": [sums.scanned if c == met[0] else 0 for c in met],
    }
    arrays = [pa.array(known.get(f.name, [None] * len(met)), f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _integers(vectors: pa.Array, dimension: int, scale: float) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float) * scale
    if len(flat) and not np.abs(flat).max() < LARGEST:
        raise ValueError(f"a component of a vector is beyond {LARGEST / scale:g}")
    return np.floor(flat).astype(np.int64).reshape(-1, dimension)


def _stored(vectors: pa.Array, dimension: int) -> np.ndarray:
    offsets = np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset : vectors.offset + len(vectors) + 1]
    data = np.frombuffer(vectors.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view("<i4").astype(np.int64).reshape(-1, dimension)


def _pass(
    source: DataFrame, to: Centroids, dimension: int, scale: float, first: bool, last: bool, path: str
) -> DataFrame:
    """One round over the vectors (``first``: of the table, with all distances), written."""
    spark = source.sparkSession
    columns = _schema(source.schema["id"].dataType.simpleString(), last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(len(to.places), dimension)
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = _arrow(batch.schema.field(0).type, last)
            if first:
                vectors = _integers(batch.column(1), dimension, scale)
                found = scan(vectors, to.places)
            else:
                vectors = _stored(batch.column(1), dimension)
                state = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4)]
                found = reassign(vectors, Assigned(*state, 0), to)
            distance = own_squared(vectors, to.places[found.cluster]) if last else None
            sums.add(vectors, found, distance)
            yield _rows(batch.column(0), vectors, found, distance, schema)
        if schema is not None:
            yield _summary(sums, last, schema)

    made = in_tasks(source, run, columns)
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(columns).parquet(path)


def _kept(df: DataFrame, id_column: str, vector_column: str, dimension: int) -> DataFrame:
    vector = column(df, vector_column)
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    rows = df.select(column(df, id_column).alias("id"), vector.alias("vector"))
    return rows.where((F.size(vector) == dimension) & finite)


def _first_by_hash(kept: DataFrame, wanted: int, salt: str) -> list:
    """The vectors of the smallest hashes, in their order.

    Only rows below a limit that a few times as many are expected to pass come to the driver.
    """
    key: Column = F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit("")))
    hashed = kept.select("vector", F.sha2(key.cast("binary"), 256).alias("hash"))
    rows = kept.count()
    share = (4 * wanted + 200) / max(rows, 1)
    while True:
        limit = f"{min(int(share * 2**60), 2**60 - 1):015x}"
        few = hashed if share >= 1 else hashed.where(F.substring("hash", 1, 15) <= limit)
        found = sorted(few.orderBy("hash", "vector").limit(wanted).collect(), key=lambda r: (r["hash"], r["vector"]))
        if len(found) >= min(wanted, rows):
            return [r["vector"] for r in found]
        share *= 8


def _moved(state: DataFrame, before: Centroids) -> Centroids:
    """Centroids at the floors of the means of their vectors; without vectors they stay."""
    sums = state.where("n is not null")
    parts = sums.select("cluster", F.posexplode("parts").alias("place", "part"))
    totals = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    facts = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))
    places, radius = before.places.copy(), np.zeros(len(before.places))
    rows = {}
    for r in facts.collect():
        rows[r["cluster"]], radius[r["cluster"]] = r["n"], r["radius"]
    for r in totals.collect():
        places[r["cluster"], r["place"]] = int(r["part"]) // rows[r["cluster"]]
    return before.moved(places, radius)


def cluster(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    *,
    dimension: int = 64,
    clusters: int = 40,
    rounds: int = 5,
    scale: float = 256.0,
    salt: str = "2:",
) -> DataFrame:
    """One row for each vector: its id, ``cluster``, squared ``distance``, and the sums.

    ``cluster_inertia`` and ``inertia`` are sums of ``distance``, ``centroid_sha256`` is the hash
    of the final centroid's components joined by commas. See the module for what is left out.
    """
    spark: SparkSession = df.sparkSession
    kept = _kept(df, id_column, vector_column, dimension)
    chosen = _first_by_hash(kept, clusters, salt)
    out = f"`{id_column}` {kept.schema['id'].dataType.simpleString()}, cluster int, distance long"
    out += ", cluster_inertia long, inertia long, centroid_sha256 string"
    if not chosen:
        return spark.createDataFrame([], out)
    places = _integers(pa.array(chosen, pa.list_(pa.float64())), dimension, scale)
    at = Centroids.at(places)
    folder = scratch_path(spark, "centroids")
    state = None
    for number in range(rounds):
        source = kept if state is None else _vectors(state)
        state = _pass(source, at, dimension, scale, state is None, False, f"{folder}/{number}")
        if number:
            discard(spark, f"{folder}/{number - 1}")
        at = _moved(state, at)
    source = kept if state is None else _vectors(state)
    final = _pass(source, at, dimension, scale, state is None, True, f"{folder}/final")
    sums = final.where("n is not null").groupBy("cluster").agg(F.sum("total").alias("total"))
    totals = {r["cluster"]: int(r["total"]) for r in sums.collect()}
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in at.places.tolist()]
    whole = sum(totals.values())
    facts = [(c, totals[c], whole, digests[c]) for c in totals]
    about = spark.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    found = final.where("n is null").select(F.col("id").alias(id_column), "cluster", "distance")
    named = found.join(F.broadcast(about), "cluster")  # one row for each cluster
    return named.select(
        F.col(f"`{id_column}`"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _vectors(state: DataFrame) -> DataFrame:
    return state.where("n is null").select("id", "vector", "cluster", "upper", "lower")
