"""Centroids, MinHash and the manifest against brute force, and on awkward rows."""

import collections
import hashlib
import random
import re
import zlib
from math import comb

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obs_engine.llm import centroids, merkle, minhash


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda t: tuple(map(str, t)))


# Centroids


def lloyd(vectors, ids, clusters, rounds):
    """Plain rounds over all distances."""
    hashes = [hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i in ids]
    first = sorted(range(len(ids)), key=lambda k: (hashes[k], vectors[k].tolist()))[:clusters]
    places = vectors[first]
    for number in range(rounds + 1):
        found = ((vectors[:, None] - places[None]) ** 2).sum(-1)
        nearest = found.argmin(1)
        if number < rounds:
            places = np.array(
                [
                    vectors[nearest == c].sum(0) // (nearest == c).sum() if (nearest == c).any() else places[c]
                    for c in range(len(places))
                ]
            )
    return nearest, found.min(1), places


def expected_rows(vectors, ids, clusters, rounds):
    nearest, distance, places = lloyd(vectors, ids, clusters, rounds)
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in places.tolist()]
    return [
        (i, c, d, int(distance[nearest == c].sum()), int(distance.sum()), digests[c])
        for i, c, d in zip(ids, nearest.tolist(), distance.tolist())
    ]


def test_centroids_equal_plain_rounds(spark):
    draw = np.random.default_rng(3)
    middles = draw.normal(size=(9, 4))
    vectors = middles[draw.integers(0, 9, 700)] + 0.3 * draw.normal(size=(700, 4))
    vectors[:250] = vectors[0]  # a hot vector
    vectors[250:300] = np.round(vectors[250:300])  # ties
    ids = [*range(650), *[None] * 20, *[7] * 30]
    rows = [(i, v, "x", 1) for i, v in zip(ids, vectors.tolist())]
    bad = [(800, None), (801, [1.0]), (802, [1.0, None, 2.0, 3.0]), (803, [float("nan")] * 4), (804, [float("inf")] * 4), (805, [])]
    schema = "vec_id long, embedding array<double>, cluster string, distance int"
    df = spark.createDataFrame(rows + [(*b, "y", 2) for b in bad], schema).repartition(5)
    found = centroids.cluster(df, dimension=4, clusters=12, rounds=4)
    whole = np.floor(256 * vectors).astype(np.int64)
    assert ordered(found.collect()) == ordered(expected_rows(whole, ids, 12, 4))


def test_centroids_of_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [None, 1.0])], schema)
    found = centroids.cluster(two, dimension=2).collect()
    assert sorted((r.vec_id, r.cluster, r.distance, r.inertia) for r in found) == [(1, 0, 0, 0), (2, 0, 0, 0)]
    assert centroids.cluster(two, dimension=3).count() == 0
    assert centroids.cluster(two.limit(0)).columns == centroids.cluster(two, dimension=2).columns
    wide = spark.createDataFrame([(1, [1e9, 0.0])], schema)
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(wide, dimension=2).collect()


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(2, 6), st.sampled_from([0.01, 0.3, 3.0]), st.sampled_from([0.0, 0.1, 1.0, 5.0]))
def test_no_point_of_a_sphere_comes_nearer_than_its_bound(seed, size, move, radius):
    draw = np.random.default_rng(seed)
    old, centre = 3 * draw.normal(size=(2, size))
    new = old + move * draw.normal(size=size)
    bound = centroids.approach(centre[None], np.array([radius]), old, new)[0]
    points = draw.normal(size=(500, size))
    points *= radius * draw.random((500, 1)) ** 0.2 / np.linalg.norm(points, axis=1)[:, None]
    points += centre
    gains = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
    assert gains.max() <= bound + 1e-9
    assert bound <= np.linalg.norm(new - old) * (1 + 1e-9)


def test_bounds_spare_most_distances():
    draw = np.random.default_rng(8)
    middles = 400 * draw.normal(size=(10, 16))
    vectors = (middles[draw.integers(0, 10, 4000)] + 60 * draw.normal(size=(4000, 16))).astype(np.int64)
    at = centroids.Centroids.at(vectors[:10])
    state = centroids.scan(vectors, at.places)
    scanned, least = [], []
    for _ in range(6):
        sums = centroids.Sums(10, 16)
        sums.add(vectors, state, None)
        there = np.maximum(sums.rows, 1)[:, None]
        moved = np.where(sums.rows[:, None] > 0, sums.parts // there, at.places)
        at = at.moved(moved, sums.radius)
        least.append((at.loosening < at.drift.max() * 0.9).sum())
        state = centroids.reassign(vectors, state, at)
        exact = centroids.squared(vectors, at.places)
        assert (state.cluster == exact.argmin(axis=1)).all()
        scanned.append(state.scanned)
    assert sum(least) > 0 and scanned[-1] < 400


def test_exact_distances_of_large_components():
    draw = np.random.default_rng(5)
    vectors, places = (draw.integers(-centroids.LARGEST, centroids.LARGEST, (n, 8)) for n in (20, 3))
    want = [[sum((a - b) ** 2 for a, b in zip(v, p)) for p in places.tolist()] for v in vectors.tolist()]
    assert centroids.squared(vectors, places).tolist() == want


# MinHash


def components(rows, size=2):
    """Components by all pairs of distinct sets."""
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(minhash.LOWER))
        spans = zip(*(words[k:] for k in range(size)))
        sets.append(frozenset([tuple(words)] if 0 < len(words) < size else spans))
    distinct = list({s for s in sets if s})
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for k, s in enumerate(distinct):
        for t in distinct[:k]:
            if 100 * len(s & t) >= 80 * len(s | t):
                parent[root(s)] = root(t)
    lowest = {}
    for (i, _), s in zip(rows, sets):
        if s:
            key = (i is None, i or 0)
            lowest[root(s)] = min(lowest.get(root(s), key), key)
    out = []
    for (i, _), s in zip(rows, sets):
        c = (None if lowest[root(s)][0] else lowest[root(s)][1]) if s else i
        out.append((i, len(s), c, i == c))
    return out


@pytest.mark.parametrize("dense", [8, 0])
def test_components_equal_all_pairs(spark, dense, monkeypatch):
    monkeypatch.setattr(minhash, "DENSE", dense)
    draw = random.Random(2)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(300):  # a crowd about the limit: more in a bucket than are compared at first
        words = list(base)
        for _ in range(draw.randrange(14)):
            words[draw.randrange(100)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{k}" for k in range(60)]
    rows += [(400 + k, " ".join(chain[k : k + 40])) for k in range(20)]  # linked one by one only
    rows += [(None, rows[0][1]), (None, "solo"), (900, "Solo"), (901, None), (902, " \n"), (903, "A b"), (904, "a  B"), (904, "a B")]
    rows += [(1000, " ".join(base * 3000)), (1001, "x" * 100_000), (1002, " ".join(f"v{k}" for k in range(50_000)))]
    df = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, node string, key int")
    found = minhash.near_duplicates(df.repartition(4))
    assert ordered(found.collect()) == ordered(components(rows))
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_shingles_of_any_size():
    words = minhash.Words()
    text = b"a b a b c a b"
    assert minhash.shingles(text, words, 1)[0] == 3
    assert minhash.shingles(text, words, 2)[0] == 4
    assert minhash.shingles(text, words, 3)[0] == 5
    assert minhash.shingles(text, words, 9)[0] == 1
    assert minhash.shingles(b"", words)[0] == minhash.shingles(None, words)[0] == 0
    same = [minhash.shingles(t, minhash.Words())[1].tolist() for t in (b"p q r", b"Q R p q r", b"p q")]
    assert set(same[2]) < set(same[0]) < set(same[1])


@pytest.mark.parametrize("miss", [1e-6, 1e-3, 0.1])
def test_pairs_are_given_up_below_the_chance_to_miss(miss):
    least = minhash.least_agreements(80, miss)
    for n, m in zip(range(minhash.BATCH, minhash.HASHES + 1, minhash.BATCH), least):

        def at_least(m):  # integral of the posterior from the limit on
            x = np.linspace(0.8, 1, 20_001)
            density = (n + 1) * comb(n, m) * x**m * (1 - x) ** (n - m)
            return np.trapezoid(density, x)

        assert at_least(m) >= miss * 0.999
        assert m == 0 or at_least(m - 1) < miss * 1.001
    bits = minhash.least_agreements(80, miss, minhash.LONG, minhash.LONG_BATCH, 2.0)
    shares = [m / n for n, m in zip(range(minhash.LONG_BATCH, minhash.LONG + 1, minhash.LONG_BATCH), bits)]
    assert shares == sorted(shares) and 0.8 < shares[0] and 0.87 < shares[-1] < 0.9


def test_batches_keep_what_one_look_would():
    draw = np.random.default_rng(4)
    left = draw.integers(0, 1 << 32, (300, minhash.HASHES), np.uint32)
    right = np.where(draw.random((300, minhash.HASHES)) < draw.random((300, 1)), left, left + 1)
    least = minhash.least_agreements(80, 1e-6)
    keep = minhash.promising(left, right, least)
    want = [
        k
        for k in range(300)
        if all((left[k, : (b + 1) * minhash.BATCH] == right[k, : (b + 1) * minhash.BATCH]).sum() >= m for b, m in enumerate(least))
    ]
    assert keep.tolist() == want and 0 < len(want) < 300


def test_bits_keep_what_one_look_would():
    draw = np.random.default_rng(4)
    one = draw.integers(0, 2, minhash.LONG)
    noise = draw.random((200, minhash.LONG)) < draw.random((200, 1)) * 0.3
    bits = np.where(noise, 1 - one, one).astype(np.uint8)
    least = minhash.least_agreements(80, 1e-6, minhash.LONG, minhash.LONG_BATCH, 2.0)
    packed = [np.packbits(b, axis=-1).view(np.uint64) for b in (one.astype(np.uint8), bits)]
    keep, counts = minhash.promising_bits(packed[0], packed[1], least)
    assert counts.tolist() == (bits == one).sum(axis=1)[keep].tolist()
    agree = np.cumsum(bits == one, axis=1)[:, minhash.LONG_BATCH - 1 :: minhash.LONG_BATCH]
    want = np.flatnonzero((agree >= np.array(least)).all(axis=1))
    assert keep.tolist() == want.tolist() and 0 < len(want) < 200


@pytest.mark.parametrize("block", [1024, 7])
def test_blocks_compare_each_pair_once(spark, block, monkeypatch):
    """Two similar families and strangers in one bucket; all pairs across components count."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2, (2, minhash.LONG))
    rows = []
    for node in range(60):
        noise = draw.random(minhash.LONG) < 0.03
        bits = np.where(noise, draw.integers(0, 2, minhash.LONG), base[node % 2]).astype(np.uint8)
        rows.append((1, 60, node, 100, node // 4, bytearray(np.packbits(bits).tobytes())))
    schema = "key long, n long, node long, n_shingles long, root long, long binary"
    found = minhash._in_blocks(spark.createDataFrame(rows, schema), 80, 1e-6).collect()
    want = {(a, b) for b in range(60) for a in range(b) if a % 2 == b % 2 and a // 4 != b // 4}
    assert sorted((r.a, r.b) for r in found) == sorted(want) and min(r.agree for r in found) > 4600


@pytest.mark.parametrize("dense", [8, 0])
def test_a_family_gives_fewer_links_than_nodes(dense, monkeypatch):
    """Pairs about the limit in two blocks; links connect what all similar pairs connect."""
    monkeypatch.setattr(minhash, "DENSE", dense)
    draw = np.random.default_rng(8)
    pool = np.unique(minhash._mixed(draw.integers(0, 1 << 63, 20_000, np.uint64)))
    base = draw.permutation(pool[:200])
    sets = []
    for k in range(120):
        own = base.copy()
        own[draw.permutation(200)[: draw.integers(0, 30)]] = pool[200 + k * 30 : 201 + k * 30]
        sets.append(np.unique(own))
    long = np.stack([np.packbits(minhash.signature(s, minhash.LONG) & 1).view(np.uint64) for s in sets])
    nodes, blocks = np.arange(120), np.sort(draw.integers(0, 2, 120))
    least = minhash.least_agreements(80, 1e-6, minhash.LONG, minhash.LONG_BATCH, 2.0)

    def found(rows, keys, key):
        return minhash.linked(
            nodes[rows], nodes[rows], long[rows], blocks[rows], keys[rows], key, [sets[r] for r in rows], 80, least
        )

    def components(pairs):
        root = list(range(120))
        for a, b in pairs:
            root = [root[a] if r == root[b] else r for r in root]
        return [root.index(r) for r in root]

    keys = np.full((120, 3), 5)
    halves = [np.flatnonzero(blocks == 0), np.flatnonzero(blocks == 1), nodes]
    links = [found(rows, keys, 5) for rows in halves]
    similar = [
        (a, b)
        for b in range(120)
        for a in range(b)
        if 100 * len(both := np.intersect1d(sets[a], sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - len(both))
    ]
    assert all(len(part) < len(rows) for part, rows in zip(links, halves)) and len(similar) > 1000
    assert set(sum(links, [])) <= set(similar)
    assert components(sum(links, [])) == components(similar)
    keys[:, 1] = 6
    assert found(nodes, keys, 6) == []  # a pair meets in the first bucket it shares


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(6)
    pool = minhash._mixed(draw.integers(0, 1 << 63, 3000, np.uint64))
    agree = []
    for start in range(40):
        a, b = pool[start * 20 : start * 20 + 900], pool[start * 20 + 100 : start * 20 + 1000]
        agree.append((minhash.signature(a) == minhash.signature(b)).mean())
    assert np.mean(agree) == pytest.approx(0.8, abs=0.02)


# Manifest


def hashed(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([hashed("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def way(tree, at):
    found = []
    for nodes in tree[:-1]:
        first = at - at % 16
        found.append((at - first, nodes[first : first + 16]))
        at //= 16
    return found


def manifest(rows):
    """Rows of (doc_id, text, lang, source, n_chars), whole trees in memory."""

    def leaf(row, text):
        values = (row[0], row[3], row[2], row[4], text)
        return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    groups = collections.defaultdict(list)
    for row in rows:
        chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        other = leaf(row, row[1] and row[1].translate(lower)) if chosen else None
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), other, row[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, row in enumerate(sorted(groups[g], key=lambda r: r[:3])):
            path = way(trees[g], at) + way(top, place)
            proof = "".join("".join(nodes[:k] + nodes[k + 1 :]) for k, nodes in path)
            node, copies = row[3] or row[2], []
            for k, nodes in path:
                node = hashed("".join(nodes[:k] + [node] + nodes[k + 1 :]))
                copies.append(node)
            root = top[-1][0]
            out.append(
                (row[4], row[2], trees[g][-1][0], root, hashed(proof), node, copies if row[3] else None, node == root)
            )
    return out


def manifest_rows(count):
    draw = random.Random(4)
    sources = ["hot"] * 900 + [None, "", "é", "z", "a|b"] + [f"s{k}" for k in range(400)]
    texts = [None, "", "Abc", "x", "ÄB"]
    rows = [
        (None if i % 97 == 5 else i, draw.choice(texts), draw.choice([None, "en"]), draw.choice(sources), draw.choice([None, 5]))
        for i in range(count)
    ]
    return rows + rows[:7] + [(count + 9, "Z " * 200_000, "en", "long", 3)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, grp int, idx int"


@pytest.mark.parametrize("height", [1, 3])
def test_manifest_equals_whole_trees(spark, height):
    rows = manifest_rows(1500)
    df = spark.createDataFrame([(*r, "l", 1, 2) for r in rows], SCHEMA).repartition(6)
    found = merkle.manifest(df, height=height)
    assert ordered(found.collect()) == ordered([(*r[:6], r[6], r[7]) for r in manifest(rows)])


@pytest.mark.parametrize("count", [0, 1, 2, 16, 17])
def test_manifest_of_few_rows(spark, count):
    rows = [(k, "Text", None, "s", 4) for k in range(count)]
    df = spark.createDataFrame([(*r, "l", 1, 2) for r in rows], SCHEMA)
    assert ordered(merkle.manifest(df).collect()) == ordered(manifest(rows))


def test_versions_copy_only_ancestors(spark):
    rows = [(k, f"Text {k}", None, "s", 4) for k in range(300)]
    df = spark.createDataFrame([(*r, "l", 1, 2) for r in rows], SCHEMA)
    found = merkle.manifest(df, height=1)
    copies = merkle.versions(found).collect()
    by_version = collections.defaultdict(dict)
    for r in copies:
        by_version[r.doc_id][r.level] = r.node
    chosen = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    roots = {r.doc_id: r.folded_root for r in found.collect()}
    assert sorted(by_version) == chosen
    for version, nodes in by_version.items():  # three levels over 300 leaves, none over one group
        assert sorted(nodes) == [1, 2, 3] and nodes[3] == roots[version]


def test_untampered_rows_verify(spark):
    rows = [(k, "all lower case", None, "s", 4) for k in range(40)]
    df = spark.createDataFrame([(*r, "l", 1, 2) for r in rows], SCHEMA)
    assert merkle.manifest(df).where("not verified").count() == 0
    upper = spark.createDataFrame([(*r[:1], r[1].upper(), *r[2:], "l", 1, 2) for r in rows], SCHEMA)
    chosen = sum(zlib.crc32(str(k).encode()) % 5 == 0 for k in range(40))
    assert merkle.manifest(upper).where("not verified").count() == chosen
