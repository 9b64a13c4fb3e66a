"""The operators on small tables: brute force, round trips, and awkward rows."""

import hashlib
import itertools
import pickle
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from obs_engine.llm import (
    attention_lm,
    exact_dedup,
    packing,
    quality,
    schemas_json,
    sentencepieces,
    simhash,
    token_counts,
    tool_calls,
    toxicity,
    training_order,
)
from obs_engine.llm.encoding import SubwordEncoder, default_tokenizer

SCHEMA = "doc_id long, text string, row string, tag long, digest string"
BASE = "the quick brown fox jumps over the lazy dog and runs away from the bear in the wood"


def long_text(n):
    return " ".join(f"w{k * 7919 % 1009}" for k in range(n))


ROWS = [
    (1, BASE, "a", 1, "x"),
    (2, BASE.replace(" ", " \n\t"), None, None, None),
    (3, None, "b", 2, "y"),
    (4, "", "b", 2, "y"),
    (5, long_text(5000), "c", 3, "z"),
    (6, BASE, "d", 4, "q"),
    (6, BASE, "d", 4, "q"),
    (None, BASE, "e", 5, "r"),
    (None, "only here \U0001f642 été", "e", 5, "r"),
    (8, " " * 50 + "x" * 3000, "f", 6, "s"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collapsed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# Exact duplicates


@pytest.mark.parametrize("rows_per_filter", [1 << 20, 3])
def test_exact_marks(docs, rows_per_filter):
    found = exact_dedup.mark_duplicates(docs, rows_per_filter=rows_per_filter).collect()
    assert len(found) == len(ROWS)
    groups = {}
    for doc, text, *_ in ROWS:
        groups.setdefault(hashlib.sha256(collapsed(text).encode()).hexdigest(), []).append(doc)
    for row in found:
        ids = groups[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == min((i for i in ids if i is not None), default=None)
    for digest in groups:
        assert sum(r.kept for r in found if r.text_sha256 == digest) == 1


@pytest.mark.parametrize("rows_per_filter", [1 << 20, 3])
def test_exact_drop_keeps_columns(docs, empty, rows_per_filter):
    found = exact_dedup.drop_duplicates(docs, rows_per_filter=rows_per_filter)
    assert found.columns == docs.columns
    texts = [collapsed(r.text) for r in found.collect()]
    assert sorted(texts) == sorted({collapsed(r[1]) for r in ROWS})
    assert exact_dedup.drop_duplicates(empty).count() == 0
    assert exact_dedup.mark_duplicates(empty).count() == 0


# SimHash


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(simhash.LOWER))
    spans = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 2:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in root}


def test_codewords_meet_at_one_error():
    """Of any two words one bit apart, one has its nearest codeword among the other's."""
    leaders = simhash.nearby()[:, 0]
    assert len(np.unique(simhash.syndromes(leaders))) == 2048
    errors = np.concatenate(([0], 1 << np.arange(23)))
    for error in errors:
        other = leaders ^ error
        near = leaders[:, None] ^ simhash.nearby()[simhash.syndromes(leaders)]
        far = other[:, None] ^ simhash.nearby()[simhash.syndromes(other)]
        assert ((near[:, :1] == far).any(1) | (far[:, :1] == near).any(1)).all()


@pytest.mark.parametrize("paired", [32, 2])
def test_links_lose_no_component(spark, paired):
    random = np.random.default_rng(3)
    prints = random.integers(0, 2**63, 40, dtype=np.int64).tolist()
    for p in prints[:20]:
        for _ in range(8):  # chains of neighbours
            a, b = random.integers(0, 63, 2).tolist()
            p = p ^ (1 << a) ^ (1 << b)
            prints.append(p)
    nodes = spark.createDataFrame([(p,) for p in set(prints)], "print long")
    links = simhash.links(nodes, paired)
    for a, b in links.collect():
        assert (a ^ b).bit_count() <= 2
    root = {r.node: r.root for r in simhash.connected(links).collect()}
    want = plain_components(set(prints))
    assert {p: root.get(p, p) for p in want} == want


def test_near_duplicates_against_brute_force(docs, empty):
    found = simhash.near_duplicates(docs).collect()
    prints = {doc: plain_print(text) for doc, text, *_ in ROWS if doc is not None}
    roots = plain_components({plain_print(r[1]) for r in ROWS})
    lowest = {}
    for doc, p in prints.items():
        lowest[roots[p]] = min(doc, lowest.get(roots[p], doc))
    for row in found:
        value = int(row.fingerprint, 16)
        if row.doc_id is not None:
            assert value == prints[row.doc_id]
        assert row.component_id == lowest.get(roots[value])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots.values()))
    assert simhash.near_duplicates(empty).count() == 0


def test_near_duplicates_of_documents(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    table = spark.read.parquet(path)
    texts = {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}
    prints = {doc: plain_print(text) for doc, text in texts.items()}
    roots = plain_components(set(prints.values()))
    lowest = {}
    for doc in sorted(prints, reverse=True):
        lowest[roots[prints[doc]]] = doc
    for row in simhash.near_duplicates(table).collect():
        assert int(row.fingerprint, 16) == prints[row.doc_id]
        assert row.component_id == lowest[roots[prints[row.doc_id]]]


# Encoding, packing, counts, order


@pytest.fixture(scope="module")
def exact_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_library(exact_ids, spark):
    own = SubwordEncoder(default_tokenizer(), remember=50)
    texts = [r[1] or "" for r in ROWS] + [
        "a  b\n\n c ", "\t x\x1c y \x85z", "I'm <|endoftext|> it's", "１２ ab　cd   e", " lead", "1\n 2", "\n",
    ]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == exact_ids(text), text[:80]


def test_packing_is_whole_and_tight(docs, empty, exact_ids):
    pieces = packing.with_checksum(packing.pack(docs), keep_ids=True).collect()
    per_sequence, per_doc = {}, {}
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length > 0
        per_sequence.setdefault(p.sequence_id, []).append(p)
        per_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for parts in per_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0 and at == parts[0].sequence_tokens
    want = sorted(
        np.array([*exact_ids(r[1] or ""), 1], "<u4").tobytes() for r in ROWS if r[0] not in (6, None)
    )
    got = sorted(
        b"".join(p.ids for p in sorted(parts, key=lambda p: p.start))
        for (doc, _), parts in per_doc.items()
        if doc not in (6, None)
    )
    assert got == want
    assert sum(p.length for p in pieces) == sum(len(exact_ids(r[1] or "")) + 1 for r in ROWS)
    assert packing.pack(empty).count() == 0


def test_step_groups_are_of_one_size(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    groups = packing.pack(table, step_tokens=4096).groupBy("step_group").agg(
        F.countDistinct("sequence_tokens").alias("sizes"), F.sum("length").alias("tokens")
    )
    assert all(r.sizes == 1 and r.tokens <= 4096 for r in groups.collect())


def test_token_counts(docs, empty, exact_ids):
    lengths = sorted(len(exact_ids(r[1] or "")) for r in ROWS)
    found = token_counts.limits(token_counts.length_histogram(docs), block=100).collect()
    assert sorted(r.context_limit for r in found) == sorted(set(lengths))
    for r in found:
        limit = r.context_limit
        assert r.documents == lengths.count(limit)
        assert r.tokens_total == sum(lengths) and r.documents_total == len(lengths)
        assert r.documents_above == sum(x > limit for x in lengths)
        assert r.tokens_above == sum(x for x in lengths if x > limit)
        assert r.tokens_truncated_total == sum(min(x, limit) for x in lengths)
    assert token_counts.token_counts(empty).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 64, 1000, 4097])
def test_feistel_permutes(spark, count):
    def places(key):
        place = training_order.feistel(F.col("id"), count, key)
        return [r.place for r in spark.range(count).select("id", place.alias("place")).orderBy("id").collect()]

    found = places(5)
    assert sorted(found) == list(range(count))
    if count > 64:
        assert found != places(6) and found != list(range(count))


def test_feistel_rounds_stay_few(spark):
    """No round doubles the expression of the one before it."""
    place = training_order.feistel(F.col("id"), 10**12, 5)
    plan = spark.range(5).select(place.alias("place"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 2 * training_order.ROUNDS


def test_training_order(spark, docs, empty, exact_ids):
    path = training_order.write_training_order(docs, 9, sequence_tokens=64, sequences_per_shard=20)
    kind = docs.schema["doc_id"].dataType
    found = training_order.read_training_order(spark, path, kind).collect()
    assert [r.slot for r in found] == list(range(len(found)))
    assert all(r.shard == r.slot // 20 and r.place == r.slot % 20 and len(r.ids) == 128 for r in found)
    assert all(set(np.frombuffer(r.ids, "<u2")[r.n_tokens :].tolist()) <= {0} for r in found)
    ids = [*exact_ids(ROWS[4][1]), 1]
    mine = sorted((r for r in found if r.id == 5), key=lambda r: r.sequence_no)
    assert [t for r in mine for t in np.frombuffer(r.ids, "<u2")[: r.n_tokens].tolist()] == ids
    later = training_order.read_training_order(spark, path, kind, 31).collect()
    assert [r.slot for r in later] == list(range(31, len(found)))
    loose = training_order.read_training_order(spark, path, kind, 31, ordered=False)
    assert sorted(r.slot for r in loose.collect()) == list(range(31, len(found)))
    path = training_order.write_training_order(empty, 9)
    assert training_order.read_training_order(spark, path, kind).count() == 0


# Quality


def test_quality_counts(docs, empty):
    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        at = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at)

    spark = docs.sparkSession
    texts = ["a b c a b c a b", "x\nx\n\nx $$ <", "a b c d a b c", BASE, None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.judge(table).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain(texts[r.row.doc_id] or "")
        assert r.base_failed and not r.kept
    good = (BASE + " then home. ") + long_text(60) + " of the and to in is"
    table = spark.createDataFrame([(1, good), (2, "! ".join(good.split())), (3, None)], "doc_id long, text string")
    kept = quality.keep_good(table)
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == table.columns
    assert quality.keep_good(empty).count() == 0
    assert quality.judge(docs).count() == len(ROWS)


# Toxicity


def test_kernel_tolerates_gaps():
    marks = toxicity.Landmarks(["worthless"])
    same, gap, dots, other = marks.kernel(["worthless", "worthxless", "wo.rth.less", "the"])[:, 0]
    assert same == pytest.approx(1, abs=1e-5) and dots == pytest.approx(1, abs=1e-5)
    assert 0.1 < gap < 1 and other < 0.01


def plain_kernel(a, b):
    """Shared subsequences of three symbols by enumeration."""

    def features(word):
        (span,) = toxicity.symbols(word)
        found = {}
        for at in itertools.combinations(range(len(span)), 3):
            if at[2] - at[0] <= toxicity.REACH:
                key = tuple(span[k] for k in at)
                found[key] = found.get(key, 0) + toxicity.DECAY ** (at[2] - at[0] - 2)
        norm = sum(v * v for v in found.values()) ** 0.5
        return {k: v / norm for k, v in found.items()}

    left, right = features(a), features(b)
    return sum(v * right.get(k, 0) for k, v in left.items()) ** 4


def test_kernel_equals_enumeration():
    random = np.random.default_rng(2)
    words = ["worthless", "w0rthl3ss", "aaaaaa", "a", "ab", "m.o.r.o.n", "\u00e9t\u00e9", "\u4f60\u597d\u554a"]
    words += ["".join(random.choice(list("abcde1"), random.integers(1, 18))) for _ in range(40)]
    marks = toxicity.Landmarks(words[:9])
    found = marks.kernel(words)
    want = [[plain_kernel(w, m) for m in words[:9]] for w in words]
    assert found == pytest.approx(np.array(want), abs=1e-4)


def test_training_takes_long_words_in_parts():
    word = "".join(chr(97 + k % 26) for k in range(1000))
    (words,) = toxicity.trained_on(f"short {word}")
    assert words[0] == "short" and max(map(len, words)) == toxicity.PART
    assert len("".join(toxicity.trained_on("x" * 50_000).__next__())) > 0
    many = " ".join(f"{k:03}" * 60 for k in range(100))
    assert all(len(s) <= toxicity.SENTENCE_WORDS for s in toxicity.trained_on(many))
    assert sum(len(w) for s in toxicity.trained_on(many) for w in s) == 100 * 180


def test_toxicity_on_held_out(spark, empty):
    words = [f"{a}{b}" for a in ("an", "the", "in", "or", "st") for b in ("er", "ing", "ion", "ly", "ed")]
    random = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(400):
        text = random.choice(words, 60).tolist()
        toxic = k % 5 == 0
        for at in (10, 30) if toxic else ():
            text[at] = ("moron", "scumbag", "worthless")[(k + at) % 3]
        rows.append((k, ". ".join(" ".join(text[j : j + 12]) for j in range(0, 60, 12)), k))
        labels.append((k, None if k == 7 else int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    held = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.row.doc_id).encode()) % 5 == 0]
    assert all((r.score >= 0.5) == (r.row.doc_id % 5 == 0) for r in held)
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "x" * 5000 + " you m o r o n moron scumbag")], "doc_id long, text string")
    scores = [r.score for r in toxicity.score(odd, model).collect()]
    assert scores[0] == scores[1] < 0.5 < scores[2]
    assert toxicity.drop_toxic(odd, model).count() == 2
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(docs, table.where("toxic = 0")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_toxicity_sample_has_all_documents(spark):
    rows = [(k, "\n".join(f"line {k} {j}" for j in range(3000 if k == 5 else 4))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(40)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels, F.lit(True), 2000, 100)
    assert len(sample) == 100 and {d for d, *_ in sample} == set(range(40))
    assert sum(label for _, label, _ in sample) == 40  # all of the smaller label; the rest is clean
    per_doc = [sum(d == k for d, *_ in sample) for k in range(40) if k % 4]
    assert max(per_doc) <= min(per_doc) + 1
    blank = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("text")))
    with pytest.raises(ValueError):
        toxicity.training_sample(blank, labels, F.lit(True), 2000, 100)


# Language model


def test_language_model(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: attention_lm.words_of(r.text) for r in table.collect()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 10 == 0}
    counts = {}
    for d in texts.keys() - held:
        for w in [*texts[d], b""]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in attention_lm.score(table).collect():
        tokens = [*texts[r.doc_id], b""]
        c = np.array([counts.get(w, 0) for w in tokens])
        assert r.held_out == (r.doc_id in held) and r.train_tokens == n
        assert r.n_tokens == len(tokens) and r.n_known == (c > 0).sum()
        assert r.base_score == pytest.approx(np.log10((c + 0.1) / (n + 0.1 * (v + 1))).sum())
        assert np.isfinite(r.score) and r.score < 0
    assert attention_lm.score(docs).count() == len(ROWS)
    assert attention_lm.score(empty).count() == 0


def test_words_that_begin_with_other_white_space(spark):
    words = ["\u00a0", "\u00a0mot", "\u3000x", "\x1cy", "\u2003z", "plain"]
    rows = [(k, f"a {w} b") for k, w in enumerate(words * 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = attention_lm.score(table).collect()
    assert len(found) == len(rows) and all(r.n_tokens == 4 and np.isfinite(r.score) for r in found)


def test_words_never_met_share_one_count():
    base = attention_lm.Base.of(100, 2, np.array([3]), np.array([100.0]), np.array([2.0]))
    # Two met words and a hundred others that begin with item 3, all others spelt alike.
    counts = np.array([60, 40] + [0] * 100)
    first_logs, first = np.full(102, np.log10(0.5)), np.full(102, 3)
    logs = first_logs + np.log10(1 / 102)
    for weight in (0.05, 0.95):
        found = 10 ** base.mixed(weight, counts, logs, first_logs, first)
        assert 0.5 * 0.95 < found.sum() <= 0.5 + 1e-9  # the probability of the first id


def test_base_weight_needs_no_frequent_words(spark):
    """Words of several ids in any order: what follows an id says less than a word's share."""
    random = np.random.default_rng(3)
    parts = ["zor", "biq", "vex", "lum", "qua", "dri", "wob", "fen"]
    words = ["".join(random.choice(parts, 3)) for _ in range(40)]
    rows = [(" ".join(random.choice(words, 25)),) for _ in range(60)]
    texts = spark.createDataFrame(rows, "text string")
    counts = attention_lm.word_counts(texts).cache()
    frequent = {r.word.encode(): r.n for r in counts.collect()}
    path = default_tokenizer()
    items = attention_lm.Items.by_count(attention_lm.id_counts(counts, path))
    last, after, number, words = attention_lm.neighbours(counts, path, items)
    weights = attention_lm.start(last, after, number)
    begin = last == attention_lm.STOP
    total = sum(frequent.values()), len(frequent)
    base = attention_lm.Base.of(*total, after[begin], number[begin], words[begin])
    sets = (frequent, {b"": frequent[b""]})
    found = [attention_lm.base_weight(texts, counts, attention_lm.Scorer(path, items, weights, f), base) for f in sets]
    assert found[0] == found[1] > min(attention_lm.BASE_WEIGHTS)


@pytest.mark.parametrize("number", [0, 1, 5, 40])
def test_parameters_are_averaged_by_windows(spark, number):
    random = np.random.default_rng(number)
    values = random.normal(size=(number, 3)).astype(np.float32)
    sizes = random.integers(1, 9, number)
    rows = [(int(n), pickle.dumps({"a": v})) for n, v in zip(sizes, values)]
    states = spark.createDataFrame(rows, "n long, state binary").repartition(max(1, number))
    total, mean = attention_lm._averaged(states)
    assert total == sizes.sum() and list(mean) == (["a"] if number else [])
    if number:
        assert mean["a"] == pytest.approx(sizes @ values / total, rel=1e-4, abs=1e-5)


def test_every_training_document_is_learnt_from_once(spark, monkeypatch):
    """Each text fits one window; those of all rounds and trainers add up to all texts."""
    learnt, averaged = [], attention_lm._averaged

    def spied(states):
        total, mean = averaged(states)
        learnt.append(total)
        return total, mean

    monkeypatch.setattr(attention_lm, "_averaged", spied)
    rows = [(k, f"the cat {k % 7} sat") for k in range(200)] + [(7, None), (7, None), (None, "a b")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = attention_lm.score(table).collect()
    assert len(found) == len(rows)
    assert sum(learnt) == sum(not r.held_out for r in found) and len(learnt) == attention_lm.ROUNDS


def test_weight_is_chosen_by_all_training_documents(spark):
    """The sums under each weight are those of single texts under one weight."""
    rows = [(k, "zor biq vex " * (k % 5) + f"w{k}", False) for k in range(40)]
    texts = spark.createDataFrame(rows, "id long, text string, held_out boolean")
    counts = attention_lm.word_counts(texts.select("text")).cache()
    frequent = {r.word.encode(): r.n for r in counts.collect()}
    path, total = default_tokenizer(), (sum(frequent.values()), len(frequent))
    scorer, base = attention_lm.train(texts.select("id", "text"), counts, path, frequent, total)
    whole = np.zeros(len(attention_lm.BASE_WEIGHTS))
    for _, text, _ in rows:
        logs, first_logs, count, first = scorer.spelt([attention_lm.words_of(text)])[0]
        whole += [base.mixed(w, count - 1, logs, first_logs, first).sum() for w in attention_lm.BASE_WEIGHTS]
    found = attention_lm._scored(texts, scorer, base)
    sums = np.sum([r.left_out for r in found.collect()], axis=0)
    assert sums == pytest.approx(whole, rel=1e-6)
    rest = attention_lm._counted(found, counts)
    assert attention_lm._best_weight(found, rest, base) == attention_lm.BASE_WEIGHTS[int(np.argmax(whole))]


def test_windows_score_each_target_once():
    for n in (1, 5, 16, 17, 100):
        seen, target, counts = attention_lm.windows(np.arange(n, dtype=np.int32))
        assert target[counts].tolist() == list(range(n))
        assert seen[counts].tolist() == [attention_lm.STOP, *range(n - 1)]


def test_attention_is_causal_and_gradients_hold():
    random = np.random.default_rng(2)
    w = attention_lm.start(np.array([attention_lm.STOP, 0, 0]), np.array([0, 1, 2]), np.ones(3))
    seen = random.integers(0, 40, (3, attention_lm.WINDOW))
    target = random.integers(0, 40, (3, attention_lm.WINDOW))
    counts = np.ones(seen.shape, np.float32)
    counts[:, 9:] = 0
    changed = seen.copy()
    changed[:, 9:] = 5
    loss, grads = attention_lm.step(w, seen, target, counts)
    assert loss == pytest.approx(attention_lm.step(w, changed, target, counts)[0], rel=1e-5)
    for name in ("query", "key", "value", "out"):
        direction = random.normal(size=getattr(w, name).shape).astype(np.float32)
        there, back = (
            attention_lm.step(w._replace(**{name: getattr(w, name) + s * direction}), seen, target, counts)[0]
            for s in (1e-2, -1e-2)
        )
        assert (there - back) / 2e-2 == pytest.approx((grads[name] * direction).sum(), rel=0.1, abs=2e-3)


def test_gradients_hold_where_the_first_targets_are_not_learnt():
    random = np.random.default_rng(4)
    w = attention_lm.start(np.array([attention_lm.STOP, 0, 0]), np.array([0, 1, 2]), np.ones(3))
    seen, target = random.integers(0, 40, (2, 5, attention_lm.WINDOW))
    counts = np.ones(seen.shape, np.float32)
    counts[1:, : attention_lm.CONTEXT] = 0
    _, grads = attention_lm.step(w, seen, target, counts)
    for name in ("query", "key", "value", "out", "embed", "place", "mix", "emission"):
        direction = random.normal(size=getattr(w, name).shape).astype(np.float32)
        there, back = (
            attention_lm.step(w._replace(**{name: getattr(w, name) + s * direction}), seen, target, counts)[0]
            for s in (1e-2, -1e-2)
        )
        assert (there - back) / 2e-2 == pytest.approx((grads[name] * direction).sum(), rel=0.1, abs=2e-3)


def test_words_are_spelt_together_and_once(monkeypatch):
    path, asked, spelling = default_tokenizer(), [], attention_lm.spelling

    def spied(path, words):
        asked.extend(words)
        return spelling(path, words)

    monkeypatch.setattr(attention_lm, "spelling", spied)
    words = attention_lm.Words(path, {b"the": 5, b"": 3})
    merge = attention_lm.encoder(path).merge
    for text in ("the cat's 12ab the \u00e9t\u00e9!!", "a\u00a0 \u2003z cat's the", ""):
        tokens = [*attention_lm.words_of(text), b""]
        ids, size, rank = words.spelt(tokens)
        parts = [merge(" " + t.decode()) if t else [words.end] for t in tokens]
        assert ids.tolist() == [i for part in parts for i in part] and size.tolist() == list(map(len, parts))
        assert rank.tolist() == [{b"the": 0, b"": 1}.get(t, -1) for t in tokens]
    assert len(asked) == len(set(asked)) == 6


def test_windows_of_several_texts_are_those_of_each():
    texts = [np.append(np.arange(n), attention_lm.STOP) for n in (0, 15, 16, 3, 70)]
    found = attention_lm.windows(np.concatenate(texts), np.array([len(x) for x in texts]))
    for part, whole in zip(zip(*map(attention_lm.windows, texts)), found):
        assert np.array_equal(np.concatenate(part), whole)


# SentencePiece


def test_best_pieces_against_brute_force():
    own = sentencepieces.pieces(sentencepieces.default_model())
    score = dict(zip(own.number.tolist(), own.score.tolist()))
    by_text = {own.text[i].decode().replace(" ", sentencepieces.MARKER): i for i in own.number.tolist()}

    def best(segment):
        tops = [0.0]
        for end in range(1, len(segment) + 1):
            options = [tops[k] + score[by_text[segment[k:end]]] for k in range(end) if segment[k:end] in by_text]
            if segment[end - 1] not in by_text:
                options.append(tops[end - 1] + own.unknown_score)
            tops.append(max(options))
        return tops[-1]

    for text in ["", "hello world", "  two  spaces ", "naïve 你好 \U0001f642", "a" * 90, "x\ny ▁z", BASE]:
        ids, total = own.encode([text])[0]
        whole = sentencepieces.MARKER + text.replace(" ", sentencepieces.MARKER) if text else ""
        assert total == pytest.approx(best(whole))
        assert own.decode(ids) == text.replace(sentencepieces.MARKER, " ")
        ((again, value, n, n_bytes, same),) = own.encoded([text])
        pieces = np.frombuffer(ids, "<u4")
        assert (again, n, n_bytes) == (ids, len(pieces), own.is_byte[pieces].sum())
        assert value == total and same == (own.decode(ids) == text)


def test_sentencepiece_rows(docs, empty):
    found = sentencepieces.decode(sentencepieces.encode(docs)).collect()
    assert len(found) == len(ROWS)
    assert all(r.decoded == (r.row.row.text or "") for r in found)
    assert sentencepieces.decode(sentencepieces.encode(empty)).count() == 0


def test_expected_pieces_against_all_segmentations():
    own = sentencepieces.pieces(sentencepieces.default_model())
    random = np.random.default_rng(4)
    scores = np.log(random.dirichlet(np.ones(len(own.number))))
    own = sentencepieces.pieces(sentencepieces.default_model(), scores.tobytes())
    place = {own.text[i].decode().replace(" ", sentencepieces.MARKER): k for k, i in enumerate(own.number.tolist())}

    def ways(segment):
        if not segment:
            yield 0.0, []
        for k in range(1, len(segment) + 1):
            which = place.get(segment[:k], -1 if k == 1 else None)
            if which is not None:
                for rest, after in ways(segment[k:]):
                    yield rest + (own.score[which] if which >= 0 else own.unknown_score), [which, *after]

    texts = ["the", "brown", "", "na\U0001f642ve", "a\nb"]
    segments, times = [sentencepieces.MARKER + t for t in texts], np.array([3, 1, 2, 5, 1])
    want = np.zeros(len(own.number))
    for segment, n in zip(segments, times):
        found = list(ways(segment))
        whole = np.logaddexp.reduce([value for value, _ in found])
        for value, numbers in found:
            for which in numbers:
                if which >= 0:
                    want[which] += n * np.exp(value - whole)
    assert own.expected(segments, times) / sentencepieces.UNIT == pytest.approx(want, abs=1e-3)
    logs = own._expected(segments, times, logs=True)
    assert logs / sentencepieces.UNIT == pytest.approx(want, abs=1e-3)


def test_expected_pieces_of_improbable_segments():
    """Products leave the range of doubles, logarithms don't."""
    own = sentencepieces.pieces(sentencepieces.default_model())
    own = own.scored(np.full(len(own.number), -40.0))
    segments = ["\U0001f642" * 200 + "q", "q" * 250, sentencepieces.MARKER + "the"]
    times = np.array([2, 1, 7])
    want = own._expected(segments, times, logs=True)
    assert own.expected(segments, times).tolist() == pytest.approx(want.tolist(), abs=2)
    assert want.sum() > 0


def test_a_long_segment_takes_seconds(spark):
    texts = ["ab\u4e2dq9" * 200_000, "x" * 1_000_000]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    counts = sentencepieces.segment_counts(table, "text", sentencepieces.default_model()).collect()
    assert max(len(r.segment) for r in counts) <= sentencepieces.PART
    assert sum(len(r.segment) * r.n for r in counts) == sum(map(len, texts)) + len(texts)
    start = time.time()
    found = sentencepieces.encode(table, scores=sentencepieces.learn_scores(table)).collect()
    assert all(r.round_trip for r in found) and time.time() - start < 60


def test_learnt_scores_keep_common_words_whole(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    scores = sentencepieces.learn_scores(table)
    assert np.exp(scores).sum() == pytest.approx(1)
    own = sentencepieces.pieces(sentencepieces.default_model(), scores.tobytes())
    found = sentencepieces.segment_counts(table, "text", sentencepieces.default_model()).collect()
    counts = {r.segment.removeprefix(sentencepieces.MARKER): r.n for r in found}
    known = {own.text[i].decode("utf-8", "replace") for i in own.number.tolist()}
    common = sorted((w for w in counts if w.isalpha() and f" {w}" in known), key=lambda w: -counts[w])[:100]
    assert len(common) > 50
    split = [w for w in common if len(own.encode([w])[0][0]) != 4]
    assert not split


# Tool calls

TOOLS = {"t": {"type": "object", "required": ["a"], "properties": {"a": {"type": ["integer", "null"]}}}}
CALLS = (
    "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, status string, level int"
)
RESULTS = "conv_id long, turn long, call_id string, content string, problems string"


def test_tool_calls(spark):
    calls = [
        (1, 0, "a", "t", '{"a": 1.0, "B": "é"}', None),
        (1, 2, "b", "t", '{"a": "x"}', ["a", "a"]),
        (1, 4, "c", "t", "{", ["b", "a"]),
        (1, 4, "c", "t", "{", ["b", "a"]),
        (1, 6, "d", "u", "{}", ["e"]),
        (1, 7, "e", "t", '{"a": 2}', ["d", None]),
        (1, 8, "f", "t", '{"a": NaN}', ["zz", "c"]),
        (1, 9, "g", "t", '{"a": null}', ["e", "a"]),
        (1, 9, "a", "t", '{"a": 3}', []),
        (None, 1, "g", "t", None, None),
    ]
    calls = spark.createDataFrame([(*c, "extra", 5) for c in calls], CALLS)
    results = [
        (1, 1, "a", '{"z":1,"y":[2.50]}'), (1, 1, "b", "plain"), (1, 9, "x", None), (2, 0, None, "q"),
        (1, 10, "a", "second"),
    ]
    results = spark.createDataFrame([(*r, "extra") for r in results], RESULTS)
    rows = tool_calls.link_calls(calls, results, TOOLS).collect()
    found = {r.call_id: r for r in rows if r.conv_id == 1 and r.status != "repeated"}
    assert len(rows) == len(found) + 2 + 3
    assert {k: r.status for k, r in found.items()} == {
        "a": "linked", "b": "early", "c": "unanswered", "d": "unanswered", "e": "unanswered",
        "f": "unanswered", "g": "unanswered", "x": "orphan",
    }
    again = {(r.call_id, r.call_turn, r.result_turn) for r in rows if r.status == "repeated"}
    assert again == {("c", 4, None), ("a", 9, None), ("a", None, 10)}
    assert [found[k].level for k in "abcdefg"] == [0, 1, 2, None, None, 3, None]
    assert found["a"].problems == [] and found["b"].problems == ["$.a: not integer or null"]
    assert found["c"].problems == ["arguments are no JSON"] and found["g"].problems == ["waits in a circle"]
    assert found["d"].problems == ["no such tool", "waits in a circle"]
    assert found["f"].problems == ["arguments are no JSON", "waits for an unknown call"]
    assert found["a"].line == (
        '{"arguments":{"B":"é","a":1},"call_id":"a","conv_id":1,"level":0,"name":"t","needs":null,'
        '"problems":[],"result":{"y":[2.5],"z":1},"status":"linked"}'
    )
    none = tool_calls.link_calls(calls.limit(0), results.limit(0), TOOLS)
    assert none.count() == 0
    with pytest.raises(ValueError, match="unknown keywords"):
        tool_calls.link_calls(calls, results, {"t": {"properties": {"a": {"minimun": 1}}}})


def test_one_very_long_argument(spark):
    text = "x" * 3_000_000
    calls = spark.createDataFrame([(1, 0, "a", "t", '{"a": 1, "b": "' + text + '"}', None, "s", 1), (1, 1, "b", "t", "[" * 100_000, None, "s", 1)], CALLS)
    results = spark.createDataFrame([(1, 2, "a", text, "p")], RESULTS)
    found = {r.call_id: r for r in tool_calls.link_calls(calls, results, TOOLS).collect()}
    assert found["a"].problems == [] and len(found["a"].line) > 2 * len(text)
    assert found["b"].problems == ["arguments are no JSON"]


def plain_levels(calls):
    """By repeated passes over all calls of a conversation."""
    level = {}
    while True:
        new = {
            c: max((level[n] + 1 for n in needs if n in calls), default=0)
            for c, needs in calls.items()
            if c not in level and all(n in level for n in needs if n in calls)
        }
        if not new:
            return level
        level |= new


@pytest.mark.parametrize("together", [1, 60, 10_000])
def test_levels_of_random_graphs(spark, together):
    random = np.random.default_rng(together)
    graphs = {}
    for conv in range(12):
        size = int(random.integers(1, 30))
        graphs[conv] = {
            f"c{k}": [f"c{n}" for n in random.integers(0, size if conv % 3 == 0 else max(k, 1), random.integers(0, 3)) if conv % 3 == 0 or n != k]
            + (["unknown"] if random.random() < 0.1 else [])
            for k in range(size)
        }
    rows = [(conv, c, needs) for conv, calls in graphs.items() for c, needs in calls.items()]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, needs array<string>").repartition(3)
    found = {(r.conv_id, r.call_id): (r.level, r.unknown_need) for r in tool_calls.levels(calls, together).collect()}
    want = {}
    for conv, graph in graphs.items():
        solved = plain_levels(graph)
        want |= {(conv, c): (solved.get(c), "unknown" in needs) for c, needs in graph.items()}
    assert found == want


def test_long_chain_of_calls(spark):
    rows = [(1, f"c{k}", [f"c{j}" for j in (k - 1, k - 2) if j >= 0]) for k in range(5000)]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, needs array<string>")
    assert {r.call_id: r.level for r in tool_calls.levels(calls).collect()} == {f"c{k}": k for k in range(5000)}


@pytest.mark.parametrize(
    "value, schema, count",
    [
        (1, {"enum": [True]}, 1),
        (True, {"enum": [True, 1]}, 0),
        (1.0, {"const": 1}, 0),
        (None, {"type": ["string", "null"]}, 0),
        (3, {"type": ["string", "null"]}, 1),
        ("ab", {"minLength": 3}, 1),
        ("ab", {"pattern": "^a", "maxLength": 1}, 1),
        ("ba", {"pattern": "^a"}, 1),
        (5, {"exclusiveMaximum": 5, "multipleOf": 5}, 1),
        (7, {"multipleOf": 2}, 1),
        ([1, 1.0], {"uniqueItems": True, "minItems": 3}, 2),
        ([True, 1], {"uniqueItems": True, "items": {"type": "number"}}, 1),
        ({"a": 1}, {"additionalProperties": {"type": "string"}}, 1),
        ({"a": 1}, {"additionalProperties": False, "maxProperties": 0}, 2),
        (4, {"anyOf": [{"type": "string"}, {"minimum": 4}]}, 0),
        (4, {"oneOf": [{"type": "integer"}, {"minimum": 4}]}, 1),
        (4, {"allOf": [{"minimum": 4}, {"maximum": 3}], "not": {"type": "integer"}}, 2),
        ({"n": {"n": 3}}, {"$ref": "#/$defs/t", "$defs": {"t": {"properties": {"n": {"anyOf": [{"type": "null"}, {"$ref": "#/$defs/t"}]}}}}}, 0),
        (4, False, 1),
    ],
)
def test_schema_keywords(value, schema, count):
    schemas_json.check_schema(schema)
    assert len(schemas_json.problems(value, schema)) == count
