"""Toxicity by a subsequence string kernel with Nyström landmarks and a linear SVM.

Two spans (words) are compared by the subsequences of three characters they share, where
a gap costs ``DECAY`` for each character in it; the ends of a span are characters too. So
``worthxless`` and ``worthless`` stay close. The kernel of two sentences sums the fourth power of
the normalised kernel over all pairs of their spans. Sentences are mapped to Nyström
features by landmark spans, and a support vector machine with squared hinge loss is trained
on sentences. Only documents have labels: all sentences of a clean document are clean; of
a toxic one those are toxic that the last model says, at least one (multiple instances).
A document's score is a logistic function of its three highest sentence margins.

Since features add up over spans, so do margins: each distinct span is evaluated once for
a batch and remembered, up to ``REMEMBER`` spans and to the end of a task, as a Python worker
goes on to other stages with all it remembers.

Training uses a bounded sample: ``SAMPLE_DOCUMENTS`` labelled documents for each label,
chosen by hash, and ``SAMPLE_SENTENCES`` of their sentences: every document gives one, chosen
by hash, before any gives a second, and so on. Each label has half of them, and what the other
label leaves. A longer word than ``PART`` is trained on in parts of that length. Scoring reads
whole texts and words.

Letters are folded to lower case; those outside a to z share ``OTHERS`` symbols, so words in
other scripts are compared more coarsely.

Defined results: null and empty texts get the score of a text without sentences; null
labels are not used; without both labels every score is 0, but if both were sampled and one has
no sentences, or no word marks either, training fails; repeated rows are scored alike; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import bucket_of, column, in_tasks, materialise

SAMPLE_DOCUMENTS = 2_000
SAMPLE_SENTENCES = 60_000
SENTENCE_WORDS = 40
PART = 100
LANDMARKS = 96
DECAY = 0.85
REACH = 4
ROUNDS = 4
REMEMBER = 200_000
BLOCK = 1024
SUMMED = 2_000  # sentences at once
TEXTS_CHARS = 400_000
FOLDS = 5

SPACED = re.compile(r"(?<!\S)(?:[^\W\d_]\s){2,}[^\W\d_](?!\S)")
# Digits and signs that stand for letters in disguised words.
FOLD = dict(zip("013457@$", "oieastas"))
LETTERS = 26
OTHERS = 18
START, END, SYMBOLS = LETTERS + OTHERS, LETTERS + OTHERS + 1, LETTERS + OTHERS + 2
WINDOW = 24


def sentences(text: str) -> Iterator[list[str]]:
    """Distinct words of each sentence, of ``SENTENCE_WORDS`` at most at a time.

    Runs of single letters are one word; a word has its case folded.
    """
    text = SPACED.sub(lambda m: "".join(m.group().split()), text.lower())
    for end in (". ", "! ", "? "):
        text = text.replace(end, "\n")
    for part in text.split("\n"):
        words = part.split()
        for at in range(0, len(words), SENTENCE_WORDS):
            yield list(dict.fromkeys(words[at : at + SENTENCE_WORDS]))


def trained_on(text: str) -> Iterator[list[str]]:
    """The sentences of a text with long words in parts, and again of bounded length."""
    for words in sentences(text):
        parts = [w[at : at + PART] for w in words for at in range(0, len(w), PART)]
        for at in range(0, len(parts), SENTENCE_WORDS):
            yield list(dict.fromkeys(parts[at : at + SENTENCE_WORDS]))


@lru_cache(maxsize=4096)
def _symbol(char: str) -> int:
    char = FOLD.get(char, char)
    if "a" <= char <= "z":
        return ord(char) - 97
    return LETTERS + ord(char) % OTHERS if char.isalnum() else -1


def symbols(word: str) -> list[tuple[int, ...]]:
    """A word as symbols with its ends; of a long word all windows that overlap by half."""
    inner = [s for s in map(_symbol, word) if s >= 0]
    whole = (START, *inner, END)
    if len(whole) <= WINDOW:
        return [whole]
    return [whole[at : at + WINDOW] for at in range(0, len(whole) - WINDOW // 2, WINDOW // 2)]


@lru_cache(maxsize=64)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    places = [
        (i, j, k)
        for i in range(length)
        for j in range(i + 1, length)
        for k in range(j + 1, min(length, i + REACH + 1))
    ]
    at = np.array(places, np.int64).reshape(-1, 3)
    return at, (DECAY ** (at[:, 2] - at[:, 0] - 2)).astype(np.float32)


def subsequences(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of spans of one length: all subsequences in reach, and their weights by place."""
    at, weight = _triples(spans.shape[1])
    return (spans[:, at[:, 0]] * SYMBOLS + spans[:, at[:, 1]]) * SYMBOLS + spans[:, at[:, 2]], weight


def lengths(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The norm of each row's feature vector, where equal subsequences add up."""
    order = np.argsort(codes, axis=1)
    codes = np.take_along_axis(codes, order, axis=1)
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    starts = np.flatnonzero(new.ravel())
    sums = np.add.reduceat(weight[order].ravel(), starts)
    return np.sqrt(np.bincount(starts // codes.shape[1], sums * sums, len(codes)))


class Landmarks:
    """Landmark spans; ``kernel`` compares words with them."""

    def __init__(self, words: list[str]):
        spans = [symbols(w)[0] for w in words]
        found: dict[int, np.ndarray] = {}
        norms = np.zeros(len(words), np.float32)
        for column_, span in enumerate(spans):
            codes, weight = subsequences(np.array([span], np.int32))
            norms[column_] = lengths(codes, weight)[0] if codes.size else 0
            for code, value in zip(codes[0].tolist(), weight.tolist()):
                row = found.setdefault(code, np.zeros(len(words), np.float32))
                row[column_] += value
        norms[norms == 0] = 1
        self.words = words
        self.place = np.zeros(SYMBOLS**3, np.int32)
        self.table = np.zeros((len(found) + 1, len(words)), np.float32)  # first row: unknown
        for row, (code, weights) in enumerate(found.items(), 1):
            self.place[code] = row
            self.table[row] = weights / norms

    def kernel(self, words: list[str]) -> np.ndarray:
        """The power of the normalised kernel; of a long word the sum over its windows."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        by_length: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
        for row, word in enumerate(words):
            for span in symbols(word):
                by_length[len(span)].append((row, span))
        for members in by_length.values():
            for at in range(0, len(members), BLOCK):
                part = members[at : at + BLOCK]
                np.add.at(out, [row for row, _ in part], self._compare(np.array([s for _, s in part], np.int32)))
        return out

    def _compare(self, spans: np.ndarray) -> np.ndarray:
        codes, weight = subsequences(spans)
        out = np.zeros((len(spans), len(self.words)), np.float32)
        if not codes.size:
            return out
        rows = self.place[codes]
        for value in np.unique(weight):
            part = np.zeros_like(out)
            for place in np.flatnonzero(weight == value):
                part += self.table[rows[:, place]]
            out += value * part
        norm = lengths(codes, weight)
        out /= np.where(norm > 0, norm, 1)[:, None].astype(np.float32)
        out *= out
        return out * out  # the fourth power


class Model:
    """Scores texts. ``weights`` are of landmarks, ``bias`` of a sentence."""

    def __init__(self, landmarks: Landmarks, weights: np.ndarray, bias: float, final: np.ndarray):
        self.landmarks, self.weights, self.bias, self.final = landmarks, weights, bias, final
        self.known: dict[str, float] = {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBER:
            self.known.clear()
            new = list(words)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.known.update(zip(part, (self.landmarks.kernel(part) @ self.weights).tolist()))

    def highest(self, texts: list[list[list[str]]]) -> np.ndarray:
        """The three highest sentence margins of each text, ``bias`` where it has fewer."""
        self.learn({w for text in texts for words in text for w in words})
        get = self.known.__getitem__
        out = np.full((len(texts), 3), self.bias)
        for row, text in enumerate(texts):
            best = sorted((sum(map(get, words)) for words in text), reverse=True)[:3]
            out[row, : len(best)] += best
        return out

    def score(self, texts: list[list[list[str]]]) -> np.ndarray:
        z = _squeezed(self.highest(texts), self.bias) @ self.final[:-1] + self.final[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _squeezed(margins: np.ndarray, bias: float) -> np.ndarray:
    """Margins from the bias up, bounded, so that no single sentence decides alone."""
    return np.clip(margins - min(bias, 0), 0, 4)


def training_sample(
    documents: DataFrame, labels: DataFrame, used: Column, documents_each: int, sentences_max: int
) -> list[tuple]:
    """Bounded rows of (document, label, words of a sentence joined by spaces)."""
    chosen = labels.where(used & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    key = F.xxhash64("doc_id")
    ids = {}
    for label in (0, 1):
        part = chosen.where(F.col("toxic") == label).orderBy(key, "doc_id").limit(documents_each)
        ids[label] = [r.doc_id for r in part.collect()]
    rows = [(i, label) for label, of in ids.items() for i in of]
    if not ids[0] or not ids[1]:
        return []
    kind = labels.schema["doc_id"].dataType.simpleString()
    picked = documents.sparkSession.createDataFrame(rows, f"doc_id {kind}, toxic int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, texts = [], [], []
            for row, text in enumerate(batch.column(2)):
                found = []
                for number, words in enumerate(trained_on(text.as_py() or "")):
                    if words:
                        sentence = " ".join(words)
                        found.append((zlib.crc32(f"{number} {sentence}".encode()), number, sentence))
                    if len(found) >= 2 * sentences_max:
                        found = sorted(found)[:sentences_max]
                found = sorted(found)[:sentences_max]  # of a document, no more can be used
                at += [row] * len(found)
                numbers += range(len(found))
                texts += [sentence for *_, sentence in found]
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(numbers, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                ["doc_id", "toxic", "number", "sentence"],
            )

    texts = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    texts = texts.select("doc_id", "toxic", "text")  # twice documents_each rows at most
    found = materialise(
        in_tasks(texts, run, f"doc_id {kind}, toxic int, number long, sentence string"), "toxicity-sample"
    )
    there = {r.toxic: r["count"] for r in found.groupBy("toxic").count().collect()}
    if len(there) == 1:
        raise ValueError(f"sampled documents have sentences with the label {min(there)} only")
    sample = []
    for label in there:
        most = max(sentences_max // 2, sentences_max - there[1 - label])
        part = found.where(F.col("toxic") == label).orderBy("number", key, "doc_id", "sentence").limit(most)
        for batch in part.select("doc_id", "toxic", "sentence").toArrow().to_batches(10_000):
            sample += zip(*(c.to_pylist() for c in batch.columns))
    return sorted(sample, key=lambda r: r[1])


def _landmark_words(bags: list[set[str]], toxic: np.ndarray) -> list[str]:
    """Half of the landmarks mark toxic documents, the others are frequent; none too alike."""
    counts = (Counter(), Counter())
    for bag, label in zip(bags, toxic):
        counts[int(label)].update(bag)
    n = np.bincount(toxic.astype(int), minlength=2)

    def odds(w: str) -> float:
        return np.log((counts[1][w] + 0.5) / (n[1] + 1)) - np.log((counts[0][w] + 0.5) / (n[0] + 1))

    marks = [w for w in counts[1] if counts[1][w] >= 3 and odds(w) > 1]
    marks.sort(key=lambda w: (-odds(w) * np.log(counts[1][w]), w))
    usual = sorted(counts[0], key=lambda w: (-counts[0][w], w))
    chosen: list[str] = []
    for pool, most in ((marks, LANDMARKS * 3 // 4), (usual, LANDMARKS)):
        for word in pool[: 10 * LANDMARKS]:
            if len(chosen) >= most:
                break
            if not symbols(word)[0][1:-1] or word in chosen:
                continue
            if not chosen or Landmarks(chosen).kernel([word]).max() < 0.8**4:
                chosen.append(word)
    return chosen


def _svm(features: np.ndarray, signs: np.ndarray, cost: float) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by Newton's method."""
    size = features.shape[1] + 1
    weights = np.zeros(size)
    ridge = np.eye(size)
    ridge[-1, -1] = 1e-6
    share = np.where(signs > 0, (signs < 0).sum() / max((signs > 0).sum(), 1), 1.0)
    share = np.minimum(share, 10) * cost
    for _ in range(30):
        gram, pull = ridge.copy(), np.zeros(size)
        for at in range(0, len(features), SUMMED):
            x = np.hstack([features[at : at + SUMMED], np.ones((len(features[at : at + SUMMED]), 1))])
            y, c = signs[at : at + SUMMED], share[at : at + SUMMED]
            active = y * (x @ weights) < 1
            xa, ca = x[active], c[active]
            gram += xa.T @ (ca[:, None] * xa)
            pull += xa.T @ (ca * y[active])
        step = np.linalg.solve(gram, pull)
        if np.abs(step - weights).max() < 1e-6:
            break
        weights = step
    return weights


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - 0.01 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(sample: list[tuple]) -> Model | None:
    """A model of labelled sentences; None if there are not both labels."""
    texts: dict = defaultdict(list)
    label: dict = {}
    same: dict[str, str] = {}  # one object for each distinct word
    for doc, toxic, sentence in sample:
        texts[doc].append([same.setdefault(w, w) for w in sentence.split(" ")])
        label[doc] = max(toxic, label.get(doc, 0))
    docs = list(texts)
    y = np.array([label[d] for d in docs])
    if not len(y) or y.min() == y.max():
        return None
    words = _landmark_words([{w for s in texts[d] for w in s} for d in docs], y)
    if not words:
        raise ValueError("no word of the sampled sentences can be a landmark")
    marks = Landmarks(words)
    inner = marks.kernel(words).astype(np.float64)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    kept = value > 1e-3
    root = vector[:, kept] / np.sqrt(value[kept])
    vocabulary = sorted(same)
    place = {w: i for i, w in enumerate(vocabulary)}
    of_word = np.zeros((len(vocabulary), len(words)), np.float32)
    for at in range(0, len(vocabulary), 20_000):
        of_word[at : at + 20_000] = marks.kernel(vocabulary[at : at + 20_000])
    flat = [s for d in docs for s in texts[d]]
    owner = np.repeat(np.arange(len(docs)), [len(texts[d]) for d in docs])
    strong = of_word[:, : LANDMARKS * 3 // 4].max(axis=1) > 0.8**4
    features = np.zeros((len(flat), root.shape[1]))
    holds = np.zeros(len(flat), bool)
    for at in range(0, len(flat), SUMMED):
        part = flat[at : at + SUMMED]
        ids = np.array([place[w] for s in part for w in s])
        starts = np.cumsum([0, *map(len, part)])[:-1]
        features[at : at + SUMMED] = np.add.reduceat(of_word[ids], starts, axis=0) @ root
        holds[at : at + SUMMED] = np.add.reduceat(strong[ids].astype(int), starts) > 0
    del of_word, place, same, vocabulary
    # At first a toxic document's sentences are toxic if they hold a landmark that marks it.
    toxic = (y[owner] == 1) & holds
    weights = None
    for _ in range(ROUNDS):
        used = (y[owner] == 0) | toxic if weights is None else np.ones(len(owner), bool)
        weights = _svm(features[used], np.where(toxic[used], 1.0, -1.0), 0.1)
        margin = features @ weights[:-1] + weights[-1]
        best = np.full(len(docs), -np.inf)
        np.maximum.at(best, owner, margin)
        toxic = (y[owner] == 1) & ((margin > 0) | (margin == best[owner]) & (margin > -0.5))
        if not toxic.any():
            break
    model = Model(marks, (root @ weights[:-1]).astype(np.float32), float(weights[-1]), np.zeros(4))
    model.final = _logistic(_squeezed(model.highest([texts[d] for d in docs]), model.bias), y)
    model.known = {}
    return model


def _scores(model: Model, texts: Iterator[str | None]) -> Iterator[float]:
    """Scores of texts in groups of about ``TEXTS_CHARS`` characters."""
    group, size = [], 0
    for text in texts:
        group.append(list(sentences(text or "")))
        size += len(text or "")
        if size >= TEXTS_CHARS:
            yield from model.score(group).tolist()
            group, size = [], 0
    if group:
        yield from model.score(group).tolist()


def train(
    documents: DataFrame,
    labels: DataFrame,
    documents_each: int = SAMPLE_DOCUMENTS,
    sentences_max: int = SAMPLE_SENTENCES,
) -> Model | None:
    """A model of the labels outside the held-out fold."""
    used = bucket_of(F.col("doc_id"), FOLDS) != 0
    return fit(training_sample(documents, labels, used, documents_each, sentences_max))


def score(
    df: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``row`` (all columns of ``df``) and ``score``."""
    rows = df.select(F.struct(*[column(df, c) for c in df.columns]).alias("row"))
    place = df.columns.index(text_column)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            texts = (t.as_py() for t in batch.column(0).field(place))
            found = [0.0] * batch.num_rows if scorer is None else list(_scores(scorer, texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], ["row", "score"]
            )
        if scorer is not None:
            scorer.known.clear()

    return in_tasks(rows, run, f"{rows.schema.simpleString()[7:-1].replace('row:', 'row ', 1)}, score double")


def drop_toxic(
    df: DataFrame, model: Model | None, text_column: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The rows of ``df`` that score below the threshold, all columns as they were."""
    return score(df, model, text_column=text_column).where(F.col("score") < threshold).select("row.*")
