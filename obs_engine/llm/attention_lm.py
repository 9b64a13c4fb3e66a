"""Language-model scores: word counts as a base, and causal self-attention on subword ids.

Counting reads every training document: words are counted in tasks and summed by Spark.
From the counts of distinct words come those of subword ids and of neighbouring ids in
words, which start the model: the next id is a mixture of ``MIXTURE`` distributions over
ids, and the mixture weights depend on the last id. Causal self-attention over the ids
before adds to the logits of these weights; it is trained in numpy by the tasks of Spark on
the windows of all training documents, each document in one of the rounds whose parameters are
averaged. Texts are encoded once, into a table of ids that learning and scoring read; what a task
trains on are the documents of its partition of that table.

A text is the ids of its words, each as if after a space, and an end. The last id of a word
is another item than the same id elsewhere, so ids spell one sequence of words only. Scoring
cuts a text into windows of ``WINDOW`` ids that overlap by ``CONTEXT``: each id is scored
once, in the window where it has the longest context, many windows at a time under one
causal mask. Ids that are not among the most frequent share an item, and within it have
smoothed shares by their counts, so the probabilities of all words add up to one.

A word's probability interpolates two that both begin with attention's probability of its
first id: times that of its other ids, or times the word's share of the training tokens that
begin with that id. Of a word not in the training tokens the share is that of all such words,
times the probability of its other ids, which deals it among them. The weight of the latter is the one of ``BASE_WEIGHTS`` that fits
all training documents best, where an occurrence is left out of its word's count; documents
are scored once, under each of these weights.

The base score needs the count of each word: counts of the most frequent words, a bounded
table, are with every task; the other words of a text are joined with the counts.

Defined results: null text counts as empty, an empty text is its end alone; without any
training document all counts are zero; ids and repeated rows are carried along, each row
by itself; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from copy import copy
from functools import lru_cache
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import bucket_of, column, in_tasks, materialise
from obs_engine.llm.encoding import default_tokenizer, encoder

FOLDS = 10
FREQUENT_WORDS = 1 << 17
LONGEST_FREQUENT = 64
FLUSH = 300_000
# Two items for each of the most frequent ids and for all others together, in a word and at
# its end; the last item is the end of a text.
ITEMS = 4096
OTHER, STOP = ITEMS // 2 - 2, ITEMS - 1
CONTEXTS = 1024  # last items with counts of their own to start from
MIXTURE = 32
STARTS = 8  # components of the mixture for how words begin
WIDTH = 16
WINDOW, CONTEXT = 16, 4
TRAINERS = 6
TRAINER_TOKENS = 1 << 21  # of small partitions so many words are one trainer's, or all by TRAINERS
FAN_IN = 16  # parameters averaged in one task
ROUNDS = 3  # each learns from its share of the documents
BATCH = 512
LEAST_STEPS = 40  # of a trainer in a round; with few windows it goes over them again
LEARNING_RATE = 0.02
EM_STEPS = 25
AT_ONCE = 256
TEXTS_AT_ONCE = 64
SMOOTH = 0.1
BASE_WEIGHTS = tuple(k / 20 for k in range(1, 20))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case; splits at \\x20 and \\x09-\\x0D only."""
    return (text or "").encode().translate(LOWER).split()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all texts; the empty word stands for the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([w.decode() for w in counts], pa.string()),
                    pa.array(counts.values(), pa.int64()),
                ],
                ["word", "n"],
            )
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(words_of(text.as_py()))
                counts[b""] += 1
                if len(counts) > FLUSH:
                    yield flushed()
        if counts:
            yield flushed()

    return in_tasks(texts, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=2)
def _begins_with_space(path: str) -> np.ndarray:
    """For each id whether a space begins its bytes."""
    tokenizer = encoder(path).exact
    texts = (tokenizer.id_to_token(k) or "" for k in range(encoder(path).size))
    return np.array([text[:1] == "\u0120" for text in texts])


def spelling(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words that are not empty, each as if after a space, and how many each has.

    Words without any white space are encoded together: a space before a letter always begins
    a new token, so the ids are those of single words.
    """
    merge = encoder(path).merge  # a word may begin with white space that doesn't split
    joined = " ".join(words)
    if words and joined.split() == words:
        ids = np.array(merge(" " + joined), np.int64)
        starts = np.flatnonzero(_begins_with_space(path)[ids])
        if len(starts) == len(words) and starts[0] == 0:
            return ids, np.diff(starts, append=len(ids))
    parts = [merge(" " + w) for w in words]
    return np.array([i for part in parts for i in part], np.int64), np.array([len(x) for x in parts], np.int64)


def _ids_by_word(path: str, words: list[str]) -> list[np.ndarray]:
    ids, size = spelling(path, [w for w in words if w])
    ends = np.cumsum(size).tolist()
    parts = iter([ids[a:b] for a, b in zip([0, *ends], ends)])
    return [next(parts) if w else ids[:0] for w in words]


def id_counts(counts: DataFrame, path: str) -> np.ndarray:
    """How often each subword id occurs; one number for each id of the vocabulary."""
    size = encoder(path).size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            ids = _ids_by_word(path, batch.column(0).to_pylist())
            weight = np.repeat(batch.column(1).to_numpy(), [len(x) for x in ids])
            if len(weight):
                total += np.bincount(np.concatenate(ids), weight, size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(total[found].astype(np.int64))], ["id", "n"]
        )

    summed = in_tasks(counts, run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size)
    for row in summed.collect():  # at most one row for each id of the vocabulary
        out[row.id] = row.n
    return out


class Items(NamedTuple):
    """Twice the rank of an id, and log10 of the id's share of its item."""

    of_id: np.ndarray
    share: np.ndarray

    @classmethod
    def by_count(cls, counts: np.ndarray) -> Items:
        order = np.lexsort((np.arange(len(counts)), -counts))
        of_id = np.full(len(counts), 2 * OTHER, np.int32)
        of_id[order[:OTHER]] = 2 * np.arange(min(OTHER, len(counts)))
        rest = order[OTHER:]
        share = np.zeros(len(counts))
        if len(rest):
            smooth = counts[rest] + 0.5
            share[rest] = np.log10(smooth / smooth.sum())
        return cls(of_id, share)

    def word(self, ids: np.ndarray) -> np.ndarray:
        """Items of a word's ids."""
        found = self.of_id[ids]
        found[-1:] += 1
        return found


def neighbours(counts: DataFrame, path: str, items: Items) -> tuple[np.ndarray, ...]:
    """Last item (``CONTEXTS`` at most), next item and number, in words and at their starts.

    The last item STOP stands before a word; there, the number of distinct words follows. The
    result has at most CONTEXTS * ITEMS rows.
    """
    shared = counts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids_by_word(path, batch.column(0).to_pylist())
            parts = [shared.value.word(x) if len(x) else np.array([STOP], np.int32) for x in ids]
            before = [np.concatenate(([STOP], x[:-1])) for x in parts]
            weight = np.repeat(batch.column(1).to_numpy(), [len(x) for x in parts])
            if not len(weight):
                continue
            last = np.concatenate(before)
            last[(last >= CONTEXTS - 2) & (last != STOP)] = 2 * OTHER
            pairs, place = np.unique(last * ITEMS + np.concatenate(parts), return_inverse=True)
            numbers = (np.bincount(place, w).astype(np.int64) for w in (weight, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs, pa.int64()), *map(pa.array, numbers)], ["pair", "n", "words"]
            )

    summed = in_tasks(counts, run, "pair long, n long, words long").groupBy("pair")
    rows = summed.agg(F.sum("n").alias("n"), F.sum("words").alias("words")).orderBy("pair").toPandas()
    pair = rows["pair"].to_numpy(np.int64)
    return pair // ITEMS, pair % ITEMS, *rows[["n", "words"]].to_numpy(np.float64).T


class Weights(NamedTuple):
    """``mix[item]`` logits of the mixture by the last item; the rest is attention."""

    emission: np.ndarray  # ITEMS x MIXTURE logits
    mix: np.ndarray
    embed: np.ndarray
    place: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    out: np.ndarray


TRAINED = Weights._fields


def start(last: np.ndarray, after: np.ndarray, number: np.ndarray) -> Weights:
    """The mixture of counted neighbours, by expectation maximisation; attention at rest.

    The first components are how words begin, alike but for a little noise.
    """
    random = np.random.default_rng(7)
    first = np.full(ITEMS, 1e-3)
    begins = last == STOP
    np.add.at(first, after[begins], number[begins])
    first /= first.sum()
    x, y, n = last[~begins], after[~begins], number[~begins]
    total = np.bincount(y, n, ITEMS) + 1e-3
    inner = MIXTURE - STARTS
    emission = random.gamma(1.0, size=(inner, ITEMS)) * total
    emission /= emission.sum(1, keepdims=True)
    mix = np.full((ITEMS, inner), 1.0 / inner)
    for _ in range(EM_STEPS):
        new_e, new_m = np.zeros_like(emission), np.zeros_like(mix)
        for at in range(0, len(x), 200_000):
            s = slice(at, at + 200_000)
            r = mix[x[s]] * emission[:, y[s]].T
            r *= (n[s] / np.maximum(r.sum(1), 1e-300))[:, None]
            for k in range(inner):
                new_e[k] += np.bincount(y[s], r[:, k], ITEMS)
                new_m[:, k] += np.bincount(x[s], r[:, k], ITEMS)
        prior = new_m.sum(0) / max(new_m.sum(), 1)
        emission = new_e + 0.5 * total / total.sum()
        emission /= emission.sum(1, keepdims=True)
        mix = new_m + 0.5 * prior + 1e-6
        mix /= mix.sum(1, keepdims=True)
    weights = np.hstack([np.full((ITEMS, STARTS), 1e-6), mix])
    weights[np.arange(CONTEXTS - 2, STOP)] = weights[2 * OTHER]  # counted together
    weights[1::2] = [1.0 / STARTS] * STARTS + [1e-6] * inner  # after a word's end, and STOP
    begin = np.log(first) + random.normal(0, 0.1, (STARTS, ITEMS))
    dims = lambda *shape: random.normal(0, 0.2, shape).astype(np.float32)
    return Weights(
        np.vstack([begin, np.log(emission)]).T.astype(np.float32, order="C"),
        np.log(weights).astype(np.float32),
        dims(ITEMS, WIDTH),
        dims(WINDOW, WIDTH),
        dims(WIDTH, WIDTH),
        dims(WIDTH, WIDTH),
        dims(WIDTH, WIDTH),
        dims(WIDTH, MIXTURE) * np.float32(0.1),
    )


LARGEST = np.float32(60)  # logits above would overflow; none comes near
ONES = np.ones((WINDOW, 1), np.float32)
ALL = np.ones((MIXTURE, 1), np.float32)
BEFORE = np.tril(np.ones((WINDOW, WINDOW), np.float32))  # later ids are out of sight
SCALE = np.float32(WIDTH**-0.5)
QUERY, KEY, VALUE = (slice(k * WIDTH, (k + 1) * WIDTH) for k in range(3))


def _exp(z: np.ndarray) -> np.ndarray:
    if z.max(initial=0) > LARGEST:
        np.minimum(z, LARGEST, out=z)
    return np.exp(z, out=z)


def _emission(logits: np.ndarray) -> np.ndarray:
    """Each component's probabilities of items."""
    z = logits - logits.max(0)
    np.exp(z, out=z)
    z /= z.sum(0)
    return z


def _heads(w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query (scaled), key and value side by side: of items, of places, and the map to them."""
    maps = np.hstack([w.query * SCALE, w.key, w.value])
    return w.embed @ maps, w.place @ maps, maps


def _groups(counts: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Numbers of windows, few at a time, and the first place whose target counts in any of them."""
    whole = counts[:, :CONTEXT].any(1)
    for first, rows in ((0, np.flatnonzero(whole)), (CONTEXT, np.flatnonzero(~whole))):
        for k in range(0, len(rows), AT_ONCE):  # what a core's cache holds
            yield rows[k : k + AT_ONCE], first


def _attend(by_item: np.ndarray, by_place: np.ndarray, seen: np.ndarray, first: int):
    """Heads of windows, attention from the place ``first`` on, and what it finds."""
    h = np.take(by_item, seen, axis=0)
    h += by_place
    a = h[:, first:, QUERY] @ h[..., KEY].transpose(0, 2, 1)
    _exp(a)
    a *= BEFORE[first:]
    a /= a @ ONES
    return h, a, a @ h[..., VALUE]


def _mixture(w: Weights, flat: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Weights of the components, not yet divided by their sum."""
    pi = flat @ w.out
    pi += np.take(w.mix, last, axis=0)
    return _exp(pi)


def _add(into: np.ndarray, items: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to that of its item."""
    order = np.argsort(items.astype(np.uint16), kind="stable")  # a radix sort
    ordered = items[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    if len(starts):
        pairs = np.take(rows, order, axis=0).view(np.complex64)  # two numbers added at once
        into[ordered[starts]] += np.add.reduceat(pairs, starts, axis=0).view(np.float32)


def step(w: Weights, seen: np.ndarray, target: np.ndarray, counts: np.ndarray, d: dict | None = None):
    """Loss and gradients of windows; ``counts`` is one where a target is to be learnt.

    Gradients are added to ``d``, whose arrays are zero.
    """
    d = d or {name: np.zeros_like(getattr(w, name)) for name in TRAINED}
    of_item, (by_item, by_place, maps) = _emission(w.emission), _heads(w)
    items, places = np.zeros_like(by_item), np.zeros_like(by_place)
    loss, total = 0.0, max(counts.sum(), 1)
    for rows, first in _groups(counts):
        scale = (counts[rows, first:] / total).astype(np.float32)
        loss += _step(w, of_item, by_item, by_place, seen[rows], target[rows, first:], scale, d, items, places)
    owned = d["emission"]
    of_item *= owned.sum(0)
    np.subtract(of_item, owned, out=owned)
    d["embed"] += items @ maps.T
    d["place"] += places @ maps.T
    moved = w.embed.T @ items + w.place.T @ places
    for name, part, factor in (("query", QUERY, SCALE), ("key", KEY, 1), ("value", VALUE, 1)):
        d[name] += moved[:, part] * np.float32(factor)
    return loss, d


def _step(w: Weights, of_item, by_item, by_place, seen, target, scale, d: dict, items, places) -> float:
    """The loss; adds to the gradients: of heads to ``items`` and ``places``, and the targets'
    shares in components to that of the emission."""
    first = WINDOW - target.shape[1]
    last, after, scale = seen[:, first:].ravel(), target.ravel(), scale.reshape(-1, 1)
    h, a, c = _attend(by_item, by_place, seen, first)
    flat = c.reshape(-1, WIDTH)
    pi = _mixture(w, flat, last)
    total = pi @ ALL
    joint = np.take(of_item, after, axis=0)
    joint *= pi
    p = np.maximum(joint @ ALL, np.float32(1e-30) * total)
    joint *= scale / p
    pi *= scale / total
    pi -= joint
    _add(d["emission"], after, joint)
    _add(d["mix"], last, pi)
    d["out"] += flat.T @ pi
    dc = pi @ w.out.T
    along = np.einsum("ij,ij->i", dc, flat).reshape(len(seen), -1, 1)
    dc = dc.reshape(c.shape)
    da = dc @ h[..., VALUE].transpose(0, 2, 1)
    da -= along
    da *= a
    dh = np.empty_like(h)
    dh[:, :first, QUERY] = 0
    np.matmul(da, h[..., KEY], out=dh[:, first:, QUERY])
    np.matmul(da.transpose(0, 2, 1), h[:, first:, QUERY], out=dh[..., KEY])
    np.matmul(a.transpose(0, 2, 1), dc, out=dh[..., VALUE])
    places += dh.sum(0)
    _add(items, seen.ravel(), dh.reshape(-1, dh.shape[2]))
    return float(-(np.log(p / total) * scale).sum())


class Trainer:
    """Adam over batches of windows; all parameters lie in one array."""

    def __init__(self, weights: Weights):
        sizes = [getattr(weights, n).size for n in TRAINED]
        self.flat, self.grad, self.m, self.v = (np.zeros(sum(sizes), np.float32) for _ in range(4))
        ends = np.cumsum(sizes)[:-1]

        def views(flat: np.ndarray) -> dict[str, np.ndarray]:
            return {n: x.reshape(getattr(weights, n).shape) for n, x in zip(TRAINED, np.split(flat, ends))}

        self.w, self.d, self.t = Weights(**views(self.flat)), views(self.grad), 0
        for name in TRAINED:
            getattr(self.w, name)[...] = getattr(weights, name)

    def learn(self, seen: np.ndarray, target: np.ndarray, counts: np.ndarray) -> float:
        self.grad[:] = 0
        loss, _ = step(self.w, seen, target, counts, self.d)
        self.t += 1
        rate = LEARNING_RATE * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        g = self.grad
        change = g - self.m
        change *= np.float32(0.1)
        self.m += change
        g *= g
        g -= self.v
        g *= np.float32(0.001)
        self.v += g
        np.sqrt(self.v, out=g)
        g += np.float32(1e-8)
        np.divide(self.m, g, out=g)
        g *= np.float32(rate)
        self.flat -= g
        return loss


def windows(items: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seen items, targets and which targets count, of texts that end with STOP.

    ``sizes`` tells how many items each text has; without, there is one text. Before a text
    stands STOP. Windows overlap by CONTEXT, whose targets count only once.
    """
    sizes = np.array([len(items)]) if sizes is None else sizes
    seen = np.concatenate(([STOP], items[:-1])).astype(items.dtype)
    stride, begin = WINDOW - CONTEXT, np.cumsum(sizes) - sizes
    seen[begin] = STOP
    number = 1 + np.maximum(0, -(-(sizes - WINDOW) // stride))
    turn = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    at = (turn * stride)[:, None] + np.arange(WINDOW)
    size = np.repeat(sizes, number)[:, None]
    counts = at < size
    counts[:, :CONTEXT] &= turn[:, None] == 0
    at = np.minimum(at, size - 1)
    at += np.repeat(begin, number)[:, None]
    return seen[at], items[at], counts


class Words(dict):
    """Numbers of words in UTF-8, and by number their ids, how many these are, and the place
    of the word among the frequent ones, or -1.

    The empty word is the end of a text; its only id is the one after the last.
    """

    def __init__(self, path: str, frequent: dict[bytes, int]):
        super().__init__()
        self.path, self.end = path, encoder(path).size
        self.place = {word: k for k, word in enumerate(frequent)}
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.ids, self.size, self.rank = (np.zeros(0, np.int64) for _ in range(3))

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        if len(self) > FLUSH:
            self.forget()
        numbers = np.fromiter(map(self.get, tokens, repeat(-1)), np.int64, len(tokens))
        absent = np.flatnonzero(numbers < 0).tolist()
        if absent:
            new = sorted({tokens[k] for k in absent})  # the empty word comes first
            ends = 1 if not new[0] else 0
            ids, size = spelling(self.path, [w.decode() for w in new[ends:]])
            self.ids = np.concatenate([self.ids, [self.end] * ends, ids]).astype(np.int64)
            self.size = np.concatenate([self.size, [1] * ends, size]).astype(np.int64)
            rank = [self.place.get(w, -1) for w in new]
            self.rank = np.concatenate([self.rank, np.array(rank, np.int64)])
            self.starts = np.cumsum(self.size) - self.size
            self.update(zip(new, range(len(self), len(self) + len(new))))
            numbers[absent] = [self[tokens[k]] for k in absent]
        return numbers

    def spelt(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all tokens, how many each has, and its place among the frequent words."""
        numbers = self.numbers(tokens)
        size = self.size[numbers]
        at = np.repeat(self.starts[numbers] - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        return self.ids[at], size, self.rank[numbers]


def _tokens(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts, each with its end, and how many tokens each text has."""
    tokens: list[bytes] = []
    for words in texts:
        tokens += words
        tokens.append(b"")
    return tokens, np.array([len(words) + 1 for words in texts], np.int64)


class Scorer:
    """log10 probabilities of words in texts, by their ids."""

    def __init__(self, path: str, items: Items, weights: Weights, frequent: dict[bytes, int]):
        self.path, self.items, self.w, self.frequent = path, items, weights, frequent
        self.words: Words | None = None  # made where it is used, not sent
        self.by_item, self.by_place, _ = _heads(weights)
        self.emission = _emission(weights.emission)
        self.of_id = np.append(items.of_id, STOP - 1)  # the last is the end of a text
        self.in_item = np.append(items.share, 0.0)
        self.counts = np.array([*frequent.values(), -1], np.float64)

    def lean(self) -> Scorer:
        """Without the frequent words themselves, to be sent to tasks that get ids."""
        found = copy(self)
        found.frequent, found.words = {}, None
        return found

    def windows(self, ids: np.ndarray, size: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows of texts from the ids of their tokens, as ``_tokens`` and ``Words.spelt`` give them."""
        items = self.of_id[ids]
        items[np.cumsum(size) - 1] += 1
        ends = np.cumsum(tokens) - 1
        return windows(items, np.diff(np.cumsum(size)[ends], prepend=0))

    def logs(self, ids: np.ndarray, size: np.ndarray, rank: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """A column for each token: log10 probabilities by its ids, and of its first id alone,
        its count (-1 for words that are not frequent), its first item."""
        seen, target, scored = self.windows(ids, size, tokens)
        found = np.zeros(seen.shape, np.float32)
        for rows, first in _groups(scored):
            found[rows, first:] = self._windows(seen[rows], target[rows, first:])
        logs = found[scored].astype(np.float64)
        starts = np.cumsum(size) - size
        first_item = self.of_id[ids[starts]] + (size == 1)
        share = np.add.reduceat(self.in_item[ids], starts)
        return np.stack([np.add.reduceat(logs, starts) + share, logs[starts], self.counts[rank], first_item])

    def spelt(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """``logs`` of each text."""
        if self.words is None:
            self.words = Words(self.path, self.frequent)
        flat, tokens = _tokens(texts)
        return np.split(self.logs(*self.words.spelt(flat), tokens), np.cumsum(tokens)[:-1], axis=1)

    def _windows(self, seen: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 probabilities of the targets, which end where the windows do."""
        first = WINDOW - target.shape[1]
        _, _, c = _attend(self.by_item, self.by_place, seen, first)
        pi = _mixture(self.w, c.reshape(-1, WIDTH), seen[:, first:].ravel())
        total = pi @ ALL
        pi *= np.take(self.emission, target.ravel(), axis=0)
        return np.log10(np.maximum(pi @ ALL / total, np.float32(1e-30))).reshape(target.shape)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Each row the bytes of the values up to its end."""
    offsets = np.concatenate(([0], ends)).astype(np.int64) * values.itemsize
    if offsets[-1] >= 1 << 31:
        raise ValueError("too many ids at once")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


def _values(rows: pa.Array, kind: type) -> np.ndarray:
    """The values of all rows of ``_binary``, one after another."""
    return np.frombuffer(b"".join(rows.to_pylist()), kind).astype(np.int64)


def _id_kind(path: str) -> type:
    return np.uint16 if encoder(path).size < 1 << 16 else np.uint32


def encoded(rows: DataFrame, path: str, frequent: dict[bytes, int]) -> DataFrame:
    """``text`` replaced by its ids; other columns are kept.

    ``tag`` is unique, ``tokens`` their number, ``ids`` has the bytes of all ids, ``size`` how many
    each token has, ``rank`` its place among the frequent words or -1, ``rest`` the other words.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    kept = [c for c in rows.columns if c != "text"]
    kind = _id_kind(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path, shared.value)
        tag = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                flat, tokens = _tokens([words_of(t.as_py()) for t in part.column("text")])
                ids, size, rank = words.spelt(flat)
                ends = np.cumsum(tokens)
                rest = np.flatnonzero(rank < 0)
                rest_ends = np.searchsorted(rest, np.concatenate(([0], ends)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in kept),
                        pa.array(range(tag, tag + len(tokens)), pa.int64()),
                        pa.array(tokens),
                        _binary(ids.astype(kind), np.cumsum(size)[ends - 1]),
                        _binary(size.astype(np.uint32), ends),
                        _binary(rank.astype(np.int32), ends),
                        pa.ListArray.from_arrays(
                            pa.array(rest_ends, pa.int32()),
                            pa.array([flat[k].decode() for k in rest.tolist()], pa.string()),
                        ),
                    ],
                    [*kept, "tag", "tokens", "ids", "size", "rank", "rest"],
                )
                tag += len(tokens)

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept]
    added = "tag long, tokens long, ids binary, size binary, rank binary, rest array<string>"
    return materialise(in_tasks(rows, run, ", ".join([*kinds, added])), "lm-ids")


def _mean(states: list[tuple[int, bytes]]) -> tuple[int, dict[str, np.ndarray]]:
    """Windows learnt by all, and parameters weighted by them."""
    total = sum(n for n, _ in states)
    mean: dict[str, np.ndarray] = {}
    for n, state in sorted(states):
        for name, value in pickle.loads(state).items():
            part = value * np.float32(n / total)
            mean[name] = mean[name] + part if name in mean else part
    return total, mean


def _state(n: int, parameters: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n], pa.int64()), pa.array([pickle.dumps(parameters)], pa.binary())], ["n", "state"]
    )


def _averaged(states: DataFrame) -> tuple[int, dict[str, np.ndarray]]:
    """The mean of all trainers' parameters; the driver gets ``FAN_IN`` of them at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                part = [(row["n"], row["state"])]
                n, mean = _mean(part if mean is None else [(n, pickle.dumps(mean)), *part])
        if mean is not None:
            yield _state(n, mean)

    while (number := states.count()) > FAN_IN:
        states = materialise(
            in_tasks(states.repartition(-(-number // FAN_IN)), run, "n long, state binary"), "lm-states"
        )
    return _mean([(r.n, bytes(r.state)) for r in states.collect()])


def _round(texts: DataFrame, scorer: Scorer) -> Weights:
    """Train in each partition from the same weights; average by the windows learnt."""
    shared, kind = texts.sparkSession.sparkContext.broadcast(scorer.lean()), _id_kind(scorer.path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        trainer, learnt, first, waiting = Trainer(model.w), 0, [], []

        def learn(parts: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
            """What is left are fewer windows than a batch."""
            nonlocal learnt
            seen, target, counts = map(np.concatenate, zip(*parts))
            end = len(seen) - len(seen) % BATCH or len(seen)
            for at in range(0, end, BATCH):
                part = slice(at, min(at + BATCH, end))
                block = seen[part], target[part], counts[part].astype(np.float32)
                trainer.learn(*block)
                learnt += len(block[0])
                if trainer.t < LEAST_STEPS:
                    first.append(block)
            return [(seen[end:], target[end:], counts[end:])] if end < len(seen) else []

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                ids, size = _values(part.column("ids"), kind), _values(part.column("size"), np.uint32)
                waiting.append(model.windows(ids, size, part.column("tokens").to_numpy()))
                if sum(len(seen) for seen, _, _ in waiting) >= BATCH:
                    waiting = learn(waiting)
        if waiting:
            learn(waiting)
        while first and trainer.t < LEAST_STEPS:
            trainer.learn(*first[trainer.t % len(first)])
        if learnt:
            yield _state(learnt, {n: getattr(trainer.w, n) for n in TRAINED})

    states = materialise(in_tasks(texts, run, "n long, state binary"), "lm-states")
    return scorer.w._replace(**_averaged(states)[1])


class Base(NamedTuple):
    """Smoothed shares of words: ``tokens`` and ``distinct`` of the training documents.

    ``begins`` has log10 of the share of tokens that begin with an item.
    """

    tokens: int
    distinct: int
    begins: np.ndarray

    @classmethod
    def of(cls, tokens: int, distinct: int, first: np.ndarray, number: np.ndarray, words: np.ndarray):
        share = np.full(ITEMS, SMOOTH)  # for words never met
        share[first] += number + SMOOTH * words
        return cls(tokens, distinct, np.log10(share / smoothed(tokens, distinct)))

    def share(self, counts: np.ndarray) -> np.ndarray:
        return (counts + SMOOTH) / smoothed(self.tokens, self.distinct)

    def mixed(self, weight, counts: np.ndarray, logs: np.ndarray, first_logs: np.ndarray, first: np.ndarray):
        """log10 of words' probabilities; those never met share one count by their spelling."""
        return logs + np.log10((1 - weight) + weight * self.against(counts, logs, first_logs, first))

    def against(self, counts: np.ndarray, logs: np.ndarray, first_logs: np.ndarray, first: np.ndarray):
        """How much likelier words are by their shares than by their ids."""
        return self.times(counts, 10 ** np.minimum(first_logs - logs, 300), (10**-self.begins)[first.astype(np.int64)])

    def times(self, counts: np.ndarray, others: np.ndarray, begun: np.ndarray) -> np.ndarray:
        """``against`` from one by the probabilities of a word's other ids, and of its first."""
        return self.share(counts) * np.where(counts > 0, others, 1.0) * begun

    def ahead(self, first_logs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 of how much likelier a token's first id is here than anywhere."""
        return first_logs - self.begins[first.astype(np.int64)]


PRODUCT = 512  # so many numbers from a half to one have a product above the least float


def smoothed(tokens: int, distinct: int) -> float:
    return tokens + SMOOTH * (distinct + 1)


def _mixed(weight: float, count: Column, tokens: int, distinct: int) -> Column:
    """``Base.mixed`` of rows with ``spelt``, ``ahead`` and ``begins``."""
    share = weight * (count + SMOOTH) / smoothed(tokens, distinct)
    power = lambda x: F.pow(F.lit(10.0), x)
    met = F.log10((1 - weight) * power(F.col("spelt")) + share * power(F.col("ahead")))
    return F.when(count > 0, met).otherwise(F.col("spelt") + F.log10((1 - weight) + share * power(-F.col("begins"))))


def _scored(rows: DataFrame, scorer: Scorer, base: Base) -> DataFrame:
    """``_summed`` of ``id``, ``text`` and ``held_out``."""
    return _summed(encoded(rows, scorer.path, scorer.frequent), scorer, base)


def _summed(texts: DataFrame, scorer: Scorer, base: Base) -> DataFrame:
    """``id``, ``held_out``, ``tag`` (unique), and sums over the frequent words of a text.

    ``mixed`` has log10 of their probabilities under each weight, ``left_out`` the same where an
    occurrence is left out of its word's count (null if held out); ``rest`` the other words, to
    be joined with their counts.
    """
    shared = texts.sparkSession.sparkContext.broadcast((scorer.lean(), base))
    kind, id_kind = texts.schema["id"].dataType.simpleString(), _id_kind(scorer.path)

    def under_weights(ratio: np.ndarray, logs: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """A row for each text; where the ratio is one, only ``logs`` counts.

        Of products the mantissas are multiplied and the exponents added, so few logarithms are taken.
        """
        blocks = -(-tokens // PRODUCT)
        first = np.cumsum(blocks) - blocks
        turn = np.arange(blocks.sum()) - np.repeat(first, blocks)
        starts = np.cumsum(tokens) - tokens
        at = np.repeat(starts, blocks) + turn * PRODUCT
        sums, more = np.empty((len(tokens), len(BASE_WEIGHTS))), np.empty_like(ratio)
        for k, weight in enumerate(BASE_WEIGHTS):
            np.multiply(ratio, weight, out=more)
            more += 1 - weight
            mantissa, exponent = np.frexp(more)
            product = np.log10(np.multiply.reduceat(mantissa, at))
            product += np.add.reduceat(exponent, at, dtype=np.int64) * np.log10(2)
            sums[:, k] = np.add.reduceat(product, first)
        return sums + np.add.reduceat(logs, starts)[:, None]

    def by_weight(sums: np.ndarray, absent: np.ndarray | None = None) -> pa.Array:
        """A list for each row of the sums, in the order of texts."""
        if absent is None:
            absent = np.zeros(len(sums), bool)
        each = sums.shape[1]
        offsets = np.concatenate(([0], np.cumsum(np.where(absent, 0, each))))
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32(), mask=np.append(absent, False)), pa.array(sums[~absent].ravel())
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shares = shared.value
        starting = 10**-shares.begins
        by_rank = np.append(np.log10(shares.share(model.counts[:-1])), 0.0)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                values = [_values(part.column(c), k) for c, k in (("ids", id_kind), ("size", np.uint32), ("rank", np.int32))]
                tokens = part.column("tokens").to_numpy()
                logs, first_logs, counted, first = model.logs(*values, tokens)
                starts, listed = np.cumsum(tokens) - tokens, counted >= 0
                ahead = shares.ahead(first_logs, first)
                known, rest = np.where(listed, logs, 0.0), ~listed
                held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                others, begun = 10 ** np.minimum(first_logs - logs, 300), starting[first.astype(np.int64)]
                ratio = np.where(listed, shares.times(counted, others, begun), 1.0)
                fewer = np.where(listed, shares.times(counted - 1, others, begun), 1.0)
                counts = by_rank[values[2]]
                words = part.column("rest")
                spelt = pa.StructArray.from_arrays(
                    [words.flatten(), *map(pa.array, (logs[rest], ahead[rest], (first_logs - ahead)[rest]))],
                    ["word", "spelt", "ahead", "begins"],
                )
                offsets = np.concatenate(([0], np.cumsum(np.add.reduceat(rest.astype(np.int64), starts))))
                columns = {
                    "id": part.column("id"),
                    "held_out": part.column("held_out"),
                    "tag": part.column("tag"),
                    "n_tokens": part.column("tokens"),
                    "hits": pa.array(np.add.reduceat(listed.astype(np.int64), starts)),
                    "base": pa.array(np.add.reduceat(counts, starts)),
                    "mixed": by_weight(under_weights(ratio, known, tokens)),
                    "left_out": by_weight(under_weights(fewer, known, tokens), held),
                    "rest": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spelt),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return materialise(
        in_tasks(
            texts.select("id", "held_out", "tag", "tokens", "ids", "size", "rank", "rest"),
            run,
            f"id {kind}, held_out boolean, tag long, n_tokens long, hits long, base double, "
            "mixed array<double>, left_out array<double>, "
            "rest array<struct<word:string,spelt:double,ahead:double,begins:double>>",
        ),
        "lm-scored",
    )


def _counted(scored: DataFrame, counts: DataFrame) -> DataFrame:
    """The words that are not frequent, with their text's ``tag`` and their counts ``c``."""
    rest = scored.select("tag", "held_out", F.inline("rest")).join(counts, "word", "left")
    count = F.coalesce("n", F.lit(0)).alias("c")
    return materialise(rest.select("tag", "held_out", "spelt", "ahead", "begins", count), "lm-rest")


def _best_weight(scored: DataFrame, rest: DataFrame, base: Base) -> float:
    """The weight that fits all training texts best, each word without the occurrence itself."""
    n = F.greatest(F.col("c") - 1, F.lit(0))
    others = rest.where(~F.col("held_out")).select(
        *[F.sum(_mixed(w, n, base.tokens, base.distinct)) for w in BASE_WEIGHTS]
    )
    known = scored.select(*[F.sum(F.col("left_out")[k]) for k in range(len(BASE_WEIGHTS))])
    sums = [(x or 0.0) + (y or 0.0) for x, y in zip(known.first(), others.first())]
    return BASE_WEIGHTS[int(np.argmax(sums))]


def base_weight(texts: DataFrame, counts: DataFrame, scorer: Scorer, base: Base) -> float:
    """The weight of the shares of words that fits the given texts best."""
    rows = texts.select(F.lit(None).cast("long").alias("id"), "text", F.lit(False).alias("held_out"))
    scored = _scored(rows, scorer, base)
    return _best_weight(scored, _counted(scored, counts), base)


def _turn() -> Column:
    """The round that learns from a document."""
    return F.pmod(F.xxhash64("text", "id"), F.lit(ROUNDS)).alias("turn")


def train(
    training: DataFrame, counts: DataFrame, path: str, frequent: dict[bytes, int], total: tuple[int, int]
) -> tuple[Scorer, Base]:
    """A scorer and the base, from ``id``, ``text`` and their word counts."""
    texts = encoded(training.select(_turn(), "text"), path, frequent)
    return fit(texts, counts, path, frequent, total)


def fit(
    texts: DataFrame, counts: DataFrame, path: str, frequent: dict[bytes, int], total: tuple[int, int]
) -> tuple[Scorer, Base]:
    """A scorer and the base, from ``turn``, the encoded texts and their word counts.

    Every document is learnt from, in the round that its hash tells.
    """
    items = Items.by_count(id_counts(counts, path))
    last, after, number, words = neighbours(counts, path, items)
    begin = last == STOP
    base = Base.of(*total, after[begin], number[begin], words[begin])
    scorer = Scorer(path, items, start(last, after, number), frequent)
    trainers = max(TRAINERS, total[0] // TRAINER_TOKENS)
    for k in range(ROUNDS):
        turn = texts.where(F.col("turn") == k).select("tokens", "ids", "size")
        scorer = Scorer(path, items, _round(turn.coalesce(trainers), scorer), frequent)
    return scorer, base


def score(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """For each row of ``df``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``."""
    path = tokenizer or default_tokenizer()
    rows = df.select(
        column(df, id_column).alias("id"),
        column(df, text_column).alias("text"),
        (bucket_of(column(df, id_column), FOLDS) == 0).alias("held_out"),
    )
    training = rows.where(~F.col("held_out"))
    counts = materialise(word_counts(training.select("text")), "lm-words")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total = int(totals[0]), int(totals[1])
    short = F.octet_length("word") <= LONGEST_FREQUENT
    top = counts.where(short).orderBy(F.col("n").desc(), "word").limit(FREQUENT_WORDS)
    frequent = {r.word.encode(): r.n for r in top.collect()}
    texts = encoded(rows.select("id", "held_out", _turn(), "text"), path, frequent)
    scorer, base = fit(texts.where(~F.col("held_out")), counts, path, frequent, total)
    scored = _summed(texts, scorer, base)
    rest = _counted(scored, counts)
    weight = _best_weight(scored, rest, base)
    # Words outside the frequent ones are few for each text, and none of them is hot.
    share = (F.col("c") + SMOOTH) / smoothed(*total)
    summed = rest.groupBy("tag").agg(
        F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("more_hits"),
        F.sum(F.log10(share)).alias("more_base"),
        F.sum(_mixed(weight, F.col("c"), *total)).alias("more_mixed"),
    )

    def with_more(value: Column, name: str, zero: float) -> Column:
        return value + F.coalesce(F.col(f"more_{name}"), F.lit(zero))

    chosen = F.col("mixed")[BASE_WEIGHTS.index(weight)]
    return scored.drop("rest", "left_out").join(summed, "tag", "left").select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        with_more(F.col("hits"), "hits", 0).cast("long").alias("n_known"),
        F.lit(total[0]).cast("long").alias("train_tokens"),
        with_more(F.col("base"), "base", 0.0).alias("base_score"),
        with_more(chosen, "mixed", 0.0).alias("score"),
    )
