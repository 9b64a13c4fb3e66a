"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Pieces are read from a model file. Its scores are those of a BPE model, merge ranks and no
log probabilities, so the log scores are learnt: all segments of the corpus are counted by
Spark, and in each of ``EM_ROUNDS`` rounds tasks find how often each piece is expected in them
over all their segmentations (forward and backward), which Spark sums and the logarithm of
the smoothed shares gives the next scores. The first round begins with equal scores. There, and
only there, a segment of more than ``PART`` characters is taken in parts of that length, so a
text without a space costs time and memory in proportion; no piece is expected across a cut.

A text is its words behind white space markers, beginning with one. No piece has a marker behind another character, so the
best pieces of a text are those of its segments, each a run of markers and what follows up
to the next; segments met before are remembered, up to about ``REMEMBER`` bytes. New segments of one
length are searched together: the trie is walked from each place for all of them at once,
and the best score up to each place is kept. A character without a piece costs
``UNKNOWN_COST`` more than the worst piece and is written as its bytes.

Of segmentations with equal scores, the one whose last piece begins earlier wins, place by
place. Defined results: null text counts as empty and has no pieces; repeated rows are
encoded each by itself; an empty table gives no rows; the marker itself is decoded as a
space.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from copy import copy
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import column, in_tasks, materialise

MARKER = "▁"
UNKNOWN_COST = 10.0
REMEMBER = 160_000_000
ENTRY = 220  # bytes of Python objects for a remembered segment beside its characters
LONGEST_TOGETHER = 48
TEXTS_CHARS = 1_500_000
PART = 256
SPREAD = 9.0  # about the usual factor from one character to the next, to stay in range
LEAST = 1e-200  # smaller products are computed again by logarithms
EM_ROUNDS = 4
SMOOTH = 0.1
UNIT = 1 << 16  # expected counts are summed in whole parts of one, in any order alike
FLUSH = 300_000
CELLS = 400_000
SEGMENT = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")


class DoubleArray:
    """A trie of strings in two arrays: from ``state`` by a code to ``base[state] + code``."""

    def __init__(self, words: list[str]):
        self.code = {c: i for i, c in enumerate(sorted(set("".join(words))), 1)}
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for number, word in enumerate(words):
            node = 0
            for char in word:
                node = children[node].setdefault(self.code[char], len(children))
                if node == len(children):
                    children.append({})
                    ends.append(-1)
            ends[node] = number
        size = 2 * len(children) + 2 * len(self.code) + 2
        base, check, end = (np.full(size, fill, np.int32) for fill in (0, -1, -1))
        taken = np.zeros(size, bool)
        taken[0] = True
        state, free = {0: 0}, 1
        order, queue = [], [0]
        while queue:  # parents before children
            node = queue.pop()
            order.append(node)
            queue.extend(children[node].values())
        for node in order:
            end[state[node]] = ends[node]
            if not children[node]:
                continue
            codes = np.array(sorted(children[node]))
            while taken[free]:
                free += 1
            at = max(free - int(codes[0]), 0)
            while True:
                if at + codes[-1] >= len(taken):
                    grow = len(taken)
                    base, check, end, taken = (
                        np.concatenate([x, np.full(grow, fill, x.dtype)])
                        for x, fill in ((base, 0), (check, -1), (end, -1), (taken, False))
                    )
                if not taken[at + codes].any():
                    break
                at += 1
            base[state[node]] = at
            for code in codes.tolist():
                state[children[node][code]] = at + code
                check[at + code] = state[node]
                taken[at + code] = True
        pad = np.full(len(self.code) + 1, -1, np.int32)  # any base plus any code is inside
        self.base, self.check, self.end = base, np.append(check, pad), end
        self.by_point = np.zeros(0x110000, np.int32)
        for char, code in self.code.items():
            self.by_point[ord(char)] = code

    def codes(self, texts: list[str]) -> np.ndarray:
        """Codes of the characters of texts in rows, 0 for others and behind their ends."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        out = np.zeros((len(texts), int(sizes.max(initial=0))), np.int32)
        out[np.arange(out.shape[1]) < sizes[:, None]] = self.by_point[points]
        return out


class Pieces:
    """The pieces of a model file with the search for the best ones."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.get_piece_size())
        plain = [
            i for i in numbers
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.number = np.array(plain)
        words = [model.id_to_piece(i) for i in plain]
        self.sizes = np.array(list(map(len, words)))
        self.score = np.array([model.get_score(i) for i in plain])
        self.unknown_score = float(self.score.min()) - UNKNOWN_COST
        self.unknown = model.unk_id()
        self.byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in numbers if model.is_byte(i)}
        self.trie = DoubleArray(words)
        self.longest = max(map(len, words))
        self.apart = not any(MARKER in w.lstrip(MARKER) for w in words)
        self.text = [b""] * len(numbers)
        for i, word in zip(plain, words):
            self.text[i] = word.replace(MARKER, " ").encode()
        for value, i in self.byte.items():
            self.text[i] = bytes([value])
        self.is_byte = np.zeros(len(numbers), bool)
        self.is_byte[list(self.byte.values())] = True
        self.forget()

    def scored(self, scores: np.ndarray) -> Pieces:
        """The same pieces with other scores, in the order of ``number``."""
        other = copy(self)
        other.score, other.unknown_score = scores, float(scores.min()) - UNKNOWN_COST
        other.forget()
        return other

    def forget(self) -> None:
        """No segments are known. Each gets a number: ``packed`` ids, ``scores``, ``facts`` by it."""
        self.known: dict[str, int] = {}
        self.packed: list[bytes] = []
        self.scores = np.zeros(0)
        self.facts = np.zeros((3, 0), np.int64)  # pieces, pieces that are bytes, decoded as met
        self.held = 0

    def segments(self, text: str) -> list[str]:
        """Segments of a text without the marker each begins with."""
        if not text:
            return []
        if not self.apart:
            return [text.replace(" ", MARKER)]
        if MARKER not in text:
            words = text.split(" ")
            if "" not in words:
                return words
        return [s[1:] for s in SEGMENT.findall(MARKER + text.replace(" ", MARKER))]

    def learn(self, segments: set[str]) -> None:
        order = sorted(segments, key=len)
        scores, at = [], 0
        while at < len(order):
            length = len(order[at]) + 1
            if length <= LONGEST_TOGETHER:
                part = order[at : at + max(1, CELLS // (2 * length))]
                part = [s for s in part if len(s) < LONGEST_TOGETHER]
                found = self.together([MARKER + s for s in part])
            else:
                part = order[at : at + 1]
                found = [self.alone(MARKER + part[0])]
            at += len(part)
            for segment, (ids, score) in zip(part, found):
                self.known[segment] = len(self.packed)
                self.packed.append(ids)
                scores.append(score)
                self.held += ENTRY + 4 * len(segment) + len(ids)
        self.scores = np.append(self.scores, scores)
        self.facts = np.append(self.facts, self._facts(order, self.packed[len(self.packed) - len(order) :]), axis=1)

    def _facts(self, segments: list[str], packed: list[bytes]) -> np.ndarray:
        """Pieces of segments, how many are bytes, and whether all decode to the segment."""
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        ids = np.frombuffer(b"".join(packed), "<u4")
        owner = np.repeat(np.arange(len(packed)), sizes)
        n_bytes = np.bincount(owner[self.is_byte[ids]], minlength=len(packed))
        text = list(map(self.text.__getitem__, ids.tolist()))
        ends = np.cumsum(sizes).tolist()
        led = [MARKER + s for s in segments]
        same = [
            b"".join(text[a:b]) == s.replace(MARKER, " ").encode("utf-8", "surrogatepass")
            for a, b, s in zip([0, *ends], ends, led)
        ]
        return np.stack([sizes, n_bytes, np.array(same, np.int64)])

    def together(self, segments: list[str]) -> list[tuple[bytes, float]]:
        """The best pieces of segments, all at once."""
        codes = self.trie.codes(segments)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        base, check, end = self.trie.base, self.trie.check, self.trie.end
        n, length = codes.shape
        codes = np.ascontiguousarray(codes.T)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        came = np.zeros((length + 1, n), np.int32)
        piece = np.full((length + 1, n), -1, np.int32)
        for i in range(length):
            rows = inside = np.flatnonzero(sizes > i)
            states = np.zeros(len(rows), np.int32)
            single = np.zeros(n, bool)
            for j in range(i, min(length, i + self.longest)):
                steps = codes[j, rows]
                after = base[states] + steps
                going = (check[after] == states) & (steps > 0)
                rows, states = rows[going], after[going]
                if not len(rows):
                    break
                found = end[states]
                real = found >= 0
                at, which = rows[real], found[real]
                if j == i:
                    single[at] = True
                value = best[i, at] + self.score[which]
                better = value > best[j + 1, at]
                at = at[better]
                best[j + 1, at], came[j + 1, at], piece[j + 1, at] = value[better], i, which[better]
            value = best[i, inside] + self.unknown_score
            better = ~single[inside] & (value > best[i + 1, inside])
            at = inside[better]
            best[i + 1, at], came[i + 1, at], piece[i + 1, at] = value[better], i, -1
        scores = best[sizes, np.arange(n)].tolist()
        return list(zip(self._all_back(segments, sizes, came, piece), scores))

    def _all_back(
        self, segments: list[str], sizes: np.ndarray, came: np.ndarray, piece: np.ndarray
    ) -> list[bytes]:
        """The ids of segments, followed from their ends."""
        rows, at = np.arange(len(segments)), sizes.copy()
        steps, odd = [], np.zeros(len(segments), bool)
        while len(rows):
            which = piece[at, rows]
            odd[rows[which < 0]] = True
            steps.append((rows, which))
            at = came[at, rows]
            rows, at = rows[at > 0], at[at > 0]
        owner = np.concatenate([r for r, _ in reversed(steps)])
        ids = np.concatenate([w for _, w in reversed(steps)])
        order = np.argsort(owner, kind="stable")
        packed = self.number[ids[order]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(segments)))).tolist()
        out = [packed[a:b] for a, b in zip([0, *ends], ends)]
        for row in np.flatnonzero(odd).tolist():  # characters without a piece
            out[row] = self._back(segments[row], came[:, row].tolist(), piece[:, row].tolist())
        return out

    def alone(self, segment: str) -> tuple[bytes, float]:
        """The best pieces of one long segment."""
        trie, score = self.trie, self.score.tolist()
        base, check, end = trie.base, trie.check, trie.end
        codes = [trie.code.get(c, 0) for c in segment]
        length = len(codes)
        best = [0.0] + [float("-inf")] * length
        came, piece = [0] * (length + 1), [-1] * (length + 1)
        for i in range(length):
            state, single = 0, False
            for j in range(i, min(length, i + self.longest)):
                after = int(base[state]) + codes[j]
                if not codes[j] or check[after] != state:
                    break
                state = after
                which = int(end[state])
                if which >= 0:
                    single |= j == i
                    value = best[i] + score[which]
                    if value > best[j + 1]:
                        best[j + 1], came[j + 1], piece[j + 1] = value, i, which
            value = best[i] + self.unknown_score
            if not single and value > best[i + 1]:
                best[i + 1], came[i + 1], piece[i + 1] = value, i, -1
        return self._back(segment, came, piece), best[length]

    def expected(self, segments: list[str], times: np.ndarray) -> np.ndarray:
        """How often each piece is expected in segments met so many times, in parts of ``UNIT``.

        The segments have their markers.
        """
        total = np.zeros(len(self.score), np.int64)
        order = sorted(range(len(segments)), key=lambda k: len(segments[k]))
        while order:
            part = order[-max(1, CELLS // max(1, len(segments[order[-1]]))) :]
            del order[-len(part) :]
            total += self._expected([segments[k] for k in part], times[part])
        return total

    def _expected(self, segments: list[str], times: np.ndarray, logs: bool = False) -> np.ndarray:
        """Forward and backward sums over all segmentations; by ``logs`` if asked to.

        Otherwise by products, where segments whose products get too small are done again.
        """
        codes = self.trie.codes(segments)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        base, check, end = self.trie.base, self.trie.check, self.trie.end
        if logs:
            weight, unknown, plus, times_of = self.score, self.unknown_score, np.logaddexp, np.add
        else:
            weight = np.exp(self.score + self.sizes * np.log(SPREAD))
            unknown = np.exp(self.unknown_score) * SPREAD
            plus, times_of = np.add, np.multiply
        nothing, one = (-np.inf, 0.0) if logs else (0.0, 1.0)
        length = codes.shape[1]
        before = np.full((length + 1, len(segments)), nothing)
        before[0] = one
        edges = []

        def join(i: int, to: int, rows: np.ndarray, which: np.ndarray | None) -> None:
            step = unknown if which is None else weight[which]
            before[to, rows] = plus(before[to, rows], times_of(before[i, rows], step))
            edges.append((i, to, rows, which))

        for i in range(length):
            rows = inside = np.flatnonzero(sizes > i)
            states, single = np.zeros(len(rows), np.int32), np.zeros(len(segments), bool)
            for j in range(i, min(length, i + self.longest)):
                steps = codes[rows, j]
                after = base[states] + steps
                going = (check[after] == states) & (steps > 0)
                rows, states = rows[going], after[going]
                if not len(rows):
                    break
                real = end[states] >= 0
                if j == i:
                    single[rows[real]] = True
                if real.any():
                    join(i, j + 1, rows[real], end[states[real]])
            alone = inside[~single[inside]]
            if len(alone):
                join(i, i + 1, alone, None)
        places = np.arange(len(segments))
        whole = before[sizes, places]
        small = np.zeros(len(segments), bool) if logs else whole < LEAST
        whole[small] = 1
        behind = np.full(before.shape, nothing)
        behind[sizes, places] = one
        found, shares = [], []
        for i, to, rows, which in reversed(edges):
            step = unknown if which is None else weight[which]
            value = times_of(behind[to, rows], step)
            behind[i, rows] = plus(behind[i, rows], value)
            if which is not None:
                if logs:
                    share = np.exp(before[i, rows] + value - whole[rows])
                else:
                    share = np.where(small[rows], 0, before[i, rows] * value / whole[rows])
                found.append(which)
                shares.append(np.rint(share * times[rows] * UNIT))
        total = np.zeros(len(self.score), np.int64)
        if found:  # whole numbers, so their sum is the same in any order
            sums = np.bincount(np.concatenate(found), np.concatenate(shares), len(total))
            total += sums.astype(np.int64)
        if small.any():
            again = np.flatnonzero(small)
            total += self._expected([segments[k] for k in again], times[again], logs=True)
        return total

    def _back(self, segment: str, came: list[int], piece: list[int]) -> bytes:
        out, at = [], len(segment)
        while at:
            start, which = came[at], piece[at]
            if which >= 0:
                out.append(int(self.number[which]))
            elif self.byte:
                out.extend(self.byte[b] for b in reversed(segment[start:at].encode()))
            else:
                out.append(self.unknown)
            at = start
        return array("I", reversed(out)).tobytes()

    def _numbers(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all segments of texts one after another, and where each text begins."""
        if self.held > REMEMBER:
            self.forget()
        flat = list(chain.from_iterable(parts))
        numbers = list(map(self.known.get, flat))
        if None in numbers:
            self.learn({s for s, n in zip(flat, numbers) if n is None})
            numbers = list(map(self.known.__getitem__, flat))
        return np.array(numbers, np.int64), np.cumsum([0, *map(len, parts)])

    def encode(self, texts: list[str]) -> list[tuple[bytes, float]]:
        """Ids (little-endian unsigned 32-bit) and score of each text."""
        return [(ids, score) for ids, score, *_ in self.encoded(texts)]

    def encoded(self, texts: list[str]) -> list[tuple[bytes, float, int, int, bool]]:
        """Ids, score, pieces, pieces that are bytes, and whether the ids decode to the text.

        A text decodes to itself if each of its segments does, as decoding joins the pieces; a
        marker in the text itself comes back as a space.
        """
        parts = [self.segments(t) for t in texts]
        numbers, starts = self._numbers(parts)
        facts = self.facts[:, numbers]
        sums = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(facts, axis=1)], axis=1)
        sums = sums[:, starts[1:]] - sums[:, starts[:-1]]
        every = list(map(self.packed.__getitem__, numbers.tolist()))
        out = []
        for row, (text, a, b) in enumerate(zip(texts, starts.tolist(), starts[1:].tolist())):
            kept = bool(sums[2, row] == b - a) and MARKER not in text
            score = float(self.scores[numbers[a:b]].sum())
            out.append((b"".join(every[a:b]), score, int(sums[0, row]), int(sums[1, row]), kept))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids; the marker that every text begins with is no space of its own."""
        text = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text.decode("utf-8", "replace")[1:] if text[:1] == b" " else text.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def pieces(path: str, scores: bytes | None = None) -> Pieces:
    """One set for each Python worker, kept between tasks; ``scores`` are packed floats."""
    return Pieces(path) if scores is None else pieces(path).scored(np.frombuffer(scores))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _groups(texts: Iterator[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= TEXTS_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def segment_counts(df: DataFrame, text_column: str, path: str) -> DataFrame:
    """``segment`` with its marker and ``n`` over all texts; long ones in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        marker = MARKER if own.apart else ""
        whole, parts = Counter(), Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([*(marker + s for s in whole), *parts], pa.string()),
                    pa.array([*whole.values(), *parts.values()], pa.int64()),
                ],
                ["segment", "n"],
            )
            whole.clear()
            parts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                segments = own.segments(text.as_py() or "")
                if segments and max(map(len, segments)) >= PART:
                    for segment in segments:
                        if len(segment) >= PART:
                            led = marker + segment
                            parts.update(led[at : at + PART] for at in range(0, len(led), PART))
                    segments = [s for s in segments if len(s) < PART]
                whole.update(segments)
                if len(whole) + len(parts) > FLUSH:
                    yield flushed()
        if whole or parts:
            yield flushed()

    texts = df.select(column(df, text_column).alias("text"))
    return in_tasks(texts, run, "segment string, n long").groupBy("segment").agg(F.sum("n").alias("n"))


def learn_scores(
    df: DataFrame, text_column: str = "text", model: str | None = None, rounds: int = EM_ROUNDS
) -> np.ndarray:
    """Log probabilities of the pieces, in the order of ``Pieces.number``, from all texts."""
    path = model or default_model()
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = segment_counts(df, text_column, path).repartition(tasks, "segment")
    counts = materialise(counts, "pieces-segments")
    size = len(pieces(path).number)
    scores = np.full(size, -np.log(size))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(scores.tobytes())

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, total = pieces(path, shared.value), np.zeros(size, np.int64)
            for batch in batches:
                total += own.expected(batch.column(0).to_pylist(), batch.column(1).to_numpy())
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["piece", "n"])

        summed = in_tasks(counts, run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
        total = np.full(size, SMOOTH)
        for row in summed.collect():  # at most one row for each piece
            total[row.piece] += row.n / UNIT
        scores = np.log(total / total.sum())
    return scores


def encode(
    df: DataFrame,
    text_column: str = "text",
    model: str | None = None,
    scores: np.ndarray | None = None,
) -> DataFrame:
    """``row`` (all columns of ``df``), ``piece_ids``, ``n_pieces``, ``n_bytes`` (pieces that
    are bytes), ``log_score``, and ``round_trip``: the ids decode to the text.

    Without ``scores`` they are learnt from the texts.
    """
    path = model or default_model()
    scores = learn_scores(df, text_column, path) if scores is None else scores
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(scores, np.float64).tobytes())
    rows = df.select(F.struct(*[column(df, c) for c in df.columns]).alias("row"))
    place = df.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path, shared.value)
        for batch in batches:
            row, first = batch.column(0), 0
            for group in _groups(t.as_py() or "" for t in row.field(place)):
                ids, scores, n_pieces, n_bytes, same = zip(*own.encoded(group))
                yield pa.RecordBatch.from_arrays(
                    [
                        row.slice(first, len(group)),
                        pa.array(ids, pa.binary()),
                        pa.array(n_pieces, pa.int64()),
                        pa.array(n_bytes, pa.int64()),
                        pa.array(scores, pa.float64()),
                        pa.array(same),
                    ],
                    ["row", "piece_ids", "n_pieces", "n_bytes", "log_score", "round_trip"],
                )
                first += len(group)

    kind = rows.schema["row"].dataType.simpleString()
    out = f"row {kind}, piece_ids binary, n_pieces long, n_bytes long, log_score double"
    return in_tasks(rows, run, f"{out}, round_trip boolean")


def decode(df: DataFrame, ids_column: str = "piece_ids", model: str | None = None) -> DataFrame:
    """``row`` (all columns of ``df``) and ``decoded``; null ids count as none."""
    path = model or default_model()
    rows = df.select(
        F.struct(*[column(df, c) for c in df.columns]).alias("row"), column(df, ids_column).alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for batch in batches:
            found = [own.decode(ids.as_py() or b"") for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())], ["row", "decoded"]
            )

    return in_tasks(rows, run, f"row {rows.schema['row'].dataType.simpleString()}, decoded string")
