"""Hierarchical packing of documents into sequences of several context sizes.

Each document is encoded and gets an end id. Whole windows of the largest size become
sequences of their own. What is left of a document is routed to the smallest context size
(tier) that holds it. From the largest tier down, an item opens a sequence of exactly its
tier's size, and the gap is filled from shorter tiers: with whole items that fit, longest
first, then with the head of one more item, whose tail is routed anew. So a sequence has
the size of its tier, a power of two, without padding. What remains at the end of a
partition is chained and cut into falling powers of two.

Sequences of one size are dealt to step groups that hold the same number of tokens, so
all sequences of a step cost the same.

Packing needs no shuffle: each task packs the rows of its own partition, batch by batch,
and keeps less than a batch; ``sequence_id`` has the partition's number in its upper bits.

Defined results: null text counts as empty, and an empty text is its end id alone; ids and
repeated rows are carried along unchanged, each row is a document of its own; an empty
table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import column, in_tasks
from obs_engine.llm.encoding import default_tokenizer, encoder

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 1 << 16
WIDTH = 4  # bytes of an id


class Item:
    """A piece of a document: ``length`` ids from ``start`` on."""

    __slots__ = ("doc", "start", "length", "ids", "total")

    def __init__(self, doc, start: int, length: int, ids: bytes, total: int):
        self.doc, self.start, self.length, self.ids, self.total = doc, start, length, ids, total

    def cut(self, head: int) -> tuple[Item, Item]:
        at = head * WIDTH
        return (
            Item(self.doc, self.start, head, self.ids[:at], self.total),
            Item(self.doc, self.start + head, self.length - head, self.ids[at:], self.total),
        )


class Packer:
    """Packs the documents of one partition; ``out`` has the pieces of finished sequences."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, partition: int):
        if any(t & (t - 1) for t in tiers):
            raise ValueError("context sizes must be powers of two")
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.base = partition << 33
        self.sequences = 0
        self.per_size: dict[int, int] = {}
        self.waiting: list[Item] = []  # by length
        self.out: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        largest, total = self.tiers[-1], len(ids) // WIDTH
        rest = Item(doc, 0, total, ids, total)
        whole = total // largest
        for k in range(whole):
            at = k * largest
            self.finish([Item(doc, at, largest, ids[at * WIDTH : (at + largest) * WIDTH], total)])
        if whole:
            rest = rest.cut(whole * largest)[1]
        if rest.length:
            self.wait(rest)

    def wait(self, item: Item) -> None:
        insort(self.waiting, item, key=lambda x: x.length)

    def finish(self, items: list[Item]) -> None:
        size = sum(x.length for x in items)
        of_size = self.per_size.get(size, 0)
        self.per_size[size] = of_size + 1
        step = of_size * size // self.step_tokens
        group = self.base | size.bit_length() << 26 | step
        offset = 0
        for x in items:
            self.out.append(
                (x.doc, x.start, x.length, x.ids, x.total, self.base | self.sequences, offset, size, group)
            )
            offset += x.length
        self.sequences += 1

    def pack(self) -> None:
        """Pack what waits, but for less than a sequence of the largest size."""
        left = sum(x.length for x in self.waiting)
        while self.waiting:
            opening = self.waiting[-1]
            size = self.tiers[bisect_left(self.tiers, opening.length)]
            if left < size:
                return
            items, gap = [self.waiting.pop()], size - opening.length
            while gap and self.waiting:
                fits = bisect_right(self.waiting, gap, key=lambda x: x.length)
                if fits:
                    items.append(self.waiting.pop(fits - 1))
                else:  # the shortest is too long: its head fills the gap
                    head, tail = self.waiting.pop(0).cut(gap)
                    items.append(head)
                    self.wait(tail)
                gap -= items[-1].length
            left -= size
            self.finish(items)

    def close(self) -> None:
        """Chain the rest and cut it into falling powers of two."""
        self.pack()
        left = sum(x.length for x in self.waiting)
        while left:
            size = 1 << (left.bit_length() - 1)
            items, need = [], size
            while need:
                item = self.waiting.pop()
                if item.length > need:
                    item, tail = item.cut(need)
                    self.waiting.append(tail)
                items.append(item)
                need -= item.length
            left -= size
            self.finish(items)


def pack(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row for each piece: id, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id``, ``offset``, ``sequence_tokens``, ``step_group``.
    """
    path = tokenizer or default_tokenizer()
    rows = df.select(column(df, id_column).alias("id"), column(df, text_column).alias("text"))
    kind = rows.schema["id"].dataType
    schema = (
        f"id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long, sequence_tokens long, step_group long"
    )
    end = end_id.to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId())
        encode, id_type = encoder(path).encode, None

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*packer.out)) if packer.out else [()] * 9
            packer.out = []
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names
            )

        for batch in batches:
            id_type = batch.column(0).type
            for doc, text in zip(batch.column(0), batch.column(1)):
                packer.add(doc.as_py(), encode(text.as_py() or "") + end)
                if len(packer.out) >= 5_000:
                    yield flushed()
            packer.pack()
            yield flushed()
        if id_type is not None:
            packer.close()
            yield flushed()

    names = [part.split()[0] for part in schema.replace(kind.simpleString(), "x", 1).split(", ")]
    return in_tasks(rows, run, schema).withColumnRenamed("id", id_column)


def with_checksum(pieces: DataFrame, keep_ids: bool = False) -> DataFrame:
    """``ids_crc32`` in the place of ``ids``, or beside them."""
    made = pieces.withColumn("ids_crc32", F.crc32("ids"))
    return made if keep_ids else made.drop("ids")
