"""Bounded-space online packing of documents into token sequences.

Each partition keeps a fixed number of open windows. A document's full windows are sequences of
their own; its rest goes to the open window it fits best. When it fits none, the
fullest window is topped up with the head of the rest, emitted, and its place is free. Windows still
open at the end of a partition are leftovers: they are packed again, many partitions in one, until one partition remains,
whose last windows are cut into lengths that need no padding.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import text_blocks
from panelkit.llm.tokens import Encoder
from panelkit.session import stage, stage_sized

LENGTH = 2048
OPEN = 32
END = 1
#: Partitions whose leftovers one task packs again.
MERGE = 16
SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


class Packer:
    """The open windows of one partition. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, length: int, windows: int, first_id: int):
        self.length, self.windows, self.next = length, windows, first_id
        self.open: list[tuple[int, int, list]] = []  # (tokens, serial, pieces), emptiest first
        self.serial = 0

    def _emit(self, pieces):
        at, rows = 0, []
        for doc, start, ids, total in pieces:
            rows.append((doc, start, len(ids), total, self.next, at, ids))
            at += len(ids)
        self.next += 1
        return rows

    def add(self, doc, start, ids, total):
        """Rows of the sequences that this piece fills."""
        out = []
        while len(ids) >= self.length:
            out += self._emit([(doc, start, ids[: self.length], total)])
            start, ids = start + self.length, ids[self.length :]
        if not len(ids):
            return out
        # the fullest window that still has room for it
        i = bisect.bisect_right(self.open, self.length - len(ids), key=lambda w: w[0]) - 1
        if i < 0 and len(self.open) >= self.windows:
            room = self.length - self.open[-1][0]
            _, _, pieces = self.open.pop()
            out += self._emit([*pieces, (doc, start, ids[:room], total)])
            start, ids = start + room, ids[room:]
        tokens, pieces = 0, []
        if i >= 0:
            tokens, _, pieces = self.open.pop(i)
        pieces.append((doc, start, ids, total))
        tokens += len(ids)
        if tokens == self.length:
            return out + self._emit(pieces)
        self.serial += 1
        bisect.insort(self.open, (tokens, self.serial, pieces), key=lambda w: w[:2])
        return out

    def leftovers(self):
        """Pieces of the open windows, without a place yet."""
        return [(doc, start, len(ids), total, None, None, ids) for _, _, pieces in self.open for doc, start, ids, total in pieces]

    def finish(self):
        """The open windows as sequences: cut where the length falls apart into powers of two."""
        out = []
        rows = [p for _, _, pieces in sorted(self.open, key=lambda w: -w[0]) for p in pieces]
        left = sum(len(p[2]) for p in rows)
        room, pieces = 0, []
        for doc, start, ids, total in rows:
            while len(ids):
                if not room:
                    room = min(self.length, 1 << (left.bit_length() - 1))
                take = min(room, len(ids))
                pieces.append((doc, start, ids[:take], total))
                start, ids, room, left = start + take, ids[take:], room - take, left - take
                if not room:
                    out += self._emit(pieces)
                    pieces = []
        return out


def _batch(rows):
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * 6
    arrays = [pa.array(c, k) for c, k in zip(columns[:6], kinds, strict=True)]
    arrays.append(pa.array([np.ascontiguousarray(x, "<u4").tobytes() for x in columns[6]], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, windows: int = OPEN, end: int = END) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of all documents.

    A document is its ids and then ``end``; a null text counts as empty and so is one token. Every id
    lies in exactly one piece. ``ids`` holds the piece's ids as little-endian 32-bit numbers.
    Sequences are ``length`` long, but for the last ones of all, whose lengths are powers of two.
    Repeated rows are packed each for itself (their pieces share the doc_id, null ids too), and other columns are ignored.
    """

    def first(batches):
        packer, encoder, rows = Packer(length, windows, TaskContext.get().partitionId() << 32), Encoder(tokenizer), []
        held = 0
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for a, b, _, _ in text_blocks(batch.column(1)):
                texts = ["" if t is None else t for t in batch.column(1).slice(a, b - a).to_pylist()]
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                for doc, z, n in zip(numbers[a:b], ends.tolist(), counts.tolist(), strict=True):
                    own = np.append(ids[z - n : z], np.uint32(end))
                    new = packer.add(doc, 0, own, n + 1)
                    held += sum(r[2] for r in new)
                    rows += new
                    if held > 1 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
        rows += packer.leftovers()
        if rows:
            yield _batch(rows)

    def again(number, last):
        def run(batches):
            base = (number << 52) | (TaskContext.get().partitionId() << 32)
            packer, rows = Packer(length, windows, base), []
            for batch in batches:
                for doc, start, total, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    rows += packer.add(doc, start, np.frombuffer(ids, "<u4"), total)
                if rows:
                    yield _batch(rows)
                    rows = []
            rows += packer.finish() if last else packer.leftovers()
            if rows:
                yield _batch(rows)

        return run

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(1, kept.rdd.getNumPartitions())
    found = stage(kept.mapInArrow(first, SCHEMA), "packed")
    result = found.where("sequence_id is not null")
    number = 1
    while True:
        left = found.where("sequence_id is null").select("doc_id", "start", "doc_tokens", "ids")
        parts = -(-parts // MERGE)
        last = parts == 1
        dealt = left.repartition(parts, F.xxhash64("doc_id", "start", "ids")).sortWithinPartitions(F.desc(F.length("ids")), "doc_id", "start", "ids")
        found = stage_sized(dealt.mapInArrow(again(number, last), SCHEMA), "packed-again")[0]
        result = result.unionByName(found.where("sequence_id is not null"))
        if last:
            return result
        number += 1
