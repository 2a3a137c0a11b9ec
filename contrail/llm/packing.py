"""Harmonic packing of token ids into sequences of one capacity.

Lengths are partitioned into reciprocal classes: class i has those in (capacity/(i+1), capacity/i], and a bin of class i
takes exactly i pieces. Documents are cut so that little is lost: whole capacities first (class 1), then the rest whole if it
falls short of its class's share, floor(capacity/i), by a part of `slack` at most; else a piece of the next class's share is
cut off and what is left is looked at again. Each worker fills the bins of its classes by counting alone: no shuffle, no
exchange of bin states. Bins that are still open at the end of a worker's rows are laid end to end.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from contrail.llm.common import bounded, lean
from contrail.llm.tokens import encoder

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, class int, ids binary"
#: sequence_id = worker * WORKER + a worker's own count.
WORKER = 1 << 36


@lru_cache(maxsize=1 << 16)
def shares(rest: int, capacity: int, slack: int) -> tuple[tuple[int, int], ...]:
    """(length, class) of the pieces of what is left of a document, 1 to capacity tokens."""
    out = []
    while rest:
        i = capacity // rest
        share = capacity // i
        if (share - rest) * slack > share:
            i = -(-capacity // rest)
            while capacity // i > rest:
                i += 1
            share = capacity // i
        out.append((min(rest, share), i))
        rest -= out[-1][0]
    return tuple(out)


def cut(n_tokens: int, capacity: int, slack: int):
    """(start, length, class) of a document's pieces."""
    start = 0
    while n_tokens - start >= capacity:
        yield start, capacity, 1
        start += capacity
    for length, i in shares(n_tokens - start, capacity, slack):
        yield start, length, i
        start += length


class Bins:
    """The open bin of each class of one worker; pieces leave when their bin is full, with sequence_id, offset and class. A
    piece is (doc_id, start, length, doc_tokens, its ids as bytes)."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.open = capacity, first, {}

    def add(self, piece: tuple, i: int):
        pieces = self.open.setdefault(i, [])
        pieces.append(piece)
        if len(pieces) == i:
            yield from self._close(pieces, i)
            self.open[i] = []

    def _close(self, pieces: list[tuple], i: int):
        at = 0
        for doc_id, start, length, n, ids in pieces:
            yield doc_id, start, length, n, self.next, at, i, ids
            at += length
        self.next += 1

    def rest(self):
        """Pieces of open bins end to end, cut where a sequence is full; the last sequences are the powers of two in what is left,
        which need no padding. Their class is 0."""
        pieces = [p for _, x in sorted(self.open.items()) for p in x]
        left = sum(p[2] for p in pieces)
        size = self._size(left)
        row: list[tuple] = []
        used = 0
        for doc_id, start, length, n, ids in pieces:
            at = 0
            while at < length:
                part = min(length - at, size - used)
                row.append((doc_id, start + at, part, n, ids[4 * at : 4 * (at + part)]))
                at, used, left = at + part, used + part, left - part
                if used == size:
                    yield from self._close(row, 0)
                    row, used, size = [], 0, self._size(left)

    def _size(self, left: int) -> int:
        return self.capacity if left >= self.capacity else 1 << max(left.bit_length() - 1, 0)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, slack: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, class, ids (little-endian
    unsigned 32-bit). Each document's ids, with end_id after them, lie in exactly one piece each; offsets of a
    sequence run gapless from 0. A sequence of class i holds i pieces and needs padding of capacity/slack + i tokens at
    most; those of class 0 come from bins that stayed open and are `capacity` or a power of two long.

    tokenizer: path of a tokenizers JSON file. Null and empty texts are end_id alone;
    repeated rows are packed each by itself; null ids are kept; other columns are not read; no rows, no pieces.
    A worker holds one open bin per class, about 2 sqrt(capacity) bins. Sequence numbers follow the input's partitions.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"capacity must be a power of two, not {capacity}")

    def run(batches):
        from pyspark import TaskContext

        lean("contrail.llm.tokens")
        tool = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        bins = Bins(capacity, TaskContext.get().partitionId() * WORKER)

        def rows():
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                for first, ids, ends in tool.column(batch.column(1)):
                    begin = 0
                    for doc_id, stop in zip(doc_ids[first : first + len(ends)], ends.tolist()):
                        own = ids[begin:stop].astype("<u4", copy=False).tobytes() + end
                        n, begin = stop - begin + 1, stop
                        for start, length, i in cut(n, capacity, slack):
                            yield from bins.add((doc_id, start, length, n, own[4 * start : 4 * (start + length)]), i)
            yield from bins.rest()

        yield from record_batches(rows(), PIECES)

    return bounded(docs).select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA)


PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()), ("class", pa.int32()), ("ids", pa.binary()),
])


def record_batches(rows, schema: pa.Schema, size: int = 10_000):
    from contrail.llm.common import chunks

    for part in chunks(rows, size):
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*part), schema.types)], schema=schema)
