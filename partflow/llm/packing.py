"""Packing of token ids into fixed windows by Karmarkar-Karp multiway differencing.

A task fills windows of ``capacity`` straight from whole stretches of long
documents. What is left (short documents and tails) is cut into pieces of at
most ``capacity / 4`` and gathered until a group is nearly a whole number of
windows. Differencing then splits the group: every piece starts as a partition
(one window holds it, the others nothing); the two partitions of the largest
imbalance are merged, the fullest windows of one onto the emptiest of the other,
until one partition is left. Its windows are near-equal. If the fullest passes
the capacity, the number of windows rises and the group is split again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from partflow.llm.common import slices
from partflow.llm.tokens import chunk_encoder, tokenizer_json

CAPACITY, PIECES = 1024, 4
#: Windows of a group, and the ids its windows leave free on average.
GROUP_WINDOWS, SLACK = 64, 2


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """``k`` lists of indexes into ``sizes`` with near-equal sums, fullest first."""
    order = count()
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = size
        heap.append((-size, next(order), sums, [[i]] + [[]] * (k - 1)))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, of_a = heapq.heappop(heap)
        _, _, b, of_b = heapq.heappop(heap)
        sums = a + b[::-1]
        rank = np.argsort(-sums, kind="stable")
        sums = sums[rank]
        merged = [of_a[r] + of_b[k - 1 - r] for r in rank.tolist()]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), next(order), sums, merged))
    return heap[0][3] if heap else [[] for _ in range(k)]


def split_group(sizes: list[int], capacity: int) -> list[list[int]]:
    """The group in as few near-equal windows as differencing makes fit."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = difference(sizes, k)
        if max((sum(sizes[i] for i in w) for w in windows), default=0) <= capacity:
            return [w for w in windows if w]
        k += 1


class _Packer:
    """Turns a stream of documents into window rows."""

    def __init__(self, part: int, capacity: int):
        self.capacity, self.piece = capacity, max(1, capacity // PIECES)
        self.target = max(1, GROUP_WINDOWS * (capacity - SLACK))
        self.sequence = part << 33
        self.waiting: list[tuple] = []
        self.size = 0
        self.rows: list[tuple] = []

    def _put(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, doc_tokens in pieces:
            self.rows.append((doc, start, len(ids), ids.tobytes(), doc_tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.capacity
        for at in range(0, whole, self.capacity):
            self._put([(doc, at, ids[at : at + self.capacity], n)])
        at = whole
        while at < n:
            size = min(self.piece, n - at, self.target - self.size)
            self.waiting.append((doc, at, ids[at : at + size], n))
            self.size += size
            at += size
            if self.size == self.target:
                self.flush()

    def flush(self) -> None:
        if self.waiting:
            for window in split_group([len(x[2]) for x in self.waiting], self.capacity):
                self._put([self.waiting[i] for i in window])
        self.waiting, self.size = [], 0

    def take(self) -> pa.RecordBatch:
        names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        columns = zip(*self.rows) if self.rows else [[]] * 7
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=list(names))
        self.rows = []
        return batch


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents, each in a sequence of at most ``capacity`` ids.

    A document is its text's ids and ``end_id``; a null text is empty, a null id
    stays null, repeated rows are documents of their own. Pieces lie gapless
    from offset 0 in their sequence. Sequence ids are unique and rise within a
    task. Other columns take no part. An empty table gives no row.
    """
    json = tokenizer_json(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(json)
        packer = _Packer(TaskContext.get().partitionId(), capacity)
        for batch in slices(batches, "text", 1 << 20):
            ids, starts = encoder.encode(batch.column("text"))
            for k, doc in enumerate(batch.column("id").to_pylist()):
                packer.add(doc, np.append(ids[starts[k] : starts[k + 1]], np.uint32(end_id)).astype("<u4"))
            yield packer.take()
        packer.flush()
        yield packer.take()

    rows = docs.selectExpr(f"cast(`{id_column}` as long) as id", f"`{text}` as text")
    return rows.mapInArrow(run, SCHEMA)
