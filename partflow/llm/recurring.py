"""Which fingerprints of a batch also occur in another batch.

A batch is a run of documents, written once with its id, so that later passes
see the same batches whatever happens to the cluster. Tasks send each batch's
distinct fingerprints, sorted and cut into value ranges, as one binary row per
range; a range's task answers with one bit per fingerprint. A fingerprint that
very many documents share is one entry per batch, so no range is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import slices
from partflow.session import materialize

#: Bytes of text of a batch, and of text whose fingerprints meet in one range.
BATCH_BYTES, RANGE_BYTES, LEAST_RANGES = 2 << 20, 16 << 20, 64
#: A fingerprint: 96 bits.
PRINT = np.dtype([("a", "<u8"), ("b", "<u4")])


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(body: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(body)))


def write_batches(docs: DataFrame, text: str, name: str) -> DataFrame:
    """All rows and columns of ``docs`` as a table (batch, n_bytes, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, part in enumerate(slices(batches, text, BATCH_BYTES)):
            yield pa.RecordBatch.from_pydict(
                {"batch": pa.array([first + k], pa.int64()), "n_bytes": pa.array([part.get_total_buffer_size()], pa.int64()), "body": pa.array([pack(part)], pa.binary())}
            )

    return materialize(docs.mapInArrow(run, "batch long, n_bytes long, body binary"), name)


def ranges_for(batches: DataFrame) -> int:
    """Value ranges to use: in proportion to the bytes of all batches."""
    total = batches.agg(F.sum("n_bytes")).first()[0] or 0
    return max(LEAST_RANGES, int(total) // RANGE_BYTES)


def _edges(n: int) -> np.ndarray:
    return np.array([(k << 64) // n for k in range(1, n)], dtype=np.uint64)


def _cuts(prints: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.searchsorted(prints["a"], _edges(n)), [len(prints)]])


def distinct_prints(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints, each input's place among them, and counts."""
    order = np.lexsort((b, a))
    sa, sb = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
    rank = np.cumsum(new) - 1
    place = np.empty(len(a), np.int64)
    place[order] = rank
    prints = np.empty(int(new.sum()), PRINT)
    prints["a"], prints["b"] = sa[new], sb[new]
    return prints, place, np.bincount(rank, minlength=len(prints))


def range_rows(batch: int, prints: np.ndarray, n: int) -> pa.RecordBatch:
    """A row per value range that holds any of the batch's fingerprints."""
    cuts = _cuts(prints, n)
    full = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_pydict(
        {
            "range": pa.array(full, pa.int32()),
            "batch": pa.array(np.full(len(full), batch), pa.int64()),
            "body": pa.array([prints[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
        }
    )


RANGE_SCHEMA = "range int, batch long, body binary"


def recurring(rows: DataFrame, name: str) -> DataFrame:
    """A table (batch, flags): bits of the fingerprints that other batches have too."""

    def meet(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), PRINT) for x in group.column("body")]
        sizes = np.array([len(x) for x in parts])
        every = np.concatenate(parts)
        _, place, count = distinct_prints(every["a"], every["b"])
        hit = count[place] > 1
        ends = np.cumsum(sizes)
        bits = [np.packbits(hit[e - s : e]).tobytes() for s, e in zip(sizes, ends)]
        return pa.table({"range": group.column("range"), "batch": group.column("batch"), "bits": pa.array(bits, pa.binary())})

    met = rows.groupBy("range").applyInArrow(meet, "range int, batch long, bits binary")
    return materialize(met.groupBy("batch").agg(F.collect_list(F.struct("range", "bits")).alias("flags")), name)


def flags_of(prints: np.ndarray, flags: list | None, n: int) -> np.ndarray:
    """The answer for a batch as one boolean per fingerprint."""
    out = np.zeros(len(prints), bool)
    cuts = _cuts(prints, n)
    for one in flags or ():
        lo, hi = cuts[one["range"]], cuts[one["range"] + 1]
        out[lo:hi] = np.unpackbits(np.frombuffer(one["bits"], np.uint8), count=hi - lo)
    return out


def each_batch(source: DataFrame, work: Callable[[dict, pa.RecordBatch], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``work(row, documents)`` for every batch; its results are the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for many in batches:
            for k in range(many.num_rows):
                row = many.slice(k, 1).to_pylist()[0]
                yield from work(row, unpack(row.pop("body")))

    return source.mapInArrow(run, schema)
