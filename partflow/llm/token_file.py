"""Token ids of all documents in binary shards, boundaries in Elias-Fano code.

A shard is one self-contained byte string: head, document ids, the documents'
end positions in Elias-Fano code, and all ids in the narrowest of two or four
bytes. Shards are rows of a Parquet table in ascending document order, so they
are committed as Spark commits any output and can live in any store.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm import elias_fano
from partflow.llm.common import slices
from partflow.llm.tokens import chunk_encoder, default_path, tokenizer_json

MAGIC, VERSION = b"TOKS", 1
_HEAD = struct.Struct("<4sBB2xQQ")
#: Bytes of text that go into one shard; whole documents, so a long one may pass it.
SHARD_BYTES = 4 << 20
NO_ID = np.int64(-(1 << 63))


def encode_shard(doc_ids: np.ndarray, ends: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    head = _HEAD.pack(MAGIC, VERSION, width, len(doc_ids), len(ids))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), elias_fano.encode(ends), ids.astype(f"<u{width}").tobytes()])


class Shard:
    """Reads a shard: ``ids(k)`` are the ids of its k-th document."""

    def __init__(self, data: bytes):
        magic, version, self.width, self.docs, self.total = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard")
        view = memoryview(data)
        at = _HEAD.size
        self.doc_ids = np.frombuffer(view, "<i8", self.docs, at)
        at += 8 * self.docs
        self.ends = elias_fano.Reader(view[at:])
        self.body = np.frombuffer(view, f"<u{self.width}", self.total, at + self.ends.size)

    def ids(self, k: int) -> np.ndarray:
        return self.body[self.ends.select(k - 1) if k else 0 : self.ends.select(k)]


def write_token_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the shards to ``path``.

    Order: ascending id, null ids first, repeated ids by text. Null texts are
    empty; rows are never merged. Other columns take no part.
    """
    json = tokenizer_json(tokenizer)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(json)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        part, before = TaskContext.get().partitionId(), 0
        for k, batch in enumerate(slices(batches, "text", SHARD_BYTES)):
            ids, starts = encoder.encode(batch.column("text"))
            ids = np.insert(ids, starts[1:], end_id)
            ends = starts[1:] + np.arange(1, batch.num_rows + 1)
            doc_ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "shard": pa.array([k], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "body": pa.array([encode_shard(doc_ids, ends, ids, width)], pa.binary()),
                }
            )
            before += len(ids)

    shards = ordered.mapInArrow(run, "part int, shard int, before long, n_ids long, body binary")
    shards.write.option("compression", "none").parquet(path)


def part_bases(shards: DataFrame) -> DataFrame:
    """Ids before each part: one row per write task, so few enough for the driver."""
    spark = shards.sparkSession
    sizes = sorted((r["part"], r["n"]) for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    sums = [0, *accumulate(n for _, n in sizes)]
    return spark.createDataFrame([(p, s) for (p, _), s in zip(sizes, sums)], "part int, base long")


def read_token_shards(shards: DataFrame) -> DataFrame:
    """A row per document: doc_id, start (ids before it), n_tokens, ids (little-endian 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for many in batches:
            for row in many.to_pylist():
                shard = Shard(row["body"])
                ends = shard.ends.all()
                starts = np.concatenate([[0], ends])[:-1]
                ids = shard.body.astype("<u4")
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(shard.doc_ids, mask=shard.doc_ids == NO_ID),
                        "start": pa.array(starts + row["base"] + row["before"], pa.int64()),
                        "n_tokens": pa.array(ends - starts, pa.int64()),
                        "ids": pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    }
                )

    based = shards.join(F.broadcast(part_bases(shards)), "part").select("before", "base", "body")
    return based.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def default_tokenizer() -> str:
    return default_path("word_bpe_49k.json")
