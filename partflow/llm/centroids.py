"""Centroid clustering on subvector dictionaries.

Vectors are integers. Once, every batch of vectors is written with its dimensions
in blocks, and each block as a dictionary of its distinct subvectors and a code
for each vector; this loses nothing. Neighbouring blocks are joined while their
dictionary stays small, so repetitive dimensions share one. A round then works
out the exact squared distance of every distinct subvector to every centroid
once, adds those up by code for each vector, and counts codes by cluster: the
sums of a cluster are its counts times the dictionary. A dictionary has no more
entries than its batch has vectors, so nothing grows with the table, and nothing
is broadcast but the centroids.

All arithmetic is exact: 64-bit integers where no square can overflow, whole
Python numbers otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.session import materialize

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Blocks are joined up to so many distinct subvectors, for a batch of any size.
DICTIONARY = 1024
#: Components up to here never overflow the sum of 64-bit squares of a vector.
SMALL = 1 << 27
MOST = (1 << 63) - 1
ENCODED = "ids binary, known binary, widths binary, sizes binary, words binary, codes binary, n int"


def usable(vectors: DataFrame, id_column: str, vector: str, dimensions: int) -> DataFrame:
    """(id, v) of the rows whose vector has so many components, none null or non-finite."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter((F.size("v") == dimensions) & finite)


def _scaled(v: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    x = np.floor(pa.compute.list_flatten(v).to_numpy(zero_copy_only=False).reshape(-1, dimensions) * float(scale))
    return np.clip(x, -float(1 << 62), float(1 << 62)).astype(np.int64)


def encode(x: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(subvectors, codes) of every block of the columns of ``x``, losslessly."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(x.shape[1]):
        values, codes = np.unique(x[:, c], return_inverse=True)
        block = values[:, None], codes
        if done:
            words, held = done[-1]
            pair, both = np.unique(held.astype(np.int64) * len(values) + codes, return_inverse=True)
            if len(pair) <= most:
                block = np.column_stack([words[pair // len(values)], values[pair % len(values)]]), both
                done.pop()
        done.append(block)
    return done


def _pack(ids: pa.Array, blocks: list[tuple[np.ndarray, np.ndarray]], n: int) -> pa.RecordBatch:
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    parts = [
        ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"),
        np.packbits(known),
        np.array([w.shape[1] for w, _ in blocks], "<i4"),
        np.array([len(w) for w, _ in blocks], "<i4"),
        np.concatenate([w.reshape(-1) for w, _ in blocks]).astype("<i8") if blocks else np.zeros(0, "<i8"),
        np.concatenate([c for _, c in blocks]).astype("<u4" if n > 1 << 16 else "<u2") if blocks else np.zeros(0, "<u2"),
    ]
    names = [f.split()[0] for f in ENCODED.split(", ")]
    return pa.RecordBatch.from_arrays([*(pa.array([p.tobytes()], pa.binary()) for p in parts), pa.array([n], pa.int32())], names=names)


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    n = row["n"]
    widths, sizes = np.frombuffer(row["widths"], "<i4"), np.frombuffer(row["sizes"], "<i4")
    words = np.split(np.frombuffer(row["words"], "<i8"), np.cumsum(widths * sizes)[:-1])
    codes = np.frombuffer(row["codes"], "<u4" if n > 1 << 16 else "<u2").reshape(len(widths), n)
    blocks = [(w.reshape(size, width), c) for w, size, width, c in zip(words, sizes, widths, codes)]
    return np.frombuffer(row["ids"], "<i8"), np.unpackbits(np.frombuffer(row["known"], np.uint8), count=n).astype(bool), blocks


def distances(blocks: list[tuple[np.ndarray, np.ndarray]], centroids: list[list[int]], n: int) -> np.ndarray:
    """Squared distance of every vector to every centroid: partial ones per subvector, added by code."""
    large = max((int(np.abs(w).max(initial=0)) for w, _ in blocks), default=0) > SMALL or any(abs(c) > SMALL for row in centroids for c in row)
    centre = np.array(centroids, object if large else np.int64)
    total, at = np.zeros((n, len(centroids)), centre.dtype), 0
    for words, codes in blocks:
        part = np.zeros((len(words), len(centroids)), centre.dtype)
        for c in range(words.shape[1]):
            gap = words[:, c].astype(centre.dtype)[:, None] - centre[None, :, at + c]
            part += gap * gap
        total += part[codes]
        at += words.shape[1]
    return total


def _nearest(far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid, ties to the smaller number, and its distance."""
    best = np.argmin(far, 1) if len(far) else np.zeros(0, np.int64)
    return best, far[np.arange(len(far)), best]


def cluster_sums(blocks: list[tuple[np.ndarray, np.ndarray]], cluster: np.ndarray, k: int) -> list[list[int]]:
    """Component sums of every cluster: how often it has each subvector, times the subvector."""
    sums: list[list[int]] = [[] for _ in range(k)]
    for words, codes in blocks:
        often = np.bincount(cluster * len(words) + codes, minlength=k * len(words)).reshape(k, len(words))
        large = int(np.abs(words).max(initial=0)) > SMALL
        part = often.astype(object) @ words.astype(object) if large else often @ words
        for c in range(k):
            sums[c] += [int(x) for x in part[c]]
    return sums


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
    dictionary: int = DICTIONARY,
) -> DataFrame:
    """(id_column, cluster, distance, cluster_inertia, inertia, centroid) of every usable row.

    A component x is the integer floor(scale * x); beyond 2**62 it counts as that.
    Rows whose vector is null, has another number of components, or holds a null
    or non-finite one are left out. The first centroids are the usable vectors
    with the smallest sha256 of ``seed:id`` (as hex text); rows of the same id
    follow each other by their components, and a row without an id is none.
    With fewer rows there are fewer centroids; without any, cluster and all that
    follows from it are null. A round gives every vector to its nearest centroid
    (ties: the smaller number) and moves each that has vectors to the floor of
    their mean. Repeated rows count each. Distances and inertias are exact; one
    beyond a long is the largest long. Other columns take no part.
    """
    spark = vectors.sparkSession
    good = usable(vectors, id_column, vector, dimensions)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _pack(batch.column(0), encode(_scaled(batch.column(1), dimensions, scale), dictionary), batch.num_rows)

    encoded = materialize(good.mapInArrow(write, ENCODED), "centroid-codes")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    # At most ``clusters`` rows.
    first = good.filter("id is not null").orderBy(order, "v").limit(clusters).select("v").toArrow()
    centroids = [[int(x) for x in row] for row in _scaled(first.column("v").combine_chunks(), dimensions, scale)] if first.num_rows else []

    def each(work, schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield work(*_unpack(row := batch.slice(k, 1).to_pylist()[0]), row["n"])

        return encoded.mapInArrow(run, schema)

    def sums(ids, known, blocks, n: int) -> pa.RecordBatch:
        best, _ = _nearest(distances(blocks, now, n))
        held = np.bincount(best, minlength=len(now))
        total = [[int(held[c]), *row] for c, row in enumerate(cluster_sums(blocks, best, len(now))) if held[c]]
        which = np.repeat(np.flatnonzero(held), dimensions + 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array(np.tile(np.arange(-1, dimensions), len(total)), pa.int32()), pa.array([x for row in total for x in row], pa.decimal128(38, 0))],
            names=["cluster", "at", "total"],
        )

    now = centroids
    for _ in range(rounds if centroids else 0):
        # At most clusters * (dimensions + 1) numbers; at = -1 is the count.
        found = each(sums, "cluster int, at int, total decimal(38,0)").groupBy("cluster", "at").agg(F.sum("total").alias("total")).collect()
        total = {(r["cluster"], r["at"]): int(r["total"]) for r in found}
        now = [[total[c, d] // total[c, -1] for d in range(dimensions)] if (c, -1) in total else row for c, row in enumerate(now)]

    def last(ids, known, blocks, n: int) -> pa.RecordBatch:
        best, far = _nearest(distances(blocks, now, n)) if now else (None, None)
        bare = [None] * n
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64(), mask=~known),
                pa.array(best if now else bare, pa.int32()),
                pa.array([int(x) for x in far] if now else bare, pa.decimal128(38, 0)),
            ],
            names=["id", "cluster", "far"],
        )

    placed = materialize(each(last, "id long, cluster int, far decimal(38,0)"), "centroid-placed")
    # One row a cluster.
    inertia = placed.groupBy("cluster").agg(F.sum("far").alias("inertia")).filter("cluster is not null").collect()
    every = sum(int(r["inertia"]) for r in inertia)
    rows = [(r["cluster"], min(int(r["inertia"]), MOST), min(every, MOST), now[r["cluster"]]) for r in inertia]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    capped = F.when(F.col("far") > MOST, F.lit(MOST)).otherwise(F.col("far").cast("long"))
    joined = placed.select("id", "cluster", capped.alias("distance")).join(F.broadcast(known), "cluster", "left")
    return joined.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
