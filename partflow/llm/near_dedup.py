"""Near duplicates: MinHash signatures under a multi-index Hamming join.

A signature has lanes of 16 bits, each from the smallest of the shingle hashes
under its own permutation; two sets agree in a lane with the probability of
their similarity. Signature distance is the number of lanes that differ. The
lanes are split into chunks of CHUNK_LANES. By the pigeonhole, two signatures
that differ in at most chunks * (ERRORS + 1) - 1 lanes differ in at most ERRORS
lanes of some chunk; so for every chunk all ways of leaving ERRORS lanes out are
listed as keys, and every pair within that distance shares a key, for certain.
A key has four lanes, so texts of little likeness hardly ever meet: two sets of
similarity 0.05 do with a probability of 7 in 10,000, of 0.01 of 1 in a million.
The number of chunks follows from the threshold, so that a pair at it lies
beyond the distance with a probability of at most LOSS.

Equal sets are one node from the start. The pairs of a group are never listed:

* every set is checked against one hub, the most popular member of the buckets
  it is in, and components of these first links are formed;
* the sets of a hub are a group, and two groups meet if any bucket holds sets of
  both; groups that are one component already are done with;
* groups that meet are cut into blocks, and a task compares the signatures of two
  blocks. Besides the lanes these have 64 bytes of further permutations, so sets
  that are not alike stand out. Only sets that have a partner of another
  component within both distances come again with their full sets, and only
  confirmed links leave the task.

All links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import discard, drop_kept, slices
from partflow.llm.components import smallest_reachable
from partflow.llm.recurring import pack, unpack
from partflow.llm.words import U64, Words, hash_windows, hash_words, mix, split_words
from partflow.session import materialize

SHINGLE, PERCENT = 5, 85
CHUNK_LANES, ERRORS = 6, 2
#: Most chunks; further lanes of a byte each, that no key is made of.
MOST_CHUNKS, EXTRA = 12, 64
#: Probability that a pair at the threshold is beyond a distance.
LOSS = 4e-6
#: A group travels in chunks of about so many sets; it is compared in so many
#: blocks of whole chunks, or more so that none has more sets than the last.
CHUNK_SETS, BLOCKS, BLOCK_MOST = 64, 10, 4096
#: Cells up to which a block's sets are compared as one matrix.
DENSE_CELLS = 8_000_000
_KEPT = [c for c in combinations(range(CHUNK_LANES), CHUNK_LANES - ERRORS)]


class Layout(NamedTuple):
    """Chunks, the largest distance of lanes at which a shared key is certain, and that of lanes and further bytes."""

    chunks: int
    reach: int
    far: int

    @property
    def lanes(self) -> int:
        return self.chunks * CHUNK_LANES


def _beyond(lanes: int, distance: int, percent: int) -> float:
    """Probability that more than ``distance`` of the lanes of a pair at the threshold differ."""
    p = 1 - percent / 100
    return sum(comb(lanes, k) * p**k * (1 - p) ** (lanes - k) for k in range(distance + 1, lanes + 1))


def layout(percent: int) -> Layout:
    """The fewest chunks whose certain distance a pair at the threshold practically never exceeds."""
    def reach(chunks: int) -> int:
        return chunks * (ERRORS + 1) - 1

    chunks = next((c for c in range(2, MOST_CHUNKS) if _beyond(c * CHUNK_LANES, reach(c), percent) <= LOSS), MOST_CHUNKS)
    every = chunks * CHUNK_LANES + EXTRA
    far = next(d for d in range(every + 1) if _beyond(every, d, percent) <= LOSS / 100)
    return Layout(chunks, reach(chunks), far)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle; a text of fewer words is one shingle."""
    hashes = hash_words(words)
    out = hash_windows(hashes, size)
    at = np.flatnonzero(words.doc[: len(out)] == words.doc[size - 1 :][: len(out)])
    parts, docs = [out[at]], [words.doc[at]]
    first = words.first()
    count = np.diff(first)
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            parts.append(mix(hash_windows(hashes, n)[first[short]] + U64(n)))
            docs.append(short)
    return np.concatenate(parts), np.concatenate(docs)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in (text, hash) order, and where each text's begin."""
    words = split_words(texts, lower=True)
    h, doc = shingle_hashes(words, size)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(words.docs + 1))


def _reduced(ufunc, values: np.ndarray, starts: np.ndarray, full: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts) - 1, U64)
    if full.any():
        out[full] = ufunc.reduceat(values, starts[:-1][full])
    return out


def _lanes(h: np.ndarray, starts: np.ndarray, first: int, lanes: int) -> np.ndarray:
    """The signature of every set, a row of lanes from number ``first`` on."""
    full = np.diff(starts) > 0
    odd = mix(np.arange(first + 1, first + lanes + 1, dtype=U64)) | U64(1)
    return np.column_stack([(mix(_reduced(np.minimum, mix(h ^ o) * o, starts, full)) >> U64(48)).astype(np.int32) for o in odd])


def sketches(docs: DataFrame, size: int, lanes: int) -> DataFrame:
    """(id, n_shingles, hi, lo, lanes) of (id, text): 128 bits that name the set, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in slices(batches, "text", 2 << 20):
            h, starts = shingle_sets(batch.column("text"), size)
            full = np.diff(starts) > 0
            sums = [_reduced(np.add, mix(h * U64(k)), starts, full).view(np.int64) for k in (3, 5)]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(_lanes(h, starts, 0, lanes).reshape(-1)), lanes).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(starts), pa.int64()), *map(pa.array, sums), lists], names=["id", "n_shingles", "hi", "lo", "lanes"]
            )

    return docs.mapInArrow(run, "id long, n_shingles long, hi long, lo long, lanes array<int>")


def full_sets(docs: DataFrame, size: int, lanes: int) -> DataFrame:
    """(id, size, lanes, extra, hashes) of (id, text); lanes of two bytes, further ones of one, hashes of eight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in slices(batches, "text", 2 << 20):
            h, starts = shingle_sets(batch.column("text"), size)
            held = _lanes(h, starts, 0, lanes).astype(np.uint16), _lanes(h, starts, lanes, EXTRA).astype(np.uint8)
            bodies = [[x.tobytes() for x in part] for part in held] + [[h[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]]
            columns = [batch.column("id"), pa.array(np.diff(starts), pa.int32()), *(pa.array(x, pa.binary()) for x in bodies)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "lanes", "extra", "hashes"])

    return docs.mapInArrow(run, "id long, size int, lanes binary, extra binary, hashes binary")


def _keys(lanes: str, chunks: int) -> Column:
    """A hash of every chunk's lanes with ERRORS of them left out."""
    lane = [F.col(lanes)[i] for i in range(chunks * CHUNK_LANES)]
    return F.array(*[F.xxhash64(F.lit(c * len(_KEPT) + k), *[lane[c * CHUNK_LANES + i] for i in kept]) for c in range(chunks) for k, kept in enumerate(_KEPT)])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                p, q = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok[k] = 100 * both >= percent * (len(p) + len(q) - both)
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], names=["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets x[k] and y[k]."""
    every, at = np.unique(np.concatenate(sets), return_inverse=True)
    if len(x) > 2 * len(sets) and len(every) * len(sets) <= DENSE_CELLS:
        dense = np.zeros((len(sets), len(every)), np.float32)
        dense[np.repeat(np.arange(len(sets)), [len(v) for v in sets]), at] = 1
        return np.rint((dense @ dense.T)[x, y]).astype(np.int64)
    return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y)], np.int64)


SIGNED = ["rep", "label", "size", "lanes", "extra"]


def _packed(group: pa.Table) -> pa.Table:
    """A chunk's signatures as one compressed row."""
    held = group.select(SIGNED).combine_chunks().to_batches()[0]
    return pa.table({"hub": group.column("hub")[:1], "chunk": group.column("chunk")[:1], "body": pa.array([pack(held)], pa.binary())})


def _near(group: pa.Table, left: np.ndarray, right: np.ndarray, plan: Layout, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every set on the left, those on the right of another label, of a fitting size and within the distances."""
    label, size = (group.column(c).to_numpy().astype(np.int64) for c in ("label", "size"))
    lanes = np.array([np.frombuffer(v.as_buffer(), np.uint16) for v in group.column("lanes")]).reshape(-1, plan.lanes)
    extra = np.array([np.frombuffer(v.as_buffer(), np.uint8) for v in group.column("extra")]).reshape(-1, EXTRA)
    others = np.flatnonzero(right)
    for i in np.flatnonzero(left):
        j = others[(label[others] != label[i]) & (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))]
        apart = (lanes[j] != lanes[i]).sum(1)
        j, apart = j[apart <= plan.reach], apart[apart <= plan.reach]
        yield i, j[apart + (extra[j] != extra[i]).sum(1) <= plan.far]


def _near_members(unit: pa.Table, plan: Layout, percent: int) -> pa.Table:
    """The sets of a unit that have a near one of another label on the other side."""
    chunks = [unpack(body.as_py()) for body in unit.column("body")]
    group = pa.Table.from_batches(chunks)
    sizes = [c.num_rows for c in chunks]
    left, right = (np.repeat(unit.column(c).to_numpy(zero_copy_only=False).astype(bool), sizes) for c in ("left", "right"))
    one, two = np.zeros(len(left), bool), np.zeros(len(left), bool)
    for i, j in _near(group, left, right, plan, percent):
        one[i] |= len(j) > 0
        two[j] = True
    at = np.flatnonzero(one | two)
    return pa.table({"unit": pa.array([unit.column("unit")[0].as_py()] * len(at), pa.int64()), "rep": group.column("rep").take(pa.array(at)), "label": group.column("label").take(pa.array(at)), "left": pa.array(one[at]), "right": pa.array(two[at])})


def _unit_links(group: pa.Table, plan: Layout, percent: int) -> pa.Table:
    """Links between the near sets of a unit, on their full sets."""
    group = group.combine_chunks()
    left, right = (group.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("left", "right"))
    ids, size = group.column("rep").to_numpy(), group.column("size").to_numpy().astype(np.int64)
    found = [(np.full(len(j), i), j) for i, j in _near(group, left, right, plan, percent)]
    x, y = (np.concatenate(v) for v in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
    if len(x):
        both = _common([np.frombuffer(v.as_buffer(), U64) for v in group.column("hashes")], x, y)
        ok = 100 * both >= percent * (size[x] + size[y] - both)
        x, y = x[ok], y[ok]
    return pa.table({"a": pa.array(ids[x]), "b": pa.array(ids[y])})


def _met_blocks(sets: DataFrame, groups: DataFrame, members: DataFrame, plan: Layout, percent: int) -> DataFrame:
    """Links (a, b) between sets of different labels whose groups meet.

    ``groups`` has hub and label of every set, ``members`` the buckets.
    """
    hubs = materialize(groups.groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")), "near-hubs")
    in_bucket = members.select("key", "rep").join(groups.select("rep", "hub"), "rep").select("key", "hub").distinct()
    pairs = in_bucket.join(in_bucket.withColumnRenamed("hub", "hub2"), "key").filter("hub < hub2").select("hub", "hub2").distinct()
    pairs = pairs.unionByName(hubs.filter("n > 1").select("hub", F.col("hub").alias("hub2")))
    chunks = F.ceil(F.col("n") / CHUNK_SETS).cast("int")
    blocks = F.greatest(F.least(chunks, F.lit(BLOCKS)), F.ceil(F.col("n") / BLOCK_MOST).cast("int"))
    sized = hubs.select("hub", "lo", "hi", chunks.alias("chunks"), blocks.alias("blocks"))
    other = sized.select(*[F.col(c).alias(f"{c}2") for c in sized.columns])
    mixed = pairs.join(sized, "hub").join(other, "hub2").filter("least(lo, lo2) < greatest(hi, hi2)")
    units = mixed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.withColumn("block2", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1))).filter("hub < hub2 or block <= block2")
    units = materialize(units.withColumn("unit", F.xxhash64("hub", "block", "hub2", "block2")).select("unit", "hub", "block", "hub2", "block2"), "near-units")
    sides = units.select("unit", "hub", "block", F.lit(True).alias("left"), ((F.col("hub") == F.col("hub2")) & (F.col("block") == F.col("block2"))).alias("right"))
    sides = sides.unionByName(
        units.filter("hub <> hub2 or block <> block2").select("unit", F.col("hub2").alias("hub"), F.col("block2").alias("block"), F.lit(False).alias("left"), F.lit(True).alias("right"))
    )
    used = sides.select("hub").distinct()
    placed = groups.join(sized.select("hub", "chunks"), "hub").join(used, "hub", "left_semi")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks").cast("long")).cast("int"))
    signed = sets.select(F.col("id").alias("rep"), "size", "lanes", "extra")
    rows = placed.select("hub", "chunk", "rep", "label").join(signed, "rep")
    packed = materialize(rows.groupBy("hub", "chunk").applyInArrow(_packed, "hub long, chunk int, body binary"), "near-chunks")
    blocked = packed.join(sized.select("hub", "blocks"), "hub").withColumn("block", F.col("chunk") % F.col("blocks"))
    held = sides.join(blocked, ["hub", "block"]).select("unit", "left", "right", "body")
    schema = "unit long, rep long, label long, left boolean, right boolean"
    near = materialize(held.groupBy("unit").applyInArrow(lambda unit: _near_members(unit, plan, percent), schema), "near-members")
    whole = near.join(sets.withColumnRenamed("id", "rep"), "rep")
    links = materialize(whole.groupBy("unit").applyInArrow(lambda unit: _unit_links(unit, plan, percent), "a long, b long"), "near-links")
    discard(hubs, units, packed, near)
    return links


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id_column, n_shingles, component_id, kept) for every row of ``docs``.

    Words are lower-cased (A-Z) runs of other than ASCII white space; a text's
    set are its distinct shingles of ``size`` words, or its whole sequence if it
    has fewer. Texts link where the sets' similarity is ``percent`` or more. The
    component is the smallest id reachable; ``kept`` marks the rows that bear
    it. Texts without words, null ones too, link with nothing. A null id is a
    row of its own: no component, kept. Rows of the same id are one node, and
    all of them are kept or none. Other columns take no part.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    plan = layout(percent)
    made = materialize(sketches(rows, size, plan.lanes), "near-sketches")
    nodes = made.filter("id is not null and n_shingles > 0")

    # One representative of each distinct set.
    classes = materialize(
        nodes.groupBy("n_shingles", "hi", "lo").agg(F.min("id").alias("rep"), F.min("lanes").alias("lanes")), "near-classes"
    )
    # An id with several texts may represent several sets; its parts are linked by the id itself.
    keyed = classes.select("rep", F.explode(_keys("lanes", plan.chunks)).alias("key"))
    often = F.count(F.lit(1)).over(Window.partitionBy("key"))
    members = materialize(keyed.select("key", "rep", often.alias("n")).filter("n > 1"), "near-members")
    wanted = materialize(members.groupBy("rep").agg(F.sum("n").alias("popular")), "near-popular")
    sets = materialize(full_sets(rows.join(wanted.select(F.col("rep").alias("id")), "id", "left_semi"), size, plan.lanes), "near-sets")

    # First links: every set with its hub, the most popular of the centres it shares keys with.
    ranked = members.select("key", "rep").join(wanted, "rep")
    centre = ranked.groupBy("key").agg(F.max_by("rep", F.struct("popular", (-F.col("rep")).alias("order"))).alias("hub"), F.max("popular").alias("popular"))
    votes = members.select("key", "rep").join(centre, "key").groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("n"), F.max("popular").alias("popular"))
    hub = materialize(votes.groupBy("rep").agg(F.max_by("hub", F.struct("popular", "n", (-F.col("hub")).alias("order"))).alias("hub")), "near-hub")
    first = hub.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    links = materialize(_confirmed(first, sets, percent), "near-links")
    labels = smallest_reachable(links)

    # Then the sets of different components, block against block of groups that meet.
    groups = hub.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("rep", "hub", F.coalesce("label", "rep").alias("label"))
    groups = materialize(groups, "near-groups")
    links = links.unionByName(_met_blocks(sets, groups, members, plan, percent))

    same = nodes.join(classes.select("n_shingles", "hi", "lo", "rep"), ["n_shingles", "hi", "lo"]).select(F.col("rep").alias("a"), F.col("id").alias("b")).filter("a <> b")
    found = smallest_reachable(links.unionByName(same.distinct()))
    discard(classes, members, wanted, sets, hub, groups)
    joined = made.select("id", "n_shingles").join(found, "id", "left")
    component = F.coalesce("label", "id")
    return joined.select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
