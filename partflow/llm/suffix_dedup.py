"""Suffix-array dedup: byte strings that also start in a document with a smaller id.

Difference-cover blockwise construction. A difference cover D of the residues
modulo STEP has the property that for any two positions there is a shift below
STEP that takes both to residues in D. So only the *cover sample*, the suffixes
at positions of these residues, is ranked in Spark: by their first WINDOW - STEP
+ 1 bytes, equal ones alike. Two WINDOW byte strings are equal if and only if,
at the shift their positions have in common, their sample suffixes have the same
rank and the few bytes left and right of that are the same, so ties are decided
without looking at a text again.

Suffixes are taken a block of buckets at a time, and what a block shuffled goes
before the next one starts, so disk and memory are bounded whatever the input:

1. a block's sample suffixes meet in their buckets, are sorted there and get
   their ranks; unique ones drop out, nothing can equal a window around them;
2. the others come back to their bucket with their rank, the bytes at their
   sides and the smallest document of their batch; for every shift the bucket
   sorts them by rank and side bytes, and answers which windows start in a
   smaller document elsewhere.

The order of ranks is that of 64-bit names of the sample strings and not the
alphabet's: equal ones tie, and this is all that repeats need. Strings that share
a name by chance still differ in their side bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm import recurring as R
from partflow.llm.common import with_fields
from partflow.llm.words import U64, join, mix, text_bytes
from partflow.session import materialize

WINDOW = 50
#: A difference cover: every residue modulo STEP is a difference of two of COVER.
STEP, COVER = 13, (0, 1, 3, 9)
SIDE = STEP - 1
#: Blocks of buckets, one after another; bytes of text of a bucket; a piece of a long text.
BLOCKS, BUCKET_BYTES, PIECE = 2, 8 << 20, STEP << 16
#: Pieces of a batch are numbered below its id.
_PIECE_BITS = 11
_BASE = 0x9E3779B97F4A7C15
#: A random word for every byte at every place left and right of a sample string.
_LEFT, _RIGHT = (mix(np.arange(k << 16, (k << 16) + 256 * SIDE, dtype=U64) * U64(_BASE)).reshape(SIDE, 256) for k in (1, 2))


class Names:
    """Hashes of byte strings from running sums; powers of the base are kept, as many as were asked for."""

    def __init__(self):
        self.steps = U64(_BASE), U64(pow(_BASE, -1, 1 << 64))
        self.values = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
        self.up = self.down = np.ones(1, U64)

    def of(self, data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from every ``at``, wherever they stand."""
        if len(self.up) <= len(data):
            powers = [np.full(2 * len(data) + 1, step, U64) for step in self.steps]
            for row in powers:
                row[0] = 1
            self.up, self.down = (np.cumprod(row) for row in powers)
        sums = np.zeros(len(data) + 1, U64)
        terms = self.values[data]
        terms *= self.up[: len(data)]
        np.cumsum(terms, out=sums[1:])
        out = sums[at + size]
        out -= sums[at]
        out *= self.down[at]
        return mix(out)


_NAMES: list[Names] = []


def _names() -> Names:
    if not _NAMES:
        _NAMES.append(Names())
    return _NAMES[0]


class Piece(NamedTuple):
    """Bytes of some texts, or parts of long ones, with the cover sample's places, texts and names."""

    number: int
    base: int
    data: np.ndarray
    sample: np.ndarray
    which: np.ndarray
    name: np.ndarray
    #: Of every text: where it begins and ends, and its id.
    lo: np.ndarray
    hi: np.ndarray
    owner: np.ndarray
    core: int


def _runs(offsets: np.ndarray, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts in runs of (text, from, to) of about PIECE bytes; parts of a long text overlap by window - 1."""
    run, held = [], 0
    for i in range(len(offsets) - 1):
        lo, end = int(offsets[i]), int(offsets[i + 1])
        while lo == offsets[i] or end - lo >= window:
            hi = min(end, lo + PIECE + window - 1)
            if run and held + hi - lo > PIECE + window:
                yield run
                run, held = [], 0
            run.append((i, lo, hi))
            held += hi - lo
            lo += PIECE
    if run:
        yield run


def pieces(batch: int, part: pa.RecordBatch, id_column: str, text: str, window: int) -> Iterator[Piece]:
    """The batch's texts cut into pieces; texts without an id hold no sample."""
    data, offsets = text_bytes(part.column(part.schema.get_field_index(text)))
    ids = part.column(part.schema.get_field_index(id_column)).cast(pa.int64())
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    core = window - SIDE
    for k, run in enumerate(_runs(offsets, window)):
        base, top = run[0][1], run[-1][2]
        body = data[base:top]
        lo, hi = (np.array([r[c] for r in run], np.int64) - base for c in (1, 2))
        doc = np.array([r[0] for r in run])
        # Every text, or part of one, counts its positions from its own start.
        use = np.flatnonzero(known[doc] & (hi - lo >= window))
        places = ((hi - lo)[use] - core + 1)[:, None] - np.array(COVER)
        often = np.maximum(0, -(-places // STEP)).reshape(-1)
        first = (lo[use][:, None] + np.array(COVER)).reshape(-1)
        sample = np.repeat(first - STEP * (np.cumsum(often) - often), often) + STEP * np.arange(often.sum())
        which = np.repeat(np.repeat(use, len(COVER)), often)
        yield Piece((batch << _PIECE_BITS) | k, base, body, sample, which, _names().of(body, sample, core), lo, hi, ids[doc], core)


def _bucket_of(name: np.ndarray, bits: int) -> np.ndarray:
    return (name >> U64(64 - bits)).astype(np.int64)


class Ranked(NamedTuple):
    """A block's sample of a piece: places in it, sorted distinct names, each one's place among them, buckets."""

    at: np.ndarray
    names: np.ndarray
    place: np.ndarray
    count: np.ndarray
    buckets: np.ndarray
    cuts: np.ndarray


def block_sample(piece: Piece, block: int, bits: int) -> Ranked:
    # A name's first bits are its bucket, its last byte is its block.
    byte = piece.name.view(np.uint8)[::8] if len(piece.name) else np.zeros(0, np.uint8)
    at = np.flatnonzero((byte >= 256 * block // BLOCKS) & (byte <= 256 * (block + 1) // BLOCKS - 1))
    name = piece.name[at]
    order = np.argsort(name)
    held = name[order]
    new = np.ones(len(at), bool)
    new[1:] = held[1:] != held[:-1]
    rank = np.cumsum(new) - 1
    place = np.empty(len(at), np.int64)
    place[order] = rank
    names = held[new]
    buckets, first = np.unique(_bucket_of(names, bits), return_index=True)
    return Ranked(at, names, place, np.bincount(rank, minlength=len(names)), buckets * BLOCKS + block, np.append(first, len(names)))


def _sides(piece: Piece, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bytes left and right of every sample string, and the largest and least shift to a window in its text.

    The nearest byte comes first; bytes beyond the text are zero.
    """
    s, which = piece.sample[at], piece.which[at]
    most = np.minimum(SIDE, s - piece.lo[which])
    least = np.maximum(0, s + piece.core + SIDE - piece.hi[which])
    padded = np.concatenate([np.zeros(SIDE, np.uint8), piece.data, np.zeros(SIDE, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, SIDE)
    left, right = around[s][:, ::-1], around[s + piece.core + SIDE]
    out = []
    for side, size in ((left, most), (right, SIDE - least)):
        side = np.ascontiguousarray(side)
        short = np.flatnonzero(size < SIDE)
        side[short] *= np.arange(SIDE) < size[short][:, None]
        out.append(side)
    return *out, most, least


def _folded(left: np.ndarray, right: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """A hash of the bytes on both sides; the shifts tell bytes beyond the text from zeros."""
    out = most.astype(U64) << U64(8) | least.astype(U64)
    for side in (left, right):
        part = side.view("<u4").astype(U64)
        out = join(join(out, part[:, 0] | (part[:, 1] << U64(32))), part[:, 2])
    return out


def _words(side: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.zeros(len(side), U64)
    for j in range(SIDE):
        out += table[j][side[:, j]]
    return out


RECORD = np.dtype([("rank", "<u4"), ("most", "u1"), ("least", "u1"), ("left", "u1", (SIDE,)), ("right", "u1", (SIDE,)), ("doc", "<i8")])


class Records(NamedTuple):
    """Sample suffixes of a block that are not unique, equal ones of a piece as one."""

    at: np.ndarray
    place: np.ndarray
    rows: np.ndarray
    cuts: np.ndarray


def block_records(piece: Piece, ranked: Ranked, ranks: np.ndarray) -> Records:
    """``ranks``: a number from 1 on for every distinct name of the block, 0 for unique ones."""
    go = ranks[ranked.place] > 0
    at, place = ranked.at[go], ranked.place[go]
    left, right, most, least = _sides(piece, at)
    sides = _folded(left, right, most, least)
    # Place first, then 40 bits of the sides: rows that differ may only come twice, never merge.
    key = (place.astype(U64) << U64(40)) | (sides >> U64(24))
    order = np.argsort(key)
    p, w = place[order], sides[order]
    new = np.ones(len(at), bool)
    new[1:] = (p[1:] != p[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(new)
    number = np.empty(len(at), np.int64)
    number[order] = np.cumsum(new) - 1
    rows = np.empty(len(first), RECORD)
    one = order[first]
    rows["rank"], rows["most"], rows["least"], rows["left"], rows["right"] = ranks[p[first]], most[one], least[one], left[one], right[one]
    rows["doc"] = np.minimum.reduceat(piece.owner[piece.which[at]][order], first) if len(first) else 0
    return Records(at, number, rows, np.searchsorted(p[first], ranked.cuts))


def _least(rank: np.ndarray, word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal (rank, word): each row's group, a row of each, and its smallest document."""
    key = mix(word + mix(rank))
    order = np.argsort(key)
    k, r = key[order], rank[order]
    if ((k[1:] == k[:-1]) & (r[1:] != r[:-1])).any():  # rows that only share a hash
        order = np.lexsort((word, rank))
        k, r = word[order], rank[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return group, order[first], np.minimum.reduceat(doc[order], first)


def smaller_elsewhere(rows: np.ndarray) -> np.ndarray:
    """For each of a bucket's records a bit per shift: a smaller document holds that window too.

    Suffixes with the same bytes on both sides are one to begin with. A rank of
    only one kind of suffix is decided at once; the others shift by shift.
    """
    bits = np.zeros(len(rows), np.uint16)
    if not len(rows):
        return bits
    rank, most, least = rows["rank"].astype(U64), rows["most"].astype(U64), rows["least"].astype(U64)
    left, right = np.ascontiguousarray(rows["left"]), np.ascontiguousarray(rows["right"])
    kind, one, doc = _least(rank, _folded(left, right, most, least), rows["doc"])
    bits[doc[kind] < rows["doc"]] = (1 << STEP) - 1
    _, number, often = np.unique(rank[one], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(often[number] > 1)
    place = np.full(len(one), -1)
    place[mixed] = np.arange(len(mixed))
    of, again = place[kind], np.flatnonzero(place[kind] >= 0)
    one, doc = one[mixed], doc[mixed]
    rank, most, least, left, right = rank[one], most[one], least[one], left[one], right[one]
    word = _words(right, _RIGHT)
    for shift in range(STEP if len(one) else 0):
        if shift:
            word += _LEFT[shift - 1][left[:, shift - 1]]
            word -= _RIGHT[SIDE - shift][right[:, SIDE - shift]]
        at = np.flatnonzero((most >= shift) & (least <= shift))
        if len(at):
            group, _, smallest = _least(rank[at], word[at], doc[at])
            best = doc.copy()
            best[at] = smallest[group]
            bits[again] |= (best[of[again]] < rows["doc"][again]).astype(np.uint16) << np.uint16(shift)
    return bits


def _squeeze(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _loosen(body: bytes, dtype, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(body, n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


def _rows(buckets, piece: int, bodies: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(np.full(len(bodies), piece), pa.int64()), pa.array(bodies, pa.binary())], names=["range", "batch", "body"]
    )


def _rank_bucket(group: pa.Table) -> pa.Table:
    """Ranks of a bucket's sample strings from 1 on, in their order; 0 for those that occur once.

    A body holds strings and then a bit for each: it occurs again in its piece.
    """
    parts, often = [], []
    for body in group.column("body"):
        raw = np.frombuffer(body.as_buffer(), np.uint8)
        n = len(raw) * 8 // 65
        parts.append(raw[: 8 * n].view(U64))
        often.append(np.unpackbits(raw[8 * n :], count=n).astype(bool))
    every, more = np.concatenate(parts), np.concatenate(often)
    order = np.argsort(every)
    held = every[order]
    new = np.ones(len(order), bool)
    new[1:] = held[1:] != held[:-1]
    group_of = np.cumsum(new) - 1
    many = (np.bincount(group_of, minlength=1) > 1) | (np.bincount(group_of, more[order], minlength=1) > 0)
    number = np.where(many, np.cumsum(many), 0)
    ranks = np.empty(len(order), np.uint32)
    ranks[order] = number[group_of]
    ends = np.cumsum([len(p) for p in parts])
    bodies = [_squeeze(ranks[e - len(p) : e]) for p, e in zip(parts, ends)]
    return pa.table({"range": group.column("range"), "batch": group.column("batch"), "body": pa.array(bodies, pa.binary())})


def _tie_bucket(group: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x.as_buffer(), RECORD) for x in group.column("body")]
    bits = smaller_elsewhere(np.concatenate(parts))
    ends = np.cumsum([len(p) for p in parts])
    bodies = [_squeeze(bits[e - len(p) : e]) for p, e in zip(parts, ends)]
    return pa.table({"range": group.column("range"), "batch": group.column("batch"), "body": pa.array(bodies, pa.binary())})


def _answers(rows: DataFrame, work, name: str) -> DataFrame:
    """A table (batch, range, piece, body) of the buckets' answers."""
    met = rows.groupBy("range").applyInArrow(work, R.RANGE_SCHEMA)
    return materialize(met.select(F.shiftright("batch", _PIECE_BITS).alias("batch"), "range", F.col("batch").alias("piece"), "body"), name)


def _with_answers(bodies: DataFrame, **answers: DataFrame) -> DataFrame:
    """Every batch with the answers for its pieces, one list under each name."""
    kinds = [a.withColumn("kind", F.lit(kind)) for kind, a in answers.items()]
    rows = reduce(DataFrame.unionByName, kinds)
    lists = [F.collect_list(F.when(F.col("kind") == kind, F.struct("range", "piece", "body"))).alias(kind) for kind in answers]
    return bodies.join(rows.groupBy("batch").agg(*lists), "batch", "left")


def _by_piece(found: list | None) -> dict[tuple[int, int], bytes]:
    return {(x["piece"], x["range"]): x["body"] for x in found or ()}


def _ranks(piece: Piece, ranked: Ranked, answers: dict) -> np.ndarray:
    out = np.zeros(len(ranked.names), np.uint32)
    for k, bucket in enumerate(ranked.buckets.tolist()):
        lo, hi = ranked.cuts[k], ranked.cuts[k + 1]
        out[lo:hi] = _loosen(answers[piece.number, bucket], "<u4", hi - lo)
    return out


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_bytes, n_removed, spans and kept, a row for each row.

    A text is its UTF-8 bytes. A byte goes if it is covered by a string of
    ``window`` bytes (13 at least) that also starts in a row with a smaller
    ``id_column`` (a whole number); strings are judged on the input and lie in
    one text. ``spans`` are the maximal removed runs [start, end), ``kept`` the
    other bytes (characters may be cut). A null text is empty; texts shorter than
    a window keep all. Rows of the same id are no smaller than each other, so all
    keep what only they share. A row without an id keeps all and takes nothing
    from others. Long texts are ranked in overlapping pieces; a text and its
    coverage lie in one task. Other columns pass through; columns called like
    the new ones are replaced. An empty table gives an empty one.
    """
    if window <= SIDE:
        raise ValueError(f"a window has more than {SIDE} bytes")
    new = ("n_bytes", "n_removed", "spans", "kept")
    docs = docs.drop(*new)
    batches = R.write_batches(docs, text, "suffix-batches")
    bits = max(6, (batches.count() * R.BATCH_BYTES // BUCKET_BYTES).bit_length())
    bodies = batches.select("batch", "body")

    def sample(block: int):
        def run(row: dict, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for piece in pieces(row["batch"], part, id_column, text, window):
                r = block_sample(piece, block, bits)
                spans = list(zip(r.cuts[:-1].tolist(), r.cuts[1:].tolist()))
                yield _rows(r.buckets, piece.number, [r.names[a:b].tobytes() + np.packbits(r.count[a:b] > 1).tobytes() for a, b in spans])

        return run

    def tied(block: int):
        def run(row: dict, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            answers = _by_piece(row["ranks"])
            for piece in pieces(row["batch"], part, id_column, text, window):
                r = block_sample(piece, block, bits)
                held = block_records(piece, r, _ranks(piece, r, answers))
                full = np.flatnonzero(np.diff(held.cuts))
                yield _rows(r.buckets[full], piece.number, [held.rows[held.cuts[k] : held.cuts[k + 1]].tobytes() for k in full])

        return run

    ranks, ties = [], []
    for block in range(BLOCKS):
        ranks.append(_answers(R.each_batch(bodies, sample(block), R.RANGE_SCHEMA), _rank_bucket, "suffix-ranks"))
        asked = _with_answers(bodies, ranks=ranks[-1])
        ties.append(_answers(R.each_batch(asked, tied(block), R.RANGE_SCHEMA), _tie_bucket, "suffix-ties"))
    joined = _with_answers(bodies, ranks=reduce(DataFrame.unionByName, ranks), ties=reduce(DataFrame.unionByName, ties))

    def cover(row: dict, part: pa.RecordBatch) -> np.ndarray:
        ranks, ties = _by_piece(row["ranks"]), _by_piece(row["ties"])
        gone = np.zeros(part_bytes(part)[1][-1], bool)
        for piece in pieces(row["batch"], part, id_column, text, window):
            edge = np.zeros(len(piece.data) + 1, np.int32)
            begins = np.zeros(len(piece.data), bool)
            for block in range(BLOCKS):
                r = block_sample(piece, block, bits)
                held = block_records(piece, r, _ranks(piece, r, ranks))
                bit = np.zeros(len(held.rows), np.uint16)
                for k in np.flatnonzero(np.diff(held.cuts)):
                    lo, hi = held.cuts[k], held.cuts[k + 1]
                    bit[lo:hi] = _loosen(ties[piece.number, int(r.buckets[k])], "<u2", hi - lo)
                own = held.rows[held.place]
                inside = own["doc"] < piece.owner[piece.which[held.at]]
                hits = np.where(inside, (1 << STEP) - 1, bit[held.place])
                some = np.flatnonzero(hits)
                sample, hits, most, least = piece.sample[held.at[some]], hits[some], own["most"][some], own["least"][some]
                for shift in range(STEP):
                    begins[sample[(most >= shift) & (least <= shift) & ((hits >> shift) & 1).astype(bool)] - shift] = True
            at = np.flatnonzero(begins)
            edge[at] += 1
            edge[at + window] -= 1
            gone[piece.base : piece.base + len(piece.data)] |= np.cumsum(edge[:-1]) > 0
        return gone

    def part_bytes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return text_bytes(part.column(part.schema.get_field_index(text)))

    def remove(row: dict, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = part_bytes(part)
        gone = cover(row, part)
        ends = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data[~gone].tobytes())])
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # a run ends where its text ends
        before = np.concatenate([[False], gone])
        after = np.concatenate([gone, [False]])
        start = np.flatnonzero(after & (edge | ~before))
        end = np.flatnonzero(before & (edge | ~after))
        doc = np.searchsorted(offsets, start, side="right") - 1
        pairs = pa.StructArray.from_arrays([pa.array(start - offsets[doc]), pa.array(end - offsets[doc])], names=["start", "end"])
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(part) + 1)), pa.int32()), pairs)
        size = np.diff(offsets)
        columns = [*part.columns, pa.array(size, pa.int64()), pa.array(size - np.diff(ends), pa.int64()), spans, kept.cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *new])

    fields = with_fields(docs.schema, "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return R.each_batch(joined, remove, fields)
