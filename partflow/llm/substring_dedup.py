"""Substring dedup: words inside a window whose word sequence occurs elsewhere too.

Method: recompression (``recompression.py``). Its names are fingerprints, so the
rounds of all tasks agree without a shuffle of every symbol. High-level symbols
of all documents meet in Spark once; a window can only recur if every symbol it
forces recurs, so most of the corpus is settled by these few symbols. The
windows left (those of true repeats and a few more) are verified by meeting
once more, as 96-bit fingerprints of all their words.

Windows that force no symbol (inside a long run, or by chance) always go on to
the second step, so the result does not depend on the number of rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm import recurring as R
from partflow.llm.common import discard, with_fields
from partflow.llm.recompression import recompress
from partflow.llm.words import U64, Words, hash_windows, hash_words, split_words, windows
from partflow.session import materialize

WINDOW, ROUNDS = 35, 6


def _forced_symbols(hashes: np.ndarray, words: Words, window: int, rounds: int):
    """Distinct fingerprints of the symbols a window can force, and their places."""
    s = recompress(hashes, words.doc, rounds)
    short = s.hi - s.lo <= window
    lo, hi, name = s.lo[short], s.hi[short], s.name[short]
    prints, place, count = R.distinct_prints(name, np.zeros(len(name), np.uint32))
    return lo, hi, prints, place, count


def _candidates(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, recurs: np.ndarray, window: int) -> np.ndarray:
    """Which windows starting at ``at`` hold no forced symbol that is unique."""
    unique = np.concatenate([[0], np.cumsum(~recurs)])
    first = np.searchsorted(lo, at)
    end = np.maximum(np.searchsorted(hi, at + window, side="right"), first)
    return unique[end] == unique[first]


def _window_prints(words: Words, hashes: np.ndarray, at: np.ndarray, all_a: np.ndarray, window: int):
    second = hash_windows(hash_words(words, 1), window)[at]
    return R.distinct_prints(all_a, (second >> U64(32)).astype(np.uint32))


def kept_text(words: Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words joined by one space."""
    n = len(words.data)
    doc, start, length = words.doc[keep], words.start[keep], words.length[keep]
    more = np.zeros(len(doc), np.int64)
    more[:-1] = doc[:-1] == doc[1:]
    edge = np.zeros(n + 2, np.int8)
    edge[start] += 1
    edge[start + length + more] -= 1
    data = words.data.copy()
    data[(start + length)[more == 1]] = 0x20
    out = data[np.cumsum(edge[:n], dtype=np.int8).astype(bool)]
    size = np.bincount(doc, weights=length + more, minlength=words.docs).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.LargeStringArray.from_buffers(words.docs, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, a row for each row.

    Words are runs of characters other than ASCII white space. A word goes if
    any window of ``window`` words that covers it starts anywhere else too, in
    the same text or another; all occurrences go. Windows are judged on the
    input. A null text has no words and an empty ``kept_text``; texts of fewer
    words than a window keep all. Repeated rows are texts like any other, so
    long ones lose their words. Other columns pass through; columns that are
    called like the three new ones are replaced.
    """
    new = ("n_words", "n_removed", "kept_text")
    docs = docs.drop(*new)
    batches = R.write_batches(docs, text, "repeat-batches")
    n = R.ranges_for(batches)

    def read(part: pa.RecordBatch) -> tuple[Words, np.ndarray]:
        words = split_words(part.column(part.schema.get_field_index(text)))
        return words, hash_words(words)

    def symbols(row: dict, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, hashes = read(part)
        yield R.range_rows(row["batch"], _forced_symbols(hashes, words, window, rounds)[2], n)

    shared = R.recurring(R.each_batch(batches.select("batch", "body"), symbols, R.RANGE_SCHEMA), "repeat-symbols")

    def narrow(row: dict, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, hashes = read(part)
        lo, hi, prints, place, count = _forced_symbols(hashes, words, window, rounds)
        recurs = (R.flags_of(prints, row["flags"], n) | (count > 1))[place]
        a, at = windows(words, hashes, window)
        go = _candidates(at, lo, hi, recurs, window)
        prints, _, _ = _window_prints(words, hashes, at[go], a[go], window)
        rows = R.range_rows(row["batch"], prints, n)
        mask = pa.RecordBatch.from_pydict(
            {"range": pa.array([-1], pa.int32()), "batch": pa.array([row["batch"]], pa.int64()), "body": pa.array([np.packbits(go).tobytes()], pa.binary())}
        )
        yield mask
        yield rows

    narrowed = materialize(
        R.each_batch(batches.select("batch", "body").join(shared, "batch", "left"), narrow, R.RANGE_SCHEMA), "repeat-windows"
    )
    repeated = R.recurring(narrowed.filter("range >= 0"), "repeat-verified")
    masks = materialize(narrowed.filter("range < 0").select("batch", F.col("body").alias("mask")), "repeat-masks")
    discard(shared, narrowed)

    fields = with_fields(docs.schema, "n_words long, n_removed long, kept_text string")

    def remove(row: dict, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, hashes = read(part)
        a, at = windows(words, hashes, window)
        go = np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=len(at)).astype(bool)
        at = at[go]
        prints, place, count = _window_prints(words, hashes, at, a[go], window)
        hit = at[(R.flags_of(prints, row["flags"], n) | (count > 1))[place]]
        edge = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        keep = np.cumsum(edge[:-1]) == 0
        n_words = np.bincount(words.doc, minlength=words.docs)
        kept = np.bincount(words.doc[keep], minlength=words.docs)
        columns = [*part.columns, pa.array(n_words, pa.int64()), pa.array(n_words - kept, pa.int64()), kept_text(words, keep)]
        yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *new])

    joined = batches.select("batch", "body").join(masks, "batch").join(repeated, "batch", "left")
    return R.each_batch(joined, remove, fields)
