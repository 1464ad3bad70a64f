"""Suffix-array dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from partflow.llm import suffix_dedup
from partflow.llm.suffix_dedup import COVER, STEP, remove_repeated_bytes


def brute(rows, window):
    """(id, bytes, removed, spans, kept) of (id, text) rows."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - window + 1):
                s = b[k : k + window]
                first[s] = min(first.get(s, i), i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        if i is not None:
            for k in range(len(b) - window + 1):
                if first[b[k : k + window]] < i:
                    gone[k : k + window] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0))
        spans = tuple(zip(edges[::2].tolist(), edges[1::2].tolist()))
        yield i, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g)


def found(df):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], tuple(map(tuple, r["spans"])), bytes(r["kept"])) for r in df.collect())


def test_every_residue_is_a_difference_of_the_cover():
    assert {(x - y) % STEP for x in COVER for y in COVER} == set(range(STEP))


@pytest.mark.parametrize("window", [50, 13])
def test_odd_rows(docs, window):
    """Null and empty texts, a null id, repeated rows, a very long text, clashing columns."""
    df = docs.withColumnRenamed("hits", "spans").withColumnRenamed("batch", "range")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = remove_repeated_bytes(df, window=window)
    assert set(out.columns) == {*df.columns, "n_bytes", "n_removed", "spans", "kept"}
    assert found(out) == Counter(brute(rows, window))
    assert any(x[2] for x in found(out))


def test_pieces_of_long_texts(spark, monkeypatch):
    """Texts of many pieces, repeats over the pieces' ends and at every offset to each other."""
    monkeypatch.setattr(suffix_dedup, "PIECE", STEP * 9)
    rng = random.Random(5)
    base = "".join(rng.choice("abcé ") for _ in range(900))
    rows = [(i + 10, base[rng.randrange(400) :][: rng.randrange(20, 500)] + rng.choice(["", "x" * 90])) for i in range(40)]
    rows += [(5, "ab" * 300), (4, "ba" * 40), (6, "a" * 400), (6, "a" * 200), (7, "a" * 49), (8, "a" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for window in (50, 13, 20):
        assert found(remove_repeated_bytes(df, window=window)) == Counter(brute(rows, window))


def test_one_text_in_a_third_of_the_rows(spark):
    rng = random.Random(6)
    hot = "".join(rng.choice("abc") for _ in range(120))
    rows = [(i, hot if i % 3 == 0 else "".join(rng.choice("abc") for _ in range(150))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert found(remove_repeated_bytes(df)) == Counter(brute(rows, 50))


def test_ties_are_told_apart_whatever_the_hash(monkeypatch):
    """Shift by shift against plain comparison, with a good and a poor order of hashes."""
    rng = np.random.default_rng(2)
    rows = np.zeros(300, suffix_dedup.RECORD)
    rows["rank"], rows["doc"] = rng.integers(1, 25, 300), rng.integers(0, 40, 300)
    rows["most"], rows["least"] = rng.choice([0, 5, 12, 12], 300), rng.choice([0, 0, 0, 5], 300)
    rows["left"], rows["right"] = rng.choice([3, 3, 3, 7], (300, 12)), rng.choice([1, 1, 1, 1, 9], (300, 12))
    for poor in (False, True):
        if poor:
            monkeypatch.setattr(suffix_dedup, "mix", lambda x: x & np.uint64(3))
        bits = suffix_dedup.smaller_elsewhere(rows)
        for shift in range(STEP):
            valid = [r for r in rows if r["least"] <= shift <= r["most"]]
            for r, b in zip(rows, bits):
                if r["least"] <= shift <= r["most"]:
                    same = [x["doc"] for x in valid if x["rank"] == r["rank"] and (x["left"][:shift] == r["left"][:shift]).all() and (x["right"][: 12 - shift] == r["right"][: 12 - shift]).all()]
                    assert bool((b >> shift) & 1) == (min(same) < r["doc"])


def test_empty(empty, spark):
    assert remove_repeated_bytes(empty).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_bytes(empty, window=12)
