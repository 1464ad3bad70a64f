"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from partflow.llm import centroids
from partflow.llm.centroids import MOST, cluster, distances, encode


def floored(v):
    return [math.floor(1024 * float(x)) for x in v]


def brute(rows, dims, k, rounds):
    good = [(i, floored(v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in good if i is not None)
    now = [v for _, v in seeds[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(now)) for _, v in good]

    for _ in range(rounds):
        at = assigned()
        for c in range(len(now)):
            own = [v for (_, v), (_, n) in zip(good, at) if n == c]
            if own:
                now[c] = [sum(x) // len(own) for x in zip(*own)]
    at = assigned()
    inertia = Counter()
    for d, n in at:
        inertia[n] += d
    for (i, _), (d, n) in zip(good, at):
        yield i, n, min(d, MOST), min(inertia[n], MOST), min(sum(inertia.values()), MOST), tuple(now[n])


def result(df):
    return Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in df.collect())


@pytest.mark.parametrize("most", [1, 40, 100_000])
def test_clusters(spark, most):
    """Nulls, odd vectors, ties, repeated rows and ids, clashing columns, few values in some dimensions."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 4, 0.4), float(rng.randrange(2)), rng.choice([0.25, -0.5]), rng.gauss(0, 1)]) for i in range(160)]
    rows += [(500 + i, [1.0, 0.0, 0.25, 0.5]) for i in range(40)] + rows[:3] + [(7, [0.0, 0.0, 0.0, -0.001]), (None, [9.0, 1.0, 0.25, 0.5])]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [None, 1.0, 1.0, 1.0]), (904, [float("nan")] * 4), (905, [float("-inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cluster string, id int, v int").repartition(5)
    plain = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for k, rounds in ((8, 10), (3, 1), (2, 0)):
        assert result(cluster(df, clusters=k, rounds=rounds, dimensions=4, dictionary=most)) == Counter(brute(plain, 4, k, rounds))


def test_large_components_stay_exact(spark):
    rows = [(i, [x, 1e5 * i, -x]) for i, x in enumerate([3e8, -2.5e14, 1e3, 0.0, 7e12, 3e8])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(cluster(df, clusters=2, rounds=4, dimensions=3)) == Counter(brute(rows, 3, 2, 4))


def test_no_rows_and_no_ids(spark):
    schema = "vec_id long, embedding array<float>"
    assert cluster(spark.createDataFrame([], schema)).collect() == []
    bare = cluster(spark.createDataFrame([(None, [1.0] * 64)], schema)).collect()
    assert [tuple(r) for r in bare] == [(None,) * 6]
    two = cluster(spark.createDataFrame([(1, [1.0] * 64), (2, [2.0] * 64)], schema)).collect()
    assert sorted(r["cluster"] for r in two) == [0, 1] and {r["inertia"] for r in two} == {0}


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.integers(-3, 3, 500), rng.integers(0, 2, 500), rng.integers(-900, 900, 500), rng.integers(0, 3, 500)])
    for most in (1, 12, 1000):
        blocks = encode(x, most)
        assert np.array_equal(np.hstack([w[c] for w, c in blocks]), x)
        assert all(len(w) <= most for w, _ in blocks if w.shape[1] > 1) and all(len(np.unique(w, axis=0)) == len(w) for w, _ in blocks)
    assert [w.shape[1] for w, _ in encode(x, 12)] == [2, 1, 1]
    centre = rng.integers(-50, 50, (5, 4)).tolist()
    assert np.array_equal(distances(encode(x, 12), centre, 500), ((x[:, None] - np.array(centre)) ** 2).sum(2))


def test_each_subvector_is_measured_once(monkeypatch):
    """The cost of a round is that of the dictionary, not of the vectors."""
    x = np.tile(np.arange(6).reshape(3, 2), (1000, 1))
    blocks = encode(x, 10)
    assert [len(w) for w, _ in blocks] == [3] and distances(blocks, [[0, 0]], 3000)[:3, 0].tolist() == [1, 13, 41]
