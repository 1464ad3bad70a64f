"""Exact top-k by inner product with an M-tree.

The largest inner product is the smallest Euclidean distance once every vector
has one more component that brings it to the same length. In that metric space:

* the root page holds routing vectors, a bounded sample, and their covering radii;
* every vector belongs to its nearest routing vector; its subtree is cut into
  trees of at most ``TREE_ROWS`` vectors, so a hot routing vector is many trees;
* a tree's pages hold up to ``PAGE_ROWS`` vectors with a page centre, a covering
  radius, and the distances of centre and vectors to their parents.

A query first searches the trees of its nearest routing vector; its k-th
distance then rules out root entries, and only the trees left are searched, page
by page, nearest bound first. Stored parent distances spare most distances by
the triangle inequality. Scores are exact integers; bounds have a slack far
above rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.session import materialize

SCALE, K = 1024, 10
ROUTERS, TREE_ROWS, PAGE_ROWS, BLOCK_QUERIES = 64, 4096, 64, 1024


def quantized(df: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) with integer components; vectors with a null, NaN or infinity are left out.

    Rows without an id take no part either. Vectors of different dimensions
    never meet.
    """
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = df.filter(F.col(vector).isNotNull() & F.col(id_column).isNotNull()).filter(fine)
    return kept.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"), F.size(vector).alias("dim"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _lifted(v: np.ndarray, top: float) -> np.ndarray:
    """The vectors with the component that makes all squared lengths ``top``."""
    f = v.astype(np.float64)
    return np.column_stack([f, np.sqrt(np.maximum(top - (f * f).sum(1), 0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _slack(top: float) -> float:
    return 1e-5 * (top**0.5 + 1)


class Tree:
    """Pages of one tree, in arrays; ``router`` is the parent of the page centres."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, router: np.ndarray, top: float):
        x = _lifted(v, top)
        order, cuts = self._paged(x)
        self.ids, self.v = ids[order], v[order]
        x = x[order]
        self.cuts = cuts
        self.centres = np.array([x[a:b].mean(0) for a, b in zip(cuts[:-1], cuts[1:])])
        page = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        self.to_centre = np.sqrt(((x - self.centres[page]) ** 2).sum(1))
        self.radius = np.maximum.reduceat(self.to_centre, cuts[:-1])
        self.to_router = _distances(self.centres, router[None])[:, 0]

    @staticmethod
    def _paged(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order of the rows and page borders: halve at the median along two far rows."""
        done, todo = [], [np.arange(len(x))]
        while todo:
            rows = todo.pop()
            if len(rows) <= PAGE_ROWS:
                done.append(rows)
                continue
            part = x[rows]
            a = part[np.argmax(((part - part[0]) ** 2).sum(1))]
            b = part[np.argmax(((part - a) ** 2).sum(1))]
            rows = rows[np.argsort(part @ (b - a), kind="stable")]
            half = len(rows) // 2
            todo += [rows[half:], rows[:half]]
        return np.concatenate(done), np.cumsum([0, *map(len, done)])

    def search(self, query_id: int, q: np.ndarray, limit: float, to_router: float, top: float, k: int) -> list[tuple[int, int]]:
        """(score, id) of the rows that can be among the query's ``k`` best, best first."""
        slack = _slack(top)
        lifted = np.append(q.astype(np.float64), 0.0)
        length = top + float(lifted @ lifted)
        bound = np.abs(to_router - self.to_router) - self.radius
        near = np.flatnonzero(bound <= limit + slack)
        to_page = np.sqrt(((self.centres[near] - lifted) ** 2).sum(1))
        bound = to_page - self.radius[near]
        best: list[tuple[int, int]] = []
        for i in np.argsort(bound):
            if bound[i] > limit + slack:
                break
            a, b = self.cuts[near[i]], self.cuts[near[i] + 1]
            rows = a + np.flatnonzero(np.abs(to_page[i] - self.to_centre[a:b]) <= limit + slack)
            rows = rows[self.ids[rows] != query_id]
            if not len(rows):
                continue
            scores = self.v[rows] @ q
            best = sorted([*best, *zip((-scores).tolist(), self.ids[rows].tolist())])[:k]
            if len(best) == k:
                limit = min(limit, max(0.0, length + 2 * best[-1][0]) ** 0.5)
        return [(-s, i) for s, i in best]


def search_topk(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """Each query's ``k`` best rows of ``vectors``: query_id, rank, vec_id, score.

    Both tables are ``quantized``. Rows with the query's own id are no answers;
    equal scores go by the smaller id, repeated rows rank one by one. Repeated
    query rows are asked once. Queries without any candidate have no row.
    """
    spark = vectors.sparkSession
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = {r["dim"]: (r["top"], r["n"]) for r in vectors.withColumn("norm", norm).groupBy("dim").agg(F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")).collect()}
    out = "query_id long, vec_id long, score long"
    results = [_search_dimension(vectors.filter(F.col("dim") == d), queries.filter(F.col("dim") == d), d, *facts[d], k) for d in sorted(facts) if d > 0]
    found = results[0] if results else spark.createDataFrame([], out)
    for more in results[1:]:
        found = found.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_dimension(vectors: DataFrame, queries: DataFrame, dim: int, top: float, rows: int, k: int) -> DataFrame:
    spark = vectors.sparkSession
    picked = vectors.select("vec_id", "v").dropDuplicates(["v"]).orderBy(F.xxhash64("v"), "vec_id").limit(ROUTERS).collect()
    routers = _lifted(np.array([r["v"] for r in picked], np.int64), top)
    slack = _slack(top)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _lifted(_matrix(batch.column(1)), top)
            far = _distances(x, routers)
            best = np.argmin(far, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.int32()), pa.array(far[np.arange(len(best)), best])], names=["vec_id", "v", "router", "far"])

    placed = materialize(vectors.select("vec_id", "v").mapInArrow(nearest, "vec_id long, v array<long>, router int, far double"), "mtree-placed")
    root = {r["router"]: (r["radius"], r["n"]) for r in placed.groupBy("router").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    trees_of = {r: -(-n // TREE_ROWS) for r, (_, n) in root.items()}
    radius = np.array([root[r][0] if r in root else -np.inf for r in range(len(picked))])

    def build(group: pa.Table) -> pa.Table:
        router = group.column("router")[0].as_py()
        tree = Tree(group.column("vec_id").to_numpy(), _matrix(group.column("v")), routers[router], top)
        n = len(tree.cuts) - 1
        return pa.table(
            {
                "router": pa.array([router], pa.int32()),
                "tree": pa.array([group.column("tree")[0].as_py()], pa.int32()),
                "ids": pa.array([tree.ids.tobytes()], pa.binary()),
                "v": pa.array([tree.v.tobytes()], pa.binary()),
                "cuts": pa.array([tree.cuts.astype(np.int64).tobytes()], pa.binary()),
                "centres": pa.array([tree.centres.tobytes()], pa.binary()),
                "to_centre": pa.array([tree.to_centre.tobytes()], pa.binary()),
                "radius": pa.array([tree.radius.tobytes()], pa.binary()),
                "to_router": pa.array([tree.to_router.tobytes()], pa.binary()),
                "pages": pa.array([n], pa.int32()),
            }
        )

    counts = F.create_map(*[F.lit(x) for pair in trees_of.items() for x in pair])
    numbered = placed.withColumn("tree", F.pmod(F.xxhash64("vec_id", "v"), counts[F.col("router")].cast("long")).cast("int"))
    tree_schema = "router int, tree int, ids binary, v binary, cuts binary, centres binary, to_centre binary, radius binary, to_router binary, pages int"
    trees = materialize(numbered.groupBy("router", "tree").applyInArrow(build, tree_schema), "mtree-trees")

    asked = materialize(queries.select(F.col("vec_id").alias("query_id"), "v").distinct(), "mtree-queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    def visits(limits: bool):
        """(query, root entry) pairs to search: the nearest entry, or all others that can matter."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = np.column_stack([_matrix(batch.column("v")).astype(np.float64), np.zeros(batch.num_rows)])
                far = _distances(q, routers)
                home = np.argmin(np.where(np.isfinite(radius), far, np.inf), 1)
                if limits:
                    limit = batch.column("limit").fill_null(np.inf).to_numpy(zero_copy_only=False)
                    ok = (far - radius <= limit[:, None] + slack) & (np.arange(len(radius)) != home[:, None]) & np.isfinite(radius)
                else:
                    limit = np.full(batch.num_rows, np.inf)
                    ok = np.arange(len(radius)) == home[:, None]
                at, router = np.nonzero(ok)
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(take), batch.column("v").take(take), pa.array(router, pa.int32()), pa.array(far[at, router]), pa.array(limit[at])],
                    names=["query_id", "v", "router", "to_router", "limit"],
                )

        return run

    def searched(source: DataFrame, limits: bool) -> DataFrame:
        pairs = source.mapInArrow(visits(limits), "query_id long, v array<long>, router int, to_router double, limit double")
        per_tree = F.explode(F.sequence(F.lit(0), counts[F.col("router")].cast("int") - 1))
        pairs = pairs.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("tree", per_tree)
        held = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

        def look(left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            if left.num_rows and right.num_rows:
                row = left.to_pylist()[0]
                tree = Tree.__new__(Tree)
                tree.ids = np.frombuffer(row["ids"], np.int64)
                tree.v = np.frombuffer(row["v"], np.int64).reshape(-1, dim)
                tree.cuts = np.frombuffer(row["cuts"], np.int64)
                tree.centres = np.frombuffer(row["centres"]).reshape(row["pages"], -1)
                for name in ("to_centre", "radius", "to_router"):
                    setattr(tree, name, np.frombuffer(row[name]))
                q = _matrix(right.column("v"))
                for i, (query, far, limit) in enumerate(zip(right.column("query_id").to_pylist(), right.column("to_router").to_pylist(), right.column("limit").to_pylist())):
                    found += [(query, vec, score) for score, vec in tree.search(query, q[i], limit, far, top, k)]
            columns = zip(*found) if found else [[]] * 3
            return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

        keys = ("router", "tree", "block")
        return held.groupBy(*keys).cogroup(pairs.groupBy(*keys)).applyInArrow(look, "query_id long, vec_id long, score long")

    first = materialize(searched(asked, False), "mtree-home")
    worst = first.withColumn("at", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("at") == k)
    length = F.lit(top) + F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    # Null where the home entry gave fewer than k rows: then nothing is ruled out.
    limit = F.when(F.col("score").isNotNull(), F.sqrt(F.greatest(F.lit(0.0), length - 2 * F.col("score"))))
    bounded = asked.join(worst.select("query_id", "score"), "query_id", "left").select("query_id", "v", limit.alias("limit"))
    return first.unionByName(searched(bounded, True))
