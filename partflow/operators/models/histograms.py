"""Boosted regression trees grown from histograms of binned rows.

The trees are those of Spark's ``GBTRegressor`` with squared loss: the same
thresholds, drawn rows, splits, leaves and pruning (only sums of doubles are added
up in another order). A row is binned once and kept as a few bytes in blocks of
numpy arrays; a level of a tree is one pass over the blocks. There are no more tasks
than cores, and a task hands on one histogram a node, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bins of a feature, and rows that thresholds are taken from.
MAX_BINS = 32
SAMPLE = max(MAX_BINS * MAX_BINS, 10_000)
#: Values of a group of features that are counted together, in tables of more than so many rows.
GROUP, JOINT_ROWS = 1024, 1_000_000
BLOCK_ROWS = 1 << 16
#: Nodes whose histograms a task holds at once, and tasks whose histograms the driver adds up.
NODES, MERGED = 64, 64
#: Trees drawn for in one column, and between two cuts of the lineage.
DRAWS, CUT_EVERY = 16, 25
#: An impurity below is none.
EPSILON = float(np.finfo(float).eps)


class Layout(NamedTuple):
    """Thresholds of every feature, the column and stride of its bins, the columns and the values of a column."""

    thresholds: list[np.ndarray]
    column: list[int]
    stride: list[int]
    columns: int
    width: int

    def joint(self) -> bool:
        return self.columns < len(self.thresholds)

    def ends(self) -> np.ndarray:
        """Where the bins of the features end in a histogram of all of them."""
        return np.cumsum([len(t) + 1 for t in self.thresholds])


class Node(NamedTuple):
    """A node of a tree: its rows (n, sum, squares) and, unless it is a leaf, its split."""

    stats: tuple[float, float, float]
    impurity: float
    gain: float = -1.0
    feature: int = -1
    bin: int = -1
    children: tuple[int, int] = (-1, -1)

    def prediction(self) -> float:
        return self.stats[1] / self.stats[0] if self.stats[0] else 0.0


class Block(NamedTuple):
    """Rows of a task: bins by column, label, prediction so far, and bits of the rows drawn for each tree to come."""

    bins: np.ndarray
    label: np.ndarray
    predicted: np.ndarray
    drawn: np.ndarray


def impurity(n, total, squares):
    """Variance of rows given by their number, sum and sum of squares."""
    return (squares - total * total / n) / n if n else 0.0


def feature_thresholds(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Thresholds that cut the sampled ``values`` of a feature into ``bins`` of like sizes.

    Rows missing from the ``expected`` number beside those that are not 0 count as 0.
    """
    found, counts = np.unique(values[values != 0], return_counts=True)
    counts = counts.astype(float)
    if not len(found):
        return np.array([])
    zeros = expected - counts.sum()
    if zeros > EPSILON * expected * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, zeros)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= bins - 1:
        return middles
    stride = expected / bins
    kept, current, target = [], counts[0], stride
    for i in range(1, len(found)):
        before, current = current, current + counts[i]
        if abs(before - target) < abs(current - target):
            kept.append(middles[i - 1])
            target += stride
    return np.array(kept)


def find_layout(rows: DataFrame, n: int, features: Sequence[str], seed: int) -> Layout:
    """Thresholds from a sample of some SAMPLE of the ``n`` rows (all, if fewer), the one that GBTRegressor draws."""
    if not n:
        raise ValueError("there are no rows to train on")
    spark, share = rows.sparkSession, min(1.0, SAMPLE / n)
    sampled = rows.select(*features)
    if share < 1:
        first = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = sampled._jdf.toJavaRDD().sample(False, share, first)
        sampled = DataFrame(spark._jsparkSession.createDataFrame(drawn, sampled._jdf.schema()), spark)
    values = np.array(sampled.collect(), dtype=float).reshape(-1, len(features))
    _complete(values)
    thresholds = [feature_thresholds(values[:, i], share * n, min(MAX_BINS, n)) for i in range(len(features))]
    # Features share a column as long as their joint values are few: one count then serves all of them.
    # Not in small tables: there sums are added up in GBTRegressor's order, and equal gains differ alike.
    limit = GROUP if n > JOINT_ROWS else 1
    column, stride, used = [0] * len(features), [0] * len(features), []
    for i in sorted(range(len(features)), key=lambda i: -len(thresholds[i])):
        size = len(thresholds[i]) + 1
        at = next((c for c, product in enumerate(used) if product * size <= limit), len(used))
        used += [1] * (at == len(used))
        column[i], stride[i] = at, used[at]
        used[at] *= size
    return Layout(thresholds, column, stride, len(used), max(used))


def _complete(values: np.ndarray) -> None:
    if np.isnan(values).any():
        raise ValueError("features must not be null or NaN")


def _pack(batches: Iterator[pa.RecordBatch], layout: Layout, trees: int, drawing: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of a task: features, label and columns of draws."""
    held, n = [], 0

    def block():
        data = pa.Table.from_batches(held)
        k = len(layout.thresholds)
        numbers = [c.to_numpy() for c in data.columns[: k + 1]]
        bins = np.zeros((layout.columns, data.num_rows), np.uint16)
        for i, cuts in enumerate(layout.thresholds):
            _complete(numbers[i])
            bins[layout.column[i]] += (np.searchsorted(cuts, numbers[i]) * layout.stride[i]).astype(np.uint16)
        if not np.isfinite(numbers[k]).all():
            raise ValueError("labels must be finite numbers")
        draws = [c.to_numpy() for c in data.columns[k + 1 :]]
        bits = [np.packbits((draws[t // DRAWS] >> (t % DRAWS)) & 1 > 0) for t in range(trees)] if drawing else []
        parts = bins.tobytes(), numbers[k].astype(float).tobytes(), b"".join(b.tobytes() for b in bits)
        return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["bins", "label", "drawn"])

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, BLOCK_ROWS - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == BLOCK_ROWS:
                yield block()
                held, n = [], 0
    if n:
        yield block()


def _block(row, columns: int) -> Block:
    label = np.frombuffer(row["label"])
    with np.errstate(invalid="ignore"):
        # In the smallest type that holds all of them.
        label = next(x for x in (label.astype(t) for t in ("i2", "i4", "f8")) if np.array_equal(x, label))
    drawn = np.frombuffer(row["drawn"], np.uint8).reshape(-1, (len(label) + 7) // 8)
    return Block(np.frombuffer(row["bins"], np.uint16).reshape(columns, -1), label, np.zeros(len(label)), drawn)


def blocks(rows: DataFrame, features: Sequence[str], label: str, layout: Layout, trees: int, share: float, seed: int) -> RDD:
    """The binned rows with their draws; ``rand`` gives the rows that GBTRegressor draws for a tree."""
    rows, drawing = rows.select(*features, label), share < 1
    for first in range(0, trees if drawing else 0, DRAWS):
        bits = [F.shiftleft((F.rand(seed + t + 1) < share).cast("int"), t - first) for t in range(first, min(first + DRAWS, trees))]
        merged = bits[0]
        for b in bits[1:]:
            merged = merged.bitwiseOR(b)
        rows = rows.withColumn(f"_drawn{first}", merged)
    packed = rows.mapInArrow(lambda batches: _pack(batches, layout, trees, drawing), "bins binary, label binary, drawn binary")
    with compiled_methods(rows.sparkSession):
        return packed.rdd.map(lambda row: _block(row, layout.columns))


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Plans made within have no method that the JVM leaves to its interpreter, as it does with one that draws for many trees."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "8000")
    try:
        yield
    finally:
        spark.conf.set(limit, before)


class _Steps:
    """A tree so far as tables: the column a node looks at and the child by its value; a leaf leads to itself."""

    def __init__(self, tree: list[Node], layout: Layout):
        self.column = np.zeros(len(tree), np.intp)
        self.width = layout.width
        self.child = np.repeat(np.arange(len(tree)), self.width).reshape(-1, self.width)
        for i, node in enumerate(tree):
            if node.feature >= 0:
                f = node.feature
                value = np.arange(self.width) // layout.stride[f] % (len(layout.thresholds[f]) + 1)
                self.column[i] = layout.column[f]
                self.child[i] = np.where(value <= node.bin, *node.children)
        self.child = self.child.ravel()

    def walk(self, bins: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """The node that each of ``rows`` is in after so many levels."""
        if not levels:
            return np.zeros(len(rows), np.intp)
        flat = bins.ravel()
        node = self.child[bins[self.column[0]][rows]]
        for _ in range(levels - 1):
            at = self.column[node]
            at *= bins.shape[1]
            at += rows
            node *= self.width
            node += flat[at]
            node = self.child[node]
        return node


def _histograms(part: int, held: Iterator[Block], tree: list[Node], level: int, open_: list[int], scale: float, layout: Layout):
    """(part, histograms of the ``open_`` nodes) over the drawn rows of a task: n, sum and squares of every bin."""
    steps, place = _Steps(tree, layout), np.full(len(tree), -1, np.intp)
    place[open_] = np.arange(len(open_)) * layout.width
    sums = np.zeros((layout.columns, 3, len(open_) * layout.width))
    for bins, base, rest in _together(_counted(block, steps, place, level, scale) for block in held):
        squares, at = rest * rest, np.empty_like(base)
        for c in range(layout.columns):
            np.add(base, bins[c], out=at)
            for i, weights in enumerate((None, rest, squares)):
                sums[c, i] += np.bincount(at, weights, minlength=sums.shape[2])
    sums = sums.reshape(layout.columns, 3, len(open_), layout.width)
    yield part, np.concatenate([_of_feature(sums, f, layout) for f in range(len(layout.thresholds))], 2)


def _counted(block: Block, steps: _Steps, place: np.ndarray, level: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, place of the node and what is left to explain of the drawn rows in nodes that have a place."""
    n = len(block.label)
    rows = np.flatnonzero(np.unpackbits(block.drawn[0], count=n)) if len(block.drawn) else np.arange(n)
    base = place[steps.walk(block.bins, rows, level)]
    if level:
        inside = np.flatnonzero(base >= 0)
        rows, base = rows[inside], base[inside]
    return block.bins.take(rows, 1), base, (block.label[rows] - block.predicted[rows]) * scale


def _together(parts: Iterator[tuple]) -> Iterator[tuple]:
    """``parts`` joined until they have BLOCK_ROWS rows, as adding up takes the same for few."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[1])
        if n >= BLOCK_ROWS:
            yield _joined(held)
            held, n = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[tuple]) -> tuple:
    if len(parts) == 1:
        return parts[0]
    bins, base, rest = zip(*parts)
    return np.concatenate(bins, 1), np.concatenate(base), np.concatenate(rest)


def _of_feature(sums: np.ndarray, f: int, layout: Layout) -> np.ndarray:
    """(3, nodes, bins) of one feature out of the joint sums of its column."""
    size, stride, joint = len(layout.thresholds[f]) + 1, layout.stride[f], sums[layout.column[f]]
    spare = -layout.width % (size * stride)
    joint = np.pad(joint, ((0, 0), (0, 0), (0, spare)))
    return joint.reshape(*joint.shape[:2], -1, size, stride).sum((2, 4))


def _merged(sums: RDD) -> np.ndarray:
    """All histograms added up, in the order of the tasks; those of many tasks meet in other tasks first."""
    if sums.getNumPartitions() > MERGED:
        return sums.treeReduce(lambda a, b: (a[0], a[1] + b[1]))[1]
    return sum(h for _, h in sorted(sums.collect(), key=lambda p: p[0]))


def _variances(n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    some = np.where(n > 0, n, 1)
    return np.where(n > 0, (squares - total * total / some) / some, 0.0)


def best_split(whole: np.ndarray, known: Node | None, layout: Layout):
    """(node with its split or without, stats of both sides) by the largest gain; the first feature and bin on ties."""
    features = np.split(whole, layout.ends()[:-1], axis=1)
    stats = known.stats if known else tuple(float(x) for x in features[0].sum(1))
    own = known.impurity if known else impurity(*stats)
    best = None
    for f, histogram in enumerate(features):
        if histogram.shape[1] < 2:
            continue
        left = np.cumsum(histogram, 1)
        right = left[:, -1:] - left[:, :-1]
        left = left[:, :-1]
        n = max(left[0, 0] + right[0, 0], 1.0)
        gain = own - left[0] / n * _variances(*left) - right[0] / n * _variances(*right)
        gain = np.where((left[0] >= 1) & (right[0] >= 1) & (gain >= 0), gain, -np.inf)
        i = int(np.argmax(gain))
        if best is None or gain[i] > best[0]:
            best = float(gain[i]), f, i, tuple(map(float, left[:, i])), tuple(map(float, right[:, i]))
    if best is None or best[0] == -np.inf:
        # Nothing can be split: told apart from a split that gains nothing.
        return Node(stats, -1.0), None
    if best[0] <= 0:
        return Node(stats, own), None
    gain, f, i, left, right = best
    return Node(stats, own, gain, f, i), (left, right)


def grow_tree(held: RDD, layout: Layout, depth: int, scale: float) -> list[Node]:
    """One tree on the drawn rows: a pass a level.

    Of two nodes of one parent, in large tables only the smaller is counted; the other has the rest.
    """
    tree, open_, level, whole = [Node((0.0, 0.0, 0.0), 0.0)], [0], 0, {}
    while open_:
        now, at, following, above, whole = list(tree), level, [], whole, {}
        pairs = [c for c in (n.children for n in tree) if layout.joint() and c[0] in open_ and c[1] in open_]
        larger = {max(c, key=lambda i: now[i].stats[0]): c for c in pairs}
        counted = [node for node in open_ if node not in larger]
        for first in range(0, len(counted), NODES):
            nodes = counted[first : first + NODES]
            sums = _merged(held.mapPartitionsWithIndex(lambda p, b: _histograms(p, b, now, at, nodes, scale, layout)))
            whole |= {node: sums[:, i] for i, node in enumerate(nodes)}
        parents = {c: p for p, n in enumerate(tree) for c in n.children}
        whole |= {node: above[parents[node]] - whole[sum(c) - node] for node, c in larger.items()}
        found = {node: best_split(whole[node], now[node] if at else None, layout) for node in open_}
        for node in open_:
            tree[node], sides = found[node]
            if sides is None:
                continue
            if level == depth:
                tree[node] = Node(tree[node].stats, tree[node].impurity)
                continue
            first = len(tree)
            tree[node] = tree[node]._replace(children=(first, first + 1))
            for i, stats in enumerate(sides):
                child = Node(stats, impurity(*stats))
                tree.append(child)
                if level + 1 < depth and abs(child.impurity) >= EPSILON:
                    following.append(first + i)
        open_, level = following, level + 1
    return tree


def _advance(block: Block, tree: list[Node], rate: float, depth: int, layout: Layout) -> Block:
    """The rows with the tree's prediction added, and the draws of the trees to come."""
    leaves = np.array([node.prediction() for node in tree]) * rate
    predicted = block.predicted + leaves[_Steps(tree, layout).walk(block.bins, np.arange(len(block.label)), depth)]
    return Block(block.bins, block.label, predicted, block.drawn[1:])


def grow(rows: DataFrame, n: int, features: Sequence[str], label: str, trees: int, depth: int, rate: float, share: float, seed: int) -> tuple[Layout, list[list[Node]]]:
    """All trees on the ``n`` rows. The first has weight 1 and the others ``rate``, on twice what is left."""
    layout = find_layout(rows, n, features, seed)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    held, grown, behind, cut = blocks(rows, features, label, layout, trees, share, seed), [], None, None
    for t in range(trees):
        held.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        cutting = t % CUT_EVERY == CUT_EVERY - 1
        if cutting:
            held.checkpoint()
        # One task a core, over several partitions: a histogram takes as much whatever the rows.
        few = held.coalesce(cores) if held.getNumPartitions() > cores else held
        tree = grow_tree(few, layout, depth, 2.0 if t else 1.0)
        grown.append(tree)
        if behind is not None:
            behind.unpersist()
        if cutting:
            _drop(rows.sparkSession, cut)
            cut = held.getCheckpointFile()
        behind, weight = held, rate if t else 1.0
        held = held.map(lambda block, tree=tree, weight=weight: _advance(block, tree, weight, depth, layout))
    if behind is not None:
        behind.unpersist()
    _drop(rows.sparkSession, cut)
    return layout, grown


def _drop(spark: SparkSession, folder: str | None) -> None:
    """Remove a checkpoint that nothing reads any more."""
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def node_rows(number: int, tree: list[Node], layout: Layout) -> list[tuple]:
    """The tree as rows of a saved Spark model, in preorder; two leaves that predict the same are one."""
    done: list[tuple] = []

    def same_leaf(node: Node) -> float | None:
        """What all leaves below predict, if that is one number."""
        if node.feature < 0:
            return node.prediction()
        left, right = (same_leaf(tree[c]) for c in node.children)
        return left if left is not None and left == right else None

    def add(node: Node) -> int:
        at = len(done)
        done.append(())
        one = same_leaf(node)
        about = [float(x) for x in node.stats], int(node.stats[0])
        if one is not None:
            done[at] = (number, (at, one, node.impurity, *about, -1.0, -1, -1, (-1, [], -1)))
        else:
            below, above = add(tree[node.children[0]]), add(tree[node.children[1]])
            split = node.feature, [float(layout.thresholds[node.feature][node.bin])], -1
            done[at] = (number, (at, node.prediction(), node.impurity, *about, node.gain, below, above, split))
        return at

    add(tree[0])
    return done
