"""Toxicity by the nearest labelled texts under exact TF-IDF cosine.

Terms are words and the first characters of longer words. The vocabulary is
every term of a bounded sample of labelled texts of both classes; document
frequencies are counted over all documents. A term's weight is TF-IDF times how
well it tells the labels apart (its phi coefficient, which does not grow with
the table, and a floor), so no term and no text is left out.

The labelled texts make an inverted index, segments that tasks pack and workers
put together. Texts alike lie next to each other, in blocks. The most frequent terms lie
apart as a matrix in single precision: one matrix product for some documents at
a time gives what they add to every text. Short posting lists are added up as
they are, of long ones first only each block's largest value. The blocks around
the best by this bound are summed up and give a least k-th cosine; blocks whose
bound does not reach it are left out, at both ends of the index. What comes
within the product's error of the k-th is summed up again in double precision,
so no bound loses a neighbour; weights are kept in single precision, so cosines
are exact to about 1e-6.
Votes are weighted by cosine and by what share of its class the sample holds,
and smoothed towards the overall rate.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.parquet
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm.common import kept_by_worker, slices, with_fields
from partflow.session import materialize

#: Documented bound: labelled examples of each class.
EXAMPLES = 10_000
NEIGHBOURS, STEM = 15, 5
#: Terms of the index's matrix; documents searched at a time; more than the product's error.
FREQUENT, AT_ONCE, ERROR = 512, 128, 1e-5
#: Rows of a block; least rows of a list with block maxima; blocks around the best that give the first bound; texts that blocks are made around.
BLOCK, LONG, FIRST, LEADERS = 64, 256, 6, 128
#: Texts a task keeps the neighbours of, for copies; words it keeps the terms of.
KEPT, KEPT_WORDS = 20_000, 1 << 17
#: Partitions that postings are packed in; postings of a segment that are put into the index at a time.
SEGMENTS, PART = 16, 1 << 16
#: Weight of a term that tells nothing about the label; smoothing.
FLOOR, SMOOTH = 0.05, 0.5
_WORD = re.compile(r"[^\W\d_]+")


def term_hash(term: str) -> int:
    """A term's name in the vocabulary: 63 bits, so that a million terms take 8 MB and no two meet."""
    return xxhash.xxh64_intdigest(term.encode()) >> 1


class _Terms:
    """Texts to the vocabulary ids of their terms; words seen are kept, within a bound.

    The new words of some texts are looked up at once.
    """

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        #: Word, numbered when it is first asked for, to its row of ids: the word's and its stem's, the vocabulary's size for none.
        self.place = defaultdict(count().__next__)
        self.ids = np.zeros((0, 2), np.int32)

    def _add(self, words: list[str]) -> None:
        # A short word has no stem.
        stemmed = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)) >= STEM)
        at = np.full((len(words), 2), len(self.vocabulary), np.int32)
        at[:, 0] = self._found(words)
        at[stemmed, 1] = self._found([f"{words[i][:STEM]}*" for i in stemmed.tolist()])
        self.ids = np.concatenate([self.ids, at])

    def _found(self, terms: list[str]) -> np.ndarray:
        """Places in the vocabulary, its size for terms it does not have."""
        names = (np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms)) >> np.uint64(1)).astype(np.int64)
        at = np.searchsorted(self.vocabulary, names)
        at[np.append(self.vocabulary, -1)[at] != names] = len(self.vocabulary)
        return at

    def of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each text's terms in order, and how often it has them; some texts' words are held at a time."""
        for at in range(0, len(texts), AT_ONCE):
            yield from self._of(texts[at : at + AT_ONCE])

    def _of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(self.place) > KEPT_WORDS:
            self._clear()
        found = [Counter(_words(t)) for t in texts]
        places = [np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)) for words in found]
        if len(self.place) > len(self.ids):
            self._add(list(islice(self.place, len(self.ids), None)))
        for words, at in zip(found, places):
            terms, which = np.unique(self.ids[at], return_inverse=True)
            each = np.repeat(np.fromiter(words.values(), np.int64, len(words)), 2)
            counts = np.bincount(which.ravel(), each, len(terms)).astype(np.int64)
            known = slice(None, -1 if len(terms) and terms[-1] == len(self.vocabulary) else None)
            yield terms[known], counts[known]


def _terms(word: str) -> tuple[str, ...]:
    return (word, f"{word[:STEM]}*") if len(word) > STEM else (word, f"{word}*") if len(word) == STEM else (word,)


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Model(NamedTuple):
    #: Hashes of all terms, sorted; a term's id is its place.
    vocabulary: np.ndarray
    weight: np.ndarray
    index: "Stored | None"
    prior: float
    no_term: float


class Index:
    """Inverted index over unit vectors: a matrix of the most frequent terms, short lists, long lists in blocks of rows."""

    def __init__(self, vectors: list[dict[int, float]], ids: np.ndarray, labels: np.ndarray, weights: np.ndarray, terms: int):
        rows = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(v) for v in vectors])
        term = np.array([t for v in vectors for t in v], np.int32)
        order = np.lexsort((rows, term))
        value = np.array([x for v in vectors for x in v.values()], float)[order]
        held = np.bincount(term, minlength=terms)
        self._build([(term[order], rows[order], value)], held, ids, labels, weights)

    @classmethod
    def of_postings(cls, *postings) -> Index:
        """From parts of (term, row, value) arrays instead of dictionaries: stretches of rows in order, each sorted by term."""
        index = cls.__new__(cls)
        index._build(*postings)
        return index

    def _build(self, parts, held: np.ndarray, ids: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        self.ids, self.labels, self.weights = ids, labels, weights
        often = np.argsort(-held, kind="stable")[:FREQUENT]
        self.place = np.full(len(held), -1, np.int32)
        self.place[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), len(ids)), np.float32)
        size = held.copy()
        size[often] = 0
        self.first = np.concatenate([[0], np.cumsum(size)])
        narrow = np.uint16 if len(ids) <= 1 << 16 else np.int32
        self.row, self.value = np.empty(self.first[-1], narrow), np.empty(self.first[-1], np.float32)
        free = self.first[:-1].copy()
        for term, row, value in parts:
            inside = self.place[term] >= 0
            self.matrix[self.place[term[inside]], row[inside]] = value[inside]
            term, row, value = term[~inside], row[~inside], value[~inside]
            # Behind what the parts before have of the same term.
            start = np.flatnonzero(np.diff(term, prepend=-1))
            sizes = np.diff(start, append=len(term))
            at = np.repeat(free[term[start]] - start, sizes) + np.arange(len(term))
            self.row[at], self.value[at] = row, value
            free[term[start]] += sizes
        # Long lists: their place where each block begins, and each block's largest value.
        long, blocks = np.flatnonzero(size >= LONG), -(-len(ids) // BLOCK)
        self.slot = np.full(len(held), -1, np.int32)
        self.slot[long] = np.arange(len(long))
        self.begin = np.empty((len(long), blocks + 1), np.int32)
        self.top = np.zeros((len(long), blocks), np.float32)
        for begin, top, t in zip(self.begin, self.top, long.tolist()):
            whole = slice(self.first[t], self.first[t + 1])
            begin[:] = np.searchsorted(self.row[whole], np.arange(blocks + 1) * BLOCK) + self.first[t]
            some = begin[:-1] < begin[1:]
            top[some] = np.maximum.reduceat(self.value[whole], begin[:-1][some] - self.first[t])

    def nearest(self, query: dict[int, float], k: int) -> list[tuple[float, int]]:
        """The k rows of the largest cosine above 0: (cosine, row), ties by row."""
        cosine, row = self.search([(np.array(list(query), np.int64), np.array(list(query.values()), float))], k)[0]
        return list(zip(cosine.tolist(), row.tolist()))

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of many (terms, weights): cosines and rows."""
        often = np.zeros((len(queries), len(self.matrix)), np.float32)
        for q, (term, weight) in zip(often, queries):
            place = self.place[term]
            q[place[place >= 0]] = weight[place >= 0]
        return [self._best(*query, q, sums, k) for query, q, sums in zip(queries, often, often @ self.matrix)]

    def _best(self, term: np.ndarray, weight: np.ndarray, often: np.ndarray, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        slot = self.slot[term]
        short, long = (self.place[term] < 0) & (slot < 0), slot >= 0
        begin, size = self.first[term[short]], self.first[term[short] + 1] - self.first[term[short]]
        places = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        score = np.bincount(self.row[places], self.value[places] * np.repeat(weight[short], size), n).astype(float, copy=False)
        begin, weight = self.begin[slot[long]], weight[long]
        bound = weight.astype(np.float32) @ self.top[slot[long]]
        reach = np.maximum.reduceat(score + sums, np.arange(0, n, BLOCK)) + bound
        wanted, least = np.ones(len(reach), bool), 0.0
        if len(reach) > FIRST:
            start = max(0, int(reach.argmax()) - FIRST // 2)
            stop = min(start + FIRST, len(reach))
            some = slice(start * BLOCK, min(stop * BLOCK, n))
            known = score[some] + sums[some] + self._added(begin[:, start], begin[:, stop], weight)[some]
            least = np.partition(known, len(known) - k)[len(known) - k] if len(known) > k else 0.0
            wanted = (reach >= least - ERROR) & (reach > 0)
        # Blocks alike are neighbours: one stretch holds all that is wanted and little else.
        reached = np.flatnonzero(wanted)
        start, stop = (int(reached[0]), int(reached[-1]) + 1) if len(reached) else (0, 0)
        score += self._added(begin[:, start], begin[:, stop], weight)
        whole = slice(start * BLOCK, min(stop * BLOCK, n))
        about = score[whole] + sums[whole]
        rows = np.flatnonzero((about >= least - 2 * ERROR) & (about > 0))
        about = about[rows]
        kth = np.partition(about, len(rows) - k)[len(rows) - k] if len(rows) > k else 0.0
        rows = rows[about >= kth - ERROR] + whole.start
        some = np.flatnonzero(often)
        cosine = np.round(score[rows] + often[some].astype(float) @ self.matrix[np.ix_(some, rows)], 12)
        best = np.lexsort((rows, -cosine))[:k]
        return cosine[best], rows[best]

    def _added(self, begin: np.ndarray, end: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What these parts of the lists of terms add to every row."""
        places = [slice(a, b) for a, b in zip(begin.tolist(), end.tolist()) if a < b]
        if not places:
            return np.zeros(len(self.ids))
        value = np.concatenate([self.value[at] for at in places])
        value *= np.repeat(weight.astype(np.float32), end - begin)
        return np.bincount(np.concatenate([self.row[at] for at in places]), value, len(self.ids))


class Stored(NamedTuple):
    """An index as segments of postings (term, row, count), a few bytes each, and what its rows are.

    A segment holds a stretch of rows, sorted by term; segments lie in the order of rows.
    """

    segments: list[bytes]
    #: Texts of the sample that have each term.
    held: np.ndarray
    #: Length of each row's vector before it is divided by it.
    norm: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def load(self, weigh: np.ndarray) -> Index:
        return Index.of_postings(self._parts(weigh), self.held, self.ids, self.labels, self.weights)

    def _parts(self, weigh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for segment in self.segments:
            postings = pyarrow.parquet.ParquetFile(pa.BufferReader(segment))
            for part in postings.iter_batches(PART, use_threads=False):
                term, row, count = (part.column(c).to_numpy() for c in ("term", "row", "count"))
                yield term, row, (1 + np.log(count)) * weigh[term] / self.norm[row]


def _own_number(spark: SparkSession) -> int:
    """No two calls have the same, whatever worker they meet in."""
    return xxhash.xxh64_intdigest(f"{spark.sparkContext.applicationId}-{uuid.uuid4()}")


def _sample(labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Up to ``most`` labelled ids of each class in hash order; class: (all, taken)."""
    one = labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = [one.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    return taken[0].unionByName(taken[1]), {c: (n, min(n, most)) for c, n in sizes.items()}


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """A model from ``labels`` (doc_id, label 0 or 1) of texts of ``docs`` (doc_id, text).

    Null labels and ids take no part, an id labelled twice counts as toxic if one
    label is. A labelled id without a document is no example, one with several
    rows gives one with the least of their texts. Without labels the model scores 0.
    """
    spark = docs.sparkSession
    sample, sizes = _sample(labels, examples)
    total = sum(n for n, _ in sizes.values())
    prior = sizes.get(1, (0, 0))[0] / total if total else 0.0
    weight = {c: n / taken for c, (n, taken) in sizes.items()}
    # At most 2 * examples rows.
    picked = spark.createDataFrame(sample.collect(), "doc_id long, label int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    texts = materialize(texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxicity-sample")

    def by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            seen = (Counter(), Counter())
            for body, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                seen[label].update({t for w in set(_words(body)) for t in _terms(w)})
            terms = sorted({*seen[0], *seen[1]})
            yield pa.RecordBatch.from_pydict({"term": pa.array([term_hash(t) for t in terms], pa.int64()), "clean": pa.array([seen[0][t] for t in terms], pa.int64()), "toxic": pa.array([seen[1][t] for t in terms], pa.int64())})

    n0, n1 = (float(max(1, sizes.get(c, (0, 0))[1])) for c in (0, 1))
    counts = texts.mapInArrow(by_label, "term long, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    clean, toxic = F.col("clean"), F.col("toxic")
    all_texts, held = n0 + n1, clean + toxic
    phi = F.abs(toxic * n0 - clean * n1) / F.sqrt(n0 * n1 * held * F.greatest(all_texts - held, F.lit(1.0)))
    # At most the terms of the sample's texts.
    told = counts.select("term", phi.alias("phi"), held.cast("int").alias("held")).toArrow().sort_by("term")
    words = told.column("term").to_numpy()
    tells = FLOOR + np.minimum(told.column("phi").to_numpy(), 1.0)
    held = told.column("held").to_numpy().astype(np.int64)
    del told
    if not len(words):
        return Model(words, np.zeros(0), None, prior, prior)
    # Sent once for all passes.
    sent = spark.sparkContext.broadcast(words)
    own = ("terms", _own_number(spark))

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_by_worker(own, lambda: _Terms(sent.value))
        seen, n = np.zeros(len(known.vocabulary), np.int64), 0
        for batch in slices(batches, "text"):
            for terms, _ in known.of(batch.column("text").to_pylist()):
                seen[terms] += 1
            n += batch.num_rows
        terms = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(terms, -1), pa.int32()), "n": pa.array(np.append(seen[terms], n), pa.int64())})

    found = docs.select("text").mapInArrow(frequency, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n_of = np.zeros(len(words) + 1)
    n_of[found.column("term").to_numpy()] = found.column("n").to_numpy()  # -1, the last: all documents
    weighs = (np.log((1 + n_of[-1]) / (1 + n_of[:-1])) + 1) * tells

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_by_worker(own, lambda: _Terms(sent.value))
        for batch in slices(batches, "text"):
            found = list(known.of(batch.column("text").to_pylist()))
            columns = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *columns], names=["doc_id", "label", "terms", "counts"])

    ddl = "doc_id long, label int, terms array<int>, counts array<int>"
    sparse = materialize(texts.mapInArrow(vectors, ddl), "toxicity-vectors")
    often = np.argsort(-held, kind="stable")[:FREQUENT]
    rows = _rows(sparse, weighs, often)
    bare = rows.filter(pa.compute.equal(rows.column("norm"), 0.0)).column("label").to_pylist()
    weighed = sum(weight[x] for x in bare)
    no_term = (sum(weight[x] * x for x in bare) + SMOOTH * prior) / (weighed + SMOOTH)
    rows = rows.filter(pa.compute.greater(rows.column("norm"), 0.0)).sort_by([("leader", "ascending"), ("doc_id", "ascending")])
    sent.unpersist()
    if not rows.num_rows:
        return Model(words, weighs, None, prior, no_term)
    ids, labels_of = rows.column("doc_id").to_numpy(), rows.column("label").to_numpy().astype(np.int64)
    # At most the sample's rows.
    places = spark.createDataFrame(pa.table({"doc_id": ids, "row": np.arange(len(ids), dtype=np.int32)}))
    ordered = sparse.join(F.broadcast(places), "doc_id").select("row", "terms", "counts").repartitionByRange(SEGMENTS, "row").sortWithinPartitions("row")
    stored = materialize(ordered.mapInArrow(_packed, "first int, segment binary"), "toxicity-postings")
    # A few bytes for each posting of the sample.
    segments = stored.toArrow().sort_by("first").column("segment").to_pylist()
    weights = np.array([weight[x] for x in labels_of.tolist()])
    return Model(words, weighs, Stored(segments, held, rows.column("norm").to_numpy(), ids, labels_of, weights), prior, no_term)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, terms, counts) in the order of rows to a segment of postings for each batch, sorted by term and row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        row = np.repeat(batch.column("row").to_numpy(), pa.compute.list_value_length(batch.column("terms")).to_numpy())
        term, count = (batch.column(c).flatten().to_numpy() for c in ("terms", "counts"))
        order = np.argsort(term, kind="stable")
        out = pa.BufferOutputStream()
        pyarrow.parquet.write_table(pa.table({"term": term[order], "row": row[order], "count": count[order]}), out, compression="zstd")
        first = pa.array([row[0] if len(row) else 0], pa.int32())
        yield pa.RecordBatch.from_arrays([first, pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["first", "segment"])


def _chained(leaders: np.ndarray) -> np.ndarray:
    """The leaders in an order in which each comes behind the one it is most like, so that blocks alike are neighbours."""
    like = leaders @ leaders.T
    order, left = [0], set(range(1, len(leaders)))
    while left:
        order.append(max(left, key=lambda j: (like[order[-1], j], -j)))
        left.remove(order[-1])
    return leaders[order]


def _rows(sparse: DataFrame, weigh: np.ndarray, often: np.ndarray) -> pa.Table:
    """(doc_id, label, norm, leader) of every vector; the leader is the likest of some by the most frequent terms."""
    sent = sparse.sparkSession.sparkContext.broadcast((weigh, often))

    def dense(terms: np.ndarray, counts: np.ndarray, place: np.ndarray, weigh: np.ndarray, size: int) -> tuple[float, np.ndarray]:
        value = (1 + np.log(counts)) * weigh[terms]
        norm, row = float(np.sqrt(value @ value)), np.zeros(size, np.float32)
        inside = place[terms] >= 0
        row[place[terms[inside]]] = value[inside] / norm if norm else 0.0
        return norm, row

    def placed(weigh: np.ndarray, often: np.ndarray) -> np.ndarray:
        place = np.full(len(weigh), -1, np.int32)
        place[often] = np.arange(len(often))
        return place

    some = sparse.filter("size(terms) > 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LEADERS).select("terms", "counts").collect()
    place = placed(weigh, often)
    leaders = [dense(np.array(r["terms"]), np.array(r["counts"]), place, weigh, len(often))[1] for r in some]
    leaders = _chained(np.stack(leaders)) if leaders else np.zeros((1, len(often)), np.float32)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh, often = sent.value
        place = placed(weigh, often)
        for batch in batches:
            found = []
            for terms, counts in zip(batch.column("terms"), batch.column("counts")):
                norm, row = dense(terms.values.to_numpy(), counts.values.to_numpy(), place, weigh, len(often))
                found.append((norm, int((leaders @ row).argmax())))
            columns = [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *columns], names=["doc_id", "label", "norm", "leader"])

    # At most the sample's rows.
    found = sparse.mapInArrow(lead, "doc_id long, label int, norm double, leader int").toArrow()
    sent.unpersist()
    return found


NEW = ("score", "predicted", "evidence")


def score(docs: DataFrame, model: Model, text: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (1 from 0.5 on) and evidence.

    Evidence lists the neighbours: labelled doc_id, cosine, label. A text without
    a term of the labelled texts, null and empty ones too, has no neighbour and
    the rate of such labelled texts as its score. Rows are kept one by one, other columns
    pass through; columns called like the new ones are replaced.
    """
    docs = docs.drop(*NEW)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = ("index", _own_number(docs.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weighs, stored, prior, no_term = sent.value
        index, known = kept_by_worker(own, lambda: (stored.load(weighs) if stored is not None else None, _Terms(words)))
        seen = {}
        none = np.zeros(0), np.zeros(0, np.int64)

        def vector(term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
            if not len(term) or index is None:
                return None
            value = (1 + np.log(count)) * weighs[term]
            return term, value / np.linalg.norm(value)

        def neighbours(bodies: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
            for at in range(0, len(bodies), AT_ONCE):
                names = [xxhash.xxh128_digest(b or "") for b in bodies[at : at + AT_ONCE]]
                new = {name: b for name, b in zip(names, bodies[at : at + AT_ONCE]) if name not in seen}
                asked = {name: vector(*counted) for name, counted in zip(new, known.of(list(new.values())))}
                known_words = [q for q in asked.values() if q]
                found = iter(index.search(known_words, k) if known_words else [])
                seen.update({name: next(found) if q else None for name, q in asked.items()})
                yield from [seen[name] for name in names]
                if len(seen) > KEPT:
                    seen.clear()

        def value(found: tuple[np.ndarray, np.ndarray] | None) -> float:
            if found is None:
                return no_term
            votes = found[0] * index.weights[found[1]]
            return float((votes @ index.labels[found[1]] + SMOOTH * prior) / (votes.sum() + SMOOTH))

        for batch in slices(batches, text):
            got = list(neighbours(batch.column(batch.schema.get_field_index(text)).to_pylist()))
            values = np.array([value(g) for g in got], float)
            cosine, row = (np.concatenate(x) for x in zip(none, *(g for g in got if g)))
            ids, labels = (index.ids[row], index.labels[row]) if index else (row, row)
            parts = [pa.array(ids, pa.int64()), pa.array(cosine, pa.float64()), pa.array(labels.astype(np.int32))]
            ends = np.cumsum([0, *(len(g[0]) if g else 0 for g in got)])
            evidence = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, names=["doc_id", "cosine", "label"]))
            new = [pa.array(values), pa.array((values >= 0.5).astype(np.int32)), evidence]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *NEW])

    ddl = "score double, predicted int, evidence array<struct<doc_id:long,cosine:double,label:int>>"
    return docs.mapInArrow(run, with_fields(docs.schema, ddl))
