"""Keyword and vector top-k search for a request's questions.

A request is a short list of questions, as it comes from a caller. It travels
inside the projection as a literal, so every chunk is scored where it lies: one
scan per PASS_SIZE questions, whatever the number of chunks. Only the best k
rows per question and input partition leave a task. Longer requests take
further passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from partflow import fixed_values as fv
from partflow.functions.text import contains_any, words
from partflow.operators.evaluate import stack
from partflow.operators.postings import chunk_index, question_points, searched
from partflow.session import growing, materialize

PASS_SIZE = 64
# Vectors that are scored together.
SCORED = 4096
# Hits up to this many rows are broadcast to the chunks.
BROADCAST_HITS = 100_000


def query_terms(question: Column) -> Column:
    """Distinct lower-cased words without stop words; punctuation stays."""
    return F.array_except(F.array_distinct(words(F.lower(question))), F.array(*[F.lit(w) for w in fv.STOP_WORDS]))


def question_intent(question: Column) -> Column:
    """The first intent one of whose words is a substring of the question."""
    intent = F
    for name, hints in fv.INTENT_WORDS:
        intent = intent.when(contains_any(question, hints), F.lit(name))
    return intent.otherwise(F.lit(fv.INTENT_OTHER))


def check_top_k(top_k: int) -> int:
    """The bound of a service request; a search itself takes any number."""
    if not fv.TOP_K_MIN <= top_k <= fv.TOP_K_MAX:
        raise ValueError(f"top_k must be within {fv.TOP_K_MIN}..{fv.TOP_K_MAX}")
    return top_k


def _passes(items: Sequence) -> list[list[tuple[int, object]]]:
    if not items:
        raise ValueError("a request has at least one question")
    numbered = list(enumerate(items))
    return [numbered[i : i + PASS_SIZE] for i in range(0, len(numbered), PASS_SIZE)]


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _terms_of(question: str) -> list[str]:
    return [w for w in dict.fromkeys(question.lower().split()) if w not in fv.STOP_WORDS]


def _best(scored: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Rank within each question and keep k; limited map-side before the shuffle."""
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def _score(question: Column) -> Column:
    """The score of a prepared chunk for a question: a struct of phrase and terms."""

    def term_points(total: Column, term: Column) -> Column:
        in_body = F.contains(F.col("_body"), term).cast("int")
        in_values = F.size(F.filter("_values", lambda v: F.contains(v, term)))
        return total + in_body + fv.METADATA_BONUS * in_values

    phrase = F.when(F.contains(F.col("_body"), question["phrase"]), F.lit(fv.PHRASE_BONUS)).otherwise(F.lit(0))
    points = F.aggregate(question["terms"], phrase, term_points)
    n = F.size(question["terms"])
    return F.when(n > 0, points / n).otherwise(F.lit(0.0))


def keyword_scores(chunks: DataFrame, numbered: list[tuple[int, str]], wanted: Callable[[Column], Column]) -> DataFrame:
    """Scores of the chunks for each question of one pass, if ``wanted``; texts stay behind."""
    asked = F.array(
        *[
            F.struct(F.lit(i).alias("qid"), F.lit(q.lower()).alias("phrase"), _strings(_terms_of(q)).alias("terms"))
            for i, q in numbered
        ]
    )
    scored = F.transform(asked, lambda q: F.struct(q["qid"].alias("qid"), _score(q).alias("score")))
    kept = F.filter(scored, lambda s: wanted(s["score"]))
    return searched(chunks).select("id", "kind", "seq", F.explode(kept).alias("_s")).select("id", "kind", "seq", "_s.*")


def keyword_search(chunks: DataFrame, questions: Sequence[str], top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
    """Best chunks per question: ``qid``, ``rank``, ``id``, ``score``.

    Equal scores keep the order of the chunks; a question without terms gets
    the first chunks. A chunk without points can only be found if it is among
    the first ``top_k``, so pairs without points are made for those alone.
    """
    order = [F.desc("score"), F.col("kind"), F.col("seq")]
    first = chunks.orderBy("kind", "seq").limit(top_k)
    found = []
    for p in _passes(questions):
        hits = keyword_scores(chunks, p, lambda s: s > 0).unionByName(keyword_scores(first, p, lambda s: s <= 0))
        found.append(_best(hits, top_k, order))
    return stack(found).select("qid", "rank", "id", "score")


def keyword_search_table(chunks: DataFrame, questions: DataFrame, top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
    """``keyword_search`` for a table of any number of distinct questions (column ``question``, not null).

    Questions and chunks meet through an inverted index (``postings``), so the
    work grows with the hits and not with all pairs; nothing is collected but
    the first ``top_k`` chunks. The ``qid`` of a hit is the question itself.
    """
    order = [F.desc("score"), F.col("kind"), F.col("seq")]
    terms = query_terms(F.col("question"))
    # Numbered in a table, so that all jobs see the same numbers.
    asked = questions.select(F.monotonically_increasing_id().alias("qid"), "question", F.lower("question").alias("phrase"), terms.alias("terms"))
    asked = materialize(asked, "questions")
    found = question_points(chunk_index(chunks), chunks, asked, top_k)
    # At most top_k rows: what a question gets that has no points anywhere.
    first = chunks.orderBy("kind", "seq").limit(top_k).select("id", "kind", "seq").collect()
    bare = F.array(*[F.struct(*[F.lit(x).cast(chunks.schema[c].dataType).alias(c) for c, x in r.asDict().items()]) for r in first])
    if first:
        none = asked.select("qid", F.size("terms").alias("n"), F.inline(bare)).withColumn("points", F.lit(0).cast("long"))
        found = found.unionByName(none.select(*found.columns))
    best = found.groupBy("qid", "n", "id", "kind", "seq").agg(F.max("points").alias("points"))
    score = F.when(F.col("n") > 0, F.col("points") / F.col("n")).otherwise(F.lit(0.0))
    hits = _best(best.withColumn("score", score), top_k, order).select("qid", "rank", "id", "score")
    return hits.join(growing(asked.select("qid", "question")), "qid").select(F.col("question").alias("qid"), "rank", "id", "score")


def vector_search(
    vectors: DataFrame,
    queries: Sequence[Sequence[float]],
    top_k: int = fv.TOP_K_DEFAULT,
    key: str = "id",
    vector: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """Exact nearest rows by squared distance, ties by key.

    Vectors are scored in blocks against all queries of a pass, and only the
    best ``top_k`` rows per query leave a block. ``where`` is a metadata filter
    that is applied before ranking. Rows whose vector is null, has another length
    than a query, or lacks a component are no hits of it.
    """
    rows = vectors if where is None else vectors.filter(where)
    full = rows.filter(F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull()))
    full = full.select(key, F.col(vector).cast("array<double>").alias("_v"))
    schema = StructType([StructField("qid", IntegerType()), full.schema[key], StructField("distance", DoubleType())])
    found = []
    for numbered in _passes(queries):
        best = full.mapInArrow(lambda batches, asked=numbered: _nearest(batches, asked, top_k, key), schema)
        found.append(_best(best, top_k, [F.col("distance"), F.col(key)]))
    return stack(found).select("qid", "rank", key, "distance")


def _nearest(batches: Iterator[pa.RecordBatch], asked: list, top_k: int, key: str) -> Iterator[pa.RecordBatch]:
    """The ``top_k`` rows of each block of SCORED vectors for every query."""
    queries = [(i, np.asarray(q, float)) for i, q in asked]
    for batch in (part.slice(at, SCORED) for part in batches for at in range(0, part.num_rows, SCORED)):
        size = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
        for length in sorted({len(q) for _, q in queries}):
            at = pa.array(np.flatnonzero(size == length))
            keys, x = batch.column(0).take(at), pc.list_flatten(batch.column(1).take(at)).to_numpy(zero_copy_only=False).reshape(len(at), length)
            for i, q in queries:
                if len(q) == length and len(at):
                    far = ((x - q) ** 2).sum(1)
                    sorted_ = pc.sort_indices(pa.table({"d": far, "k": keys}), sort_keys=[("d", "ascending"), ("k", "ascending")])[:top_k]
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(sorted_), pa.int32()), keys.take(sorted_), pa.array(far).take(sorted_)], names=["qid", key, "distance"])


def hits_with_text(hits: DataFrame, chunks: DataFrame, questions: Sequence[str], top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
    """Join the found chunks' texts and metadata to the hits.

    ``hits`` holds at most ``top_k`` rows per question of the request. While
    that is within BROADCAST_HITS rows it is sent to the chunks; a longer
    request is joined by key.
    """
    asked = chunks.sparkSession.createDataFrame(list(enumerate(questions)), "qid int, question string")
    few = len(questions) * top_k <= BROADCAST_HITS
    found = chunks.select("id", "text", "source", "metadata").join(F.broadcast(hits) if few else hits, "id")
    return found.join(F.broadcast(asked) if len(questions) <= BROADCAST_HITS else asked, "qid")
