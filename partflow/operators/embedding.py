"""Text embeddings: sparse TF-IDF vectors over a dictionary of all terms.

The dictionary is a table: every term has a number of its own (its place in the
order of terms), so unrelated terms never share a dimension, and the weight that
its document frequency gives it. A vector is the list of a text's terms, of unit
length. Vectors meet through their terms: a search joins the questions' terms
with the rows' and adds up products, so only rows that share a term with a
question are looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.operators.ordering import with_positions
from partflow.session import broadcast_within, growing, materialize

#: Digits of a cosine that count in the order of hits.
DIGITS = 9
#: A term that at least one text in so many has is common,
COMMON = 256
#: and this many of the most common ones are sent to every task.
SENT_TERMS = 50_000
#: Vector entries of a request that are sent to the rows.
SENT_ENTRIES = 100_000
VECTOR = "array<struct<term:long,weight:double>>"


class Embedder(NamedTuple):
    """term, number and idf of every term, and the number of texts."""

    dictionary: DataFrame
    texts: int


def tokens(text: Column) -> Column:
    """Runs of letters and digits in lower case; none for a null text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def text_embedder(rows: DataFrame, text: str = "text") -> Embedder:
    """Count in how many of all texts each term is, and number the terms."""
    n = rows.count()
    often = rows.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("texts"))
    idf = F.log(F.lit(float(n + 1)) / (F.col("texts") + 1))
    numbered = with_positions(often, [], ["term"], "number").select("term", F.col("number").cast("long").alias("number"), idf.alias("idf"))
    return Embedder(materialize(numbered, "dictionary"), n)


def numbered_terms(counts: DataFrame, embedder: Embedder) -> DataFrame:
    """``counts`` with number and idf of the terms that weigh something.

    A term that one text in COMMON has would meet all its rows in one task: such
    terms, few as they are, are sent to the rows. Only the rows of others are shuffled.
    """
    known = embedder.dictionary.filter("idf > 0")
    often = F.log(F.lit(float(embedder.texts + 1)) / (F.lit(embedder.texts / COMMON) + 1))
    common = known.filter(F.col("idf") <= often).orderBy("idf", "number").limit(SENT_TERMS)
    common = F.broadcast(materialize(common, "common-terms"))
    rest = counts.join(common.select("term"), "term", "left_anti").join(growing(known), "term")
    return counts.join(common, "term").unionByName(rest)


def embed(rows: DataFrame, embedder: Embedder, key: str = "id", text: str = "text") -> DataFrame:
    """Append ``embedding``: (term, weight) by term, of unit length.

    ``key`` identifies a row. Terms that are not in the dictionary, or that every
    text has, weigh nothing and are left out; a text of such terms, an empty or
    a null one has an empty vector.
    """
    counts = rows.select(key, F.explode(tokens(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))
    found = numbered_terms(counts, embedder)
    weighed = found.select(key, F.struct(F.col("number").alias("term"), (F.col("n") * F.col("idf")).alias("weight")).alias("part"))
    # As long as the text has distinct terms.
    lists = weighed.groupBy(key).agg(F.array_sort(F.collect_list("part")).alias("_parts"))
    length = F.sqrt(F.aggregate("_parts", F.lit(0.0), lambda t, p: t + p["weight"] * p["weight"]))
    # The length goes next to every part: named inside the function it would be summed up again for each.
    lengths = F.array_repeat(length, F.size("_parts"))
    unit = F.zip_with("_parts", lengths, lambda p, whole: F.struct(p["term"].alias("term"), (p["weight"] / whole).alias("weight")))
    vectors = lists.select(key, unit.alias("embedding"))
    joined = rows.drop("embedding").join(growing(vectors), key, "left")
    return joined.withColumn("embedding", F.coalesce("embedding", F.array().cast(VECTOR)))


def embed_questions(questions: Sequence[str], embedder: Embedder) -> DataFrame:
    """(qid, question, embedding) of a request's questions."""
    spark = embedder.dictionary.sparkSession
    asked = spark.createDataFrame(list(enumerate(questions)), "qid int, question string")
    return embed(asked, embedder, "qid", "question")


def cosine_search(embedded: DataFrame, asked: DataFrame, top_k: int = fv.TOP_K_DEFAULT, key: str = "id", where: Column | None = None) -> DataFrame:
    """Rows of the largest cosine for each of ``asked`` (qid, embedding): qid, rank, key, cosine.

    Ties go to the smaller key. Rows without a common term are no hits. ``where``
    is a metadata filter that is applied before ranking.
    """
    rows = embedded if where is None else embedded.filter(where)
    held = rows.select(key, F.inline("embedding")).withColumnRenamed("weight", "_w")
    terms = materialize(asked.select("qid", F.inline("embedding")), "question-terms")
    pairs = held.join(broadcast_within(terms, terms, SENT_ENTRIES), "term")
    cosines = pairs.groupBy("qid", key).agg(F.round(F.sum(F.col("weight") * F.col("_w")), DIGITS).alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("cosine"), key))
    return cosines.withColumn("rank", rank).filter(F.col("rank") <= top_k).select("qid", "rank", key, "cosine")
