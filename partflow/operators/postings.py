"""Keyword search for tables of questions, over an inverted index of the chunks.

A term holds no white space, so it is a substring of a text if and only if it is
a substring of one of the text's words. Terms are therefore matched against the
dictionary of the chunks' distinct words, by equal 3-character pieces and not
pair by pair, and the matches lead through postings to the chunks.

Words that many chunks hold would make long postings. They say the same of all
chunks that have the same such words, so chunks with equal sets of common words
(of those that any term matches) are one *class*: common words lead to classes
and only the others to chunks. A chunk without a rare hit scores what its class scores, so the first ``top_k``
chunks of the best ``top_k`` classes are all that can be found besides the
chunks with rare hits. A term may also be in many rare words, a different one in
every chunk (a part's own "item_7"): chunks are told apart by such terms as they
are by common words. Where every term of a question is found, the texts
themselves are looked at for the whole phrase.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.functions.text import words
from partflow.session import growing, materialize

#: Characters of the pieces that terms and words meet on.
PIECE = 3
#: A word is common if at least one chunk in so many holds it.
COMMON = 64
BODY = -1


class ChunkIndex(NamedTuple):
    """Words of the chunks and where they are; all are tables."""

    words: DataFrame  # word, common
    postings: DataFrame  # word, id, field
    keys: DataFrame  # id, kind, seq


class Classes(NamedTuple):
    """The part of an index that some words lead to, by classes of chunks."""

    rare: DataFrame  # word, id, field
    common: DataFrame  # word, class, field
    members: DataFrame  # id, kind, seq, class


def searched(chunks: DataFrame) -> DataFrame:
    """Key and order of the chunks, and what is searched, in lower case."""
    return chunks.select(
        "id",
        "kind",
        "seq",
        F.concat(F.lower("text"), F.lit(" "), F.lower("metadata_json")).alias("_body"),
        F.transform("string_values", F.lower).alias("_values"),
    )


def _pieces(text: Column, sizes: range) -> Column:
    """All substrings of ``text`` of these lengths, each once."""

    def of(n: int) -> Column:
        last = F.char_length(text) - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def chunk_index(chunks: DataFrame) -> ChunkIndex:
    """Index ``chunks`` (id, kind, seq, text, metadata_json, string_values).

    Words of the text and of the metadata as a whole are of field BODY, those of
    a metadata value of the value's number.
    """
    body = F.struct(F.lit(BODY).alias("field"), words(F.col("_body")).alias("w"))
    values = F.transform("_values", lambda v, i: F.struct(i.alias("field"), words(v).alias("w")))
    fields = F.concat(F.array(body), F.coalesce(values, F.array().cast("array<struct<field:int,w:array<string>>>")))
    held = searched(chunks).select("id", "kind", "seq", F.explode(fields).alias("f"))
    postings = materialize(held.select("id", F.col("f.field").alias("field"), F.explode("f.w").alias("word")).distinct(), "chunk-words")
    n = chunks.count()
    often = postings.select("word", "id").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    dictionary = materialize(often.select("word", (F.col("n") * COMMON >= n).alias("common")), "chunk-dictionary")
    return ChunkIndex(dictionary, postings, chunks.select("id", "kind", "seq"))


def chunk_classes(index: ChunkIndex, used: DataFrame) -> Classes:
    """Classes by those common words that are ``used`` (word); rare ones keep their postings."""
    marked = index.postings.join(growing(index.words.join(growing(used), "word", "left_semi")), "word")
    marked = materialize(marked.select("word", "id", "field", "common"), "used-words")
    # Some of a chunk's own words; no larger than its text.
    classes = marked.filter("common").groupBy("id").agg(_named("field", "word").alias("class"))
    members = materialize(index.keys.join(growing(classes), "id", "left").fillna("", ["class"]), "chunk-classes")
    one_each = members.groupBy("class").agg(F.min("id").alias("id"))
    common = marked.filter("common").join(growing(one_each), "id").select("word", "class", "field")
    return Classes(marked.filter("not common").select("word", "id", "field"), materialize(common, "class-words"), members)


def _named(field: str, text: str) -> Column:
    """A name for a set of texts in fields."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(F.concat(field, F.lit(" "), text))), "\n"), 256)


class Hits(NamedTuple):
    """Where terms are found: by chunks, by classes, and the chunks of the classes; all are tables."""

    rare: DataFrame  # term, field, id, class
    common: DataFrame  # term, field, class
    members: DataFrame  # id, kind, seq, class


def term_hits(classes: Classes, matches: DataFrame) -> Hits:
    """Hits of the ``matches`` (term, word); terms that at least one chunk in COMMON has in rare words make classes too."""
    common = materialize(matches.join(growing(classes.common), "word").select("term", "field", "class").distinct(), "class-hits")
    rare = matches.join(growing(classes.rare), "word").select("term", "field", "id").distinct()
    rare = rare.join(growing(classes.members.select("id", "class")), "id")
    # A field that the class scores already is not scored again.
    rare = rare.join(growing(common), ["term", "field", "class"], "left_anti").select("term", "field", "id", F.col("class").alias("old"))
    rare, n = materialize(rare, "rare-hits"), classes.members.count()
    often = rare.groupBy("term", "field").agg(F.count(F.lit(1)).alias("n"))
    # No more than COMMON for every term that a chunk has on average.
    wide = growing(materialize(often.filter(F.col("n") * COMMON >= n).select("term", "field"), "wide-terms"))
    widely = rare.join(wide, ["term", "field"], "left_semi")

    more = widely.groupBy("id").agg(_named("field", "term").alias("more"))
    whole = F.when(F.col("more").isNull(), F.col("old")).otherwise(F.sha2(F.concat_ws("\n", "old", "more"), 256))
    members = classes.members.withColumnRenamed("class", "old").join(growing(more), "id", "left")
    members = materialize(members.select("id", "kind", "seq", "old", whole.alias("class")), "term-classes")
    one_each = members.groupBy("class").agg(F.min(F.struct("id", "old")).alias("one")).select("class", "one.*")
    inherited = common.withColumnRenamed("class", "old").join(growing(one_each.select("class", "old")), "old").select("term", "field", "class")
    added = widely.select("term", "field", "id").join(growing(one_each.select("class", "id")), "id").select("term", "field", "class")
    common = materialize(inherited.unionByName(added), "term-class-hits")
    rest = rare.join(wide, ["term", "field"], "left_anti").select("term", "field", "id")
    return Hits(rest.join(growing(members.select("id", "class")), "id"), common, members.drop("old"))


def matched_words(terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(term, word) where the term is a substring of the word, for distinct terms and words.

    They meet on a piece: the term itself if it is short, else its piece that
    the fewest words hold.
    """
    held = dictionary.select("word", F.explode(_pieces(F.col("word"), range(1, PIECE + 1))).alias("piece"))
    short = terms.filter(F.char_length("term") <= PIECE).select("term", F.col("term").alias("piece"))
    parts = terms.filter(F.char_length("term") > PIECE).select("term", F.explode(_pieces(F.col("term"), range(PIECE, PIECE + 1))).alias("piece"))
    counts = held.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    rarest = parts.join(growing(counts), "piece", "left").groupBy("term").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("best"))
    keyed = short.unionByName(rarest.filter("best.n > 0").select("term", "best.piece"))
    return keyed.join(growing(held), "piece").filter(F.contains("word", "term")).select("term", "word")


def _points(hits: DataFrame, *keys: str) -> DataFrame:
    """Points of the distinct (term, ..., field) hits, and whether the body is hit."""
    in_body = F.col("field") == BODY
    points = F.when(in_body, F.lit(1)).otherwise(F.lit(fv.METADATA_BONUS))
    return hits.groupBy("term", *keys).agg(F.sum(points).alias("points"), F.max(in_body.cast("int")).alias("bodies"))


def question_points(index: ChunkIndex, chunks: DataFrame, questions: DataFrame, top_k: int) -> DataFrame:
    """(qid, id, kind, seq, points, n) of every pair that can be among a question's best ``top_k`` with points.

    ``questions`` is a table of qid (a number), phrase (the question in lower case) and terms.
    """
    asked = materialize(questions.select("qid", F.size("terms").alias("n"), F.explode("terms").alias("term")), "question-terms")
    terms = asked.select("term").distinct()
    matches = materialize(matched_words(terms, index.words.select("word")), "term-words")

    classes = term_hits(chunk_classes(index, matches.select("word").distinct()), matches)

    def summed(points: DataFrame, *keys: str) -> DataFrame:
        return asked.join(growing(points), "term").groupBy("qid", "n", *keys).agg(F.sum("points").alias("points"), F.sum("bodies").alias("bodies"))

    by_class = materialize(summed(_points(classes.common, "class"), "class"), "class-points")
    above = by_class.select("qid", "class", F.col("points").alias("more"), F.col("bodies").alias("others"))
    total = [(F.col(a) + F.coalesce(b, F.lit(0))).alias(a) for a, b in (("points", "more"), ("bodies", "others"))]
    single = materialize(summed(_points(classes.rare, "id", "class"), "id", "class").join(growing(above), ["qid", "class"], "left").select("qid", "n", "id", *total), "chunk-points")

    # Chunks where every term is found may hold the whole phrase.
    whole = by_class.filter("bodies = n").join(growing(classes.members.select("id", "class")), "class").select("qid", "n", "id", "points", "bodies")
    pairs = single.unionByName(whole.join(growing(single), ["qid", "id"], "left_anti"))
    bonus = F.when(F.contains("_body", "phrase"), F.lit(fv.PHRASE_BONUS)).otherwise(F.lit(0))
    texts = searched(chunks).select("id", "_body")
    full = pairs.filter("bodies = n").join(growing(questions.select("qid", "phrase")), "qid").join(growing(texts), "id")
    full = full.select("qid", "n", "id", (F.col("points") + bonus).alias("points"))
    pairs = pairs.filter("bodies < n").select("qid", "n", "id", "points").unionByName(full)

    # Of the others, the first chunks of the best classes.
    in_class = Window.partitionBy("class").orderBy("kind", "seq")
    heads = classes.members.withColumn("at", F.row_number().over(in_class)).filter(F.col("at") <= top_k)
    first = heads.filter("at = 1").select("class", "kind", "seq")
    ranked = by_class.join(growing(first), "class").withColumn("at", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("points"), "kind", "seq")))
    best = ranked.filter(F.col("at") <= top_k).select("qid", "n", "points", "class")
    usual = best.join(growing(heads.select("class", "id", "kind", "seq")), "class").select("qid", "n", "id", "kind", "seq", "points")
    return pairs.join(growing(classes.members.select("id", "kind", "seq")), "id").select(*usual.columns).unionByName(usual)
