"""Answers assembled from retrieved chunks.

Hits are grouped per question; a group has at most TOP_K_MAX rows, so the list
of a group is small by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow import fixed_values as fv
from partflow.functions.text import fill, join_lines, pick_lines, strip
from partflow.operators.embedding import Embedder, cosine_search, embed_questions
from partflow.operators.narrate import MODEL_SOURCE, PART_SOURCE
from partflow.operators.retrieve import (
    hits_with_text,
    keyword_search,
    keyword_search_table,
    question_intent,
)
from partflow.session import growing


def group_hits(hits: DataFrame) -> DataFrame:
    """One row per question with its hits in rank order."""
    meta = F.col("metadata")
    hit = F.struct(
        F.col("rank"),
        F.col("id"),
        F.col("text"),
        F.col("source"),
        F.coalesce(meta["part_number"], F.lit("Unknown")).alias("part"),
        F.coalesce(meta["demand_type"], F.lit("Unknown")).alias("demand_type"),
        F.coalesce(meta["trend"], F.lit("Unknown")).alias("trend"),
        F.coalesce(meta["stockout_risk"], F.lit("UNKNOWN")).alias("risk"),
    )
    ordered = F.sort_array(F.collect_list(hit))
    return hits.groupBy("qid", "question").agg(ordered.alias("hits"))


def _is_part(hit: Column) -> Column:
    return hit["source"] == PART_SOURCE


def _each(hits: Column, one) -> Column:
    """The texts that ``one`` makes of the hits, in order, as one text."""
    return F.array_join(F.transform(hits, one), "")


def _opening(intent: str) -> Column:
    return F.lit(fv.ANSWER_OPENINGS[intent] + "\n\n")


def _at_level(parts: Column, level: str, named: list[str]) -> Column:
    """Parts of a risk level; LOW also takes whatever is not named."""
    if level in named:
        return F.filter(parts, lambda h: h["risk"] == level)
    return F.filter(parts, lambda h: ~h["risk"].isin(*named))


def _risk(hits: Column) -> Column:
    parts = F.filter(hits, _is_part)
    named = [level for level, _ in fv.RISK_GROUPS if level != "LOW"]
    pieces = [_opening("risk")]
    for level, title in fv.RISK_GROUPS:
        group = _at_level(parts, level, named)
        lines = _each(
            group,
            lambda h: fill("  - {p} ({d}, trend: {t})\n", p=h["part"], d=h["demand_type"], t=h["trend"]),
        )
        pieces.append(F.when(F.size(group) > 0, F.concat(F.lit(title + "\n"), lines, F.lit("\n"))).otherwise(F.lit("")))
    pieces.append(F.when(F.size(parts) == 0, F.lit(fv.RISK_NONE + "\n\n")).otherwise(F.lit("")))
    pieces.append(F.lit(fv.RISK_DETAILS + "\n"))
    first_two = F.filter(F.slice(hits, 1, 2), _is_part)
    pieces.append(_each(first_two, lambda h: join_lines(pick_lines(h["text"], fv.RISK_LINE_WORDS))))
    return F.concat(*pieces)


def _forecast(hits: Column) -> Column:
    def one(h: Column) -> Column:
        lines = join_lines(pick_lines(h["text"], fv.FORECAST_LINE_WORDS))
        return (
            F.when(h["source"] == MODEL_SOURCE, F.concat(h["text"], F.lit("\n\n")))
            .when(_is_part(h), lines)
            .otherwise(F.lit(""))
        )

    return F.concat(_opening("forecast"), _each(hits, one))


def _compare(hits: Column) -> Column:
    def one(h: Column) -> Column:
        lines = F.filter(F.split(h["text"], "\n"), lambda s: (strip(s) != "") & ~strip(s).startswith("Part "))
        head = fill("--- {p} ({d}) ---\n", p=h["part"], d=h["demand_type"])
        return F.concat(head, join_lines(lines), F.lit("\n"))

    return F.concat(_opening("compare"), _each(F.filter(hits, _is_part), one))


def _recommend(hits: Column) -> Column:
    return F.concat(
        _opening("recommend"), _each(hits, lambda h: join_lines(pick_lines(h["text"], fv.RECOMMEND_LINE_WORDS)))
    )


def _trend(hits: Column) -> Column:
    def one(h: Column) -> Column:
        return F.concat(h["part"], F.lit(":\n"), join_lines(pick_lines(h["text"], fv.TREND_LINE_WORDS)), F.lit("\n"))

    return F.concat(_opening("trend"), _each(F.filter(hits, _is_part), one))


def _general(hits: Column) -> Column:
    def one(h: Column) -> Column:
        head = F.when(_is_part(h), fill("--- {p} ---\n", p=h["part"])).otherwise(F.lit(""))
        return F.concat(head, F.substring(h["text"], 1, 500), F.lit("\n\n"))

    return F.concat(_opening("general"), _each(F.slice(hits, 1, 3), one))


def answer_text(question: Column, hits: Column) -> Column:
    """The answer by the intent of the question."""
    intent = question_intent(question)
    return (
        F.when(F.coalesce(F.size(hits), F.lit(0)) <= 0, F.lit(fv.ANSWER_EMPTY))
        .when(intent == "risk", _risk(hits))
        .when(intent == "forecast", _forecast(hits))
        .when(intent == "compare", _compare(hits))
        .when(intent == "recommend", _recommend(hits))
        .when(intent == "trend", _trend(hits))
        .otherwise(_general(hits))
    )


def context_text(hits: Column) -> Column:
    """The texts of the hits in rank order, a rule between them."""
    return F.array_join(F.transform(hits, lambda h: h["text"]), fv.CONTEXT_RULE)


def prompt_text(question: Column, context: Column) -> Column:
    """The prompt a language model would get: rules, context, question."""
    return fill(fv.PROMPT_TEMPLATE, context=context, question=question)


def _with_hits(hits: DataFrame, questions: Sequence[str]) -> DataFrame:
    """Every question gets a row, also one that nothing was found for."""
    asked = hits.sparkSession.createDataFrame(list(enumerate(questions)), "qid int, question string")
    return asked.join(group_hits(hits).select("qid", "hits"), "qid", "left")


def _answers(rows: DataFrame, *keys: str) -> DataFrame:
    """Answers of rows with question and hits."""
    sources = F.coalesce(F.transform("hits", lambda h: h["id"]), F.array().cast("array<string>"))
    return rows.select(
        *keys,
        "question",
        answer_text(F.col("question"), F.col("hits")).alias("answer"),
        sources.alias("sources"),
        F.size(sources).alias("num_sources"),
    )


def _answer(hits: DataFrame, questions: Sequence[str]) -> DataFrame:
    return _answers(_with_hits(hits, questions), "qid")


def answer_questions(chunks: DataFrame, questions: Sequence[str], top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
    """Keyword search, then one answer row per question."""
    hits = hits_with_text(keyword_search(chunks, questions, top_k), chunks, questions, top_k)
    return _answer(hits, questions)


def answer_table(chunks: DataFrame, questions: DataFrame, text: str, top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
    """One answer row per row of a table of questions, next to its other columns.

    The table may have any number of rows: it stays in Spark, and every distinct
    question is answered once. A null question is an empty one.
    """
    keys = [name for name in questions.columns if name != text]
    asked = questions.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("question"))
    each = asked.select("question").distinct()
    hits = keyword_search_table(chunks, each, top_k).withColumn("question", F.col("qid"))
    grouped = group_hits(hits.join(growing(chunks.select("id", "text", "source", "metadata")), "id")).select("question", "hits")
    answers = _answers(each.join(growing(grouped), "question", "left"))
    return asked.join(growing(answers), "question").select(*keys, "question", "answer", "sources", "num_sources")


def answer_by_vectors(
    embedded: DataFrame, questions: Sequence[str], embedder: Embedder, top_k: int = fv.TOP_K_DEFAULT
) -> DataFrame:
    """Search by the cosine of embedded chunks, then the same answers."""
    hits = cosine_search(embedded, embed_questions(questions, embedder), top_k)
    return _answer(hits_with_text(hits, embedded, questions, top_k), questions)


def context_and_prompt(chunks: DataFrame, questions: Sequence[str], top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
    """Context and prompt per question, the hand-off to a language model.

    A question that nothing was found for has an empty context.
    """
    hits = hits_with_text(keyword_search(chunks, questions, top_k), chunks, questions, top_k)
    rows = _with_hits(hits, questions)
    context = F.coalesce(context_text(F.col("hits")), F.lit(""))
    return rows.select("qid", "question", context.alias("context"), prompt_text(F.col("question"), context).alias("prompt"))
