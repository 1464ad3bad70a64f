"""Profiles to a knowledge base, and questions to answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from partflow import fixed_values as fv
from partflow.operators.answers import answer_by_vectors, answer_questions
from partflow.operators.narrate import assemble, domain_chunks, part_chunks, summary_chunk
from partflow.operators.profile import part_profiles
from partflow.operators.embedding import embed, text_embedder
from partflow.operators.retrieve import check_top_k
from partflow.plans.forecast import Forecast
from partflow.session import materialize
from partflow.sources.tables import write_chunks


def build_knowledge_base(forecast: Forecast, output_dir: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Chunks of all parts, of the model comparison and of the demand types.

    Written once: every search scans it, and the texts are costly to redo.
    """
    spark = forecast.features.sparkSession
    model = fv.SEASONAL_NAME if forecast.booster is None else fv.BOOSTED_NAME
    ranks = None if forecast.booster is None else forecast.booster.importances(spark)
    profiles = part_profiles(forecast.features, forecast.part_metrics, ties)
    chunks = assemble(
        part_chunks(profiles, model), summary_chunk(forecast.metrics, importances=ranks), domain_chunks(spark)
    )
    chunks = materialize(chunks, "chunks")
    if output_dir:
        write_chunks(chunks, f"{output_dir}/knowledge_base")
    return chunks


class QuestionService:
    """Answers batches of questions by keywords, or by vectors if embedded."""

    def __init__(self, chunks: DataFrame, vectors: bool = False):
        self.chunks = chunks
        self.embedder = None
        if vectors:
            self.embedder = text_embedder(chunks)
            self.chunks = materialize(embed(chunks, self.embedder), "embedded-chunks")

    def query(self, questions: Sequence[str], top_k: int = fv.TOP_K_DEFAULT) -> DataFrame:
        """One row per question: answer, sources, number of sources."""
        check_top_k(top_k)
        if self.embedder is None:
            return answer_questions(self.chunks, questions, top_k)
        return answer_by_vectors(self.chunks, questions, self.embedder, top_k)
