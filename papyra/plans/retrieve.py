"""Questions to prompts over the gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from papyra.operators.context import contexts, prompts
from papyra.operators.embed import embed_terms
from papyra.operators.knn import knn

# Columns a prompt cites, and hits per question.
CITED = ["chunk_text", "title", "authors", "doi", "dt_publicacao", "journal_name"]
HITS = 4


def question_hits(
    gold: DataFrame, questions: DataFrame, k: int = HITS, columns: list[str] | None = None
) -> DataFrame:
    """Ranked hits per question; ``questions`` has ``query_id, question``."""
    asked = embed_terms(questions, "question", "query_vector")
    return knn(gold, asked, k, ["cord_uid", "chunk_no"], columns=columns or CITED)


def question_prompts(gold: DataFrame, questions: DataFrame, instructions: str, k: int = HITS) -> DataFrame:
    """One citable prompt per question, headed by the caller's ``instructions``."""
    return prompts(questions, contexts(question_hits(gold, questions, k)), instructions)
