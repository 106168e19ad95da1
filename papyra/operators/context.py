"""Search hits to citable contexts and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.functions.text import year_label

# Labels of a citation block and the line that ends it.
RULE = "-" * 25


def or_na(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("N/A"))


def citation_block() -> Column:
    """The text block of one hit; missing citation fields read ``N/A``."""
    return F.concat(
        F.lit("SOURCE: "), or_na("title"),
        F.lit("\nAUTHORS: "), or_na("authors"),
        F.lit("\nJOURNAL: "), or_na("journal_name"),
        F.lit(" ("), year_label("dt_publicacao"), F.lit(")"),
        F.lit("\nDOI: "), or_na("doi"),
        F.lit("\nCONTENT: "), or_na("chunk_text"),
        F.lit(f"\n{RULE}"),
    )


def contexts(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """One context per query from its ranked hits; a group has at most k rows."""
    blocks = hits.select(query_id, F.struct("rank", citation_block().alias("block")).alias("b"))
    ordered = F.array_sort(F.collect_list("b"))
    return blocks.groupBy(query_id).agg(
        F.array_join(F.transform(ordered, lambda b: b["block"]), "\n").alias("context")
    )


def prompts(
    questions: DataFrame,
    context: DataFrame,
    instructions: str,
    query_id: str = "query_id",
    question: str = "question",
) -> DataFrame:
    """Instructions, context and question as one text per question."""
    text = F.concat(
        F.lit(f"{instructions}\n\nCONTEXT:\n"),
        F.coalesce("context", F.lit("")),
        F.lit("\n\nQUESTION: "),
        F.col(question),
        F.lit("\n\nANSWER:"),
    )
    return questions.join(context, query_id, "left").select(query_id, text.alias("prompt"))


def hits_json(hits: DataFrame, columns: list[str], query_id: str = "query_id") -> DataFrame:
    """The requested columns of each hit as JSON text."""
    return hits.select(query_id, "rank", F.to_json(F.struct(*columns)).alias("hit"))
