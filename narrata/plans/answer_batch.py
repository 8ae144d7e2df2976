"""A table of questions to hits, contexts, prompts, answers and sources, as one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.operators import answer
from narrata.operators.embed import Encoder, embed, hashing_encoder
from narrata.operators.nearest import nearest
from narrata.params import JobParams

HIT_COLUMNS = ["chunk_text", "product", "issue", "company"]


def retrieve(
    stored: DataFrame,
    questions: DataFrame,
    k: int = 5,
    encoder: Callable[[], Encoder] | None = None,
    metric: str = "l2",
    question_filter: str | None = None,
    filter_col: str = "product",
) -> DataFrame:
    """Ranked hits with text and metadata for rows of (question_id, question).

    Questions that bring a ``question_embedding`` keep it; the others are embedded here. A column
    named by ``question_filter`` narrows the search per question.
    """
    questions = answer.check_questions(questions)
    if "question_embedding" in questions.columns:
        # The vector depends on the check, so that a blank question fails though its text is not searched.
        checked = F.when(F.col("question").isNotNull(), F.col("question_embedding"))
        questions = questions.withColumn("question_embedding", checked)
    if "question_embedding" not in questions.columns:
        factory = encoder or hashing_encoder()
        questions = questions.withColumn("question_embedding", embed(F.col("question"), factory))
    return nearest(
        stored, questions, k, metric,
        filter_col=filter_col if question_filter else None,
        question_filter=question_filter,
        payload=HIT_COLUMNS,
    )


def answer_batch(
    stored: DataFrame,
    questions: DataFrame,
    params: JobParams,
    supplied: DataFrame | None = None,
    encoder: Callable[[], Encoder] | None = None,
    template: str = "default",
    organisation: str = "the company",
    question_filter: str | None = None,
) -> DataFrame:
    """Answer, prompt, context and sources per question.

    Text generation is outside: ``supplied`` brings finished answers by question id, and the prompt
    column is what a generator would be given.
    """
    factory = encoder or hashing_encoder(params.embedding_dim)
    hits = retrieve(stored, questions, params.top_k, factory, question_filter=question_filter)
    answered = answer.assemble_answers(questions, hits, supplied, params.max_context)
    return answer.prompts(answered, template, organisation)
