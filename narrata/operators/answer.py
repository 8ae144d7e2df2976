"""From hits to contexts, prompts, answers and sources. A hit is one row per (question, rank)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions.prompts import render
from narrata.functions.text import is_blank, strip
from narrata.params import require_columns

# --- fixed values: texts shown in place of an answer or a source ---
NO_HITS_ANSWER = "I don't have enough information in the provided context to answer this question."
FAILED_ANSWER = "I encountered an error while generating an answer. Please try again."
NO_SOURCES = "**No sources retrieved.**"
SOURCES_TITLE = "### 📚 Retrieved Sources\n"
UNKNOWN = "Unknown"
MIN_CUT_LENGTH = 100
# -------------------------------------------------------------------

SOURCE = "struct<rank:int,text:string,product:string,issue:string,company:string,distance:double>"


def check_questions(questions: DataFrame, question_col: str = "question") -> DataFrame:
    """The questions, with an error at run time for a blank or null one."""
    require_columns(questions, [question_col])
    bad = F.coalesce(is_blank(F.col(question_col)), F.lit(True))
    checked = F.when(bad, F.raise_error(F.lit("question cannot be empty"))).otherwise(
        F.col(question_col)
    )
    return questions.withColumn(question_col, checked)


def _given(column: str) -> Column:
    return F.coalesce(F.col(column) != "", F.lit(False))


def _with_shown_pieces(hits: DataFrame, max_length: int, text_col: str) -> DataFrame:
    """The hits with ``_shown``: what a hit adds to the context, null for a hit left out."""
    tag = F.concat(F.lit("[Document "), F.col("rank"), F.lit("]"))
    product = F.when(_given("product"), F.concat(F.lit(" Product: "), "product")).otherwise("")
    issue = F.when(_given("issue"), F.concat(F.lit(", Issue: "), "issue")).otherwise("")
    text = F.coalesce(F.col(text_col), F.lit(""))
    pieces = hits.select(
        "*",
        F.concat(tag, product).alias("_head"),
        F.concat(tag, product, issue, F.lit("\n"), text, F.lit("\n")).alias("_piece"),
        (F.length(tag) + F.lit(len("...\n"))).alias("_cut_cost"),
    )
    before = Window.partitionBy("question_id").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    used, room = F.col("_used"), F.col("_room")
    sized = pieces.withColumn(
        "_used", F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0))
    ).withColumn("_room", F.lit(max_length) - used - F.col("_cut_cost"))
    # A row after the overflow has used > max_length, so only the first overflow can be cut.
    fits = used + F.length("_piece") <= max_length
    cut = F.concat(
        "_head", F.lit("\n"), F.substring(text, F.lit(1), room.cast("int")), F.lit("...\n")
    )
    shown = F.when(fits, F.col("_piece")).when(
        (used <= max_length) & (room > MIN_CUT_LENGTH), cut
    )
    return sized.withColumn("_shown", shown)


def _joined_pieces() -> Column:
    parts = F.array_sort(F.collect_list(F.struct("rank", F.col("_shown").alias("piece"))))
    return F.array_join(F.transform(parts, lambda p: p["piece"]), "\n")


def pack_context(hits: DataFrame, max_length: int = 2000, text_col: str = "chunk_text") -> DataFrame:
    """One context per question: its hits in order of rank, up to ``max_length`` characters.

    The first hit that does not fit is cut to the room left when that is over 100 characters, and
    ends the context. The line breaks between hits are not counted.
    """
    shown = _with_shown_pieces(hits, max_length, text_col)
    return shown.groupBy("question_id").agg(_joined_pieces().alias("context"))


def prompts(
    contexts: DataFrame, template: str = "default", organisation: str = "the company", **values: str
) -> DataFrame:
    """Add the rendered prompt to rows of (question, context)."""
    filled = {"organisation": organisation, **values}
    text = render(template, context=F.col("context"), question=F.col("question"), **filled)
    return contexts.withColumn("prompt", text)


def shortened(text: Column, length: int) -> Column:
    """The text, cut with three dots only when it is longer."""
    head = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.when(F.length(text) > length, head).otherwise(text)


def _first_sources(limit: int, text_col: str) -> Column:
    named = [F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in ("product", "issue", "company")]
    source = F.struct(
        F.col("rank").cast("int").alias("rank"),
        shortened(F.col(text_col), 200).alias("text"),
        *named,
        F.col("distance").cast("double").alias("distance"),
    )
    return F.array_sort(F.collect_list(F.when(F.col("rank") <= limit, source)))


def sources(hits: DataFrame, limit: int = 3, text_col: str = "chunk_text") -> DataFrame:
    """Per question the first hits as a sorted array of sources."""
    return hits.groupBy("question_id").agg(_first_sources(limit, text_col).alias("sources"))


def assemble_answers(
    questions: DataFrame,
    hits: DataFrame,
    supplied: DataFrame | None = None,
    max_length: int = 2000,
    text_col: str = "chunk_text",
    return_sources: bool = True,
) -> DataFrame:
    """Answer, question, context and sources per question.

    ``supplied`` holds (question_id, answer). A question without hits gets the fixed text, one with
    hits but without a supplied answer the error text.
    """
    # Context and sources come from one aggregation, so the search behind the hits runs once.
    packed = _with_shown_pieces(hits, max_length, text_col).groupBy("question_id").agg(
        _joined_pieces().alias("context"), _first_sources(3, text_col).alias("sources")
    )
    joined = questions.join(packed, "question_id", "left")
    if supplied is None:
        joined = joined.withColumn("answer", F.lit(None).cast("string"))
    else:
        joined = joined.join(supplied.select("question_id", "answer"), "question_id", "left")
    answer = F.when(F.col("sources").isNull(), F.lit(NO_HITS_ANSWER)).otherwise(
        strip(F.coalesce("answer", F.lit(FAILED_ANSWER)))
    )
    columns = ["question_id", "question", answer.alias("answer"),
               F.coalesce("context", F.lit("")).alias("context")]
    if return_sources:
        columns.append(F.coalesce("sources", F.array().cast(f"array<{SOURCE}>")).alias("sources"))
    return joined.select(*columns)


def relevance(distance: Column) -> Column:
    """One minus the distance, held between 0 and 1. Null without a distance."""
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - distance))
    return F.when(distance.isNotNull(), score)


def percent_text(share: Column) -> Column:
    """A share as a percentage with one decimal, halves to the even digit."""
    return F.format_string("%.1f%%", F.rint(share * 1000) / 10)


def _source_block(source: Column) -> Column:
    score = percent_text(relevance(source["distance"]))
    return F.concat(
        F.lit("#### Source "), source["rank"], F.lit("\n\n**Product:** "),
        F.coalesce(source["product"], F.lit(UNKNOWN)), F.lit("  \n**Issue:** "),
        F.coalesce(source["issue"], F.lit(UNKNOWN)), F.lit("  \n**Company:** "),
        F.coalesce(source["company"], F.lit(UNKNOWN)), F.lit("  \n"),
        F.when(
            source["distance"].isNotNull(), F.concat(F.lit("**Relevance:** "), score, F.lit("  \n"))
        ).otherwise(""),
        F.lit("\n**Text Excerpt:**\n> "), F.coalesce(source["text"], F.lit("N/A")),
        F.lit("\n\n---\n\n"),
    )


def source_markdown(answers: DataFrame) -> DataFrame:
    """Add the Markdown block of the sources of each answer."""
    blocks = F.array_join(F.transform("sources", _source_block), "\n")
    shown = F.when(F.size("sources") == 0, F.lit(NO_SOURCES)).otherwise(
        F.concat(F.lit(SOURCES_TITLE + "\n"), blocks)
    )
    return answers.withColumn("source_markdown", shown)
