"""Evaluation tables and reports over answered questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions.text import strip
from narrata.operators.answer import UNKNOWN, shortened

# --- fixed values: lines of the report around the table rows ---
REPORT_HEAD = [
    "# RAG Pipeline Evaluation Report", "", "## Overview", "",
    "This report evaluates the RAG pipeline on {count} representative questions.", "",
    "## Evaluation Table", "",
    "| Question | Generated Answer | Retrieved Sources | Quality Score | Comments/Analysis |",
    "|----------|------------------|------------------|---------------|-------------------|",
]
REPORT_TAIL = [
    "", "## Analysis", "", "### What Worked Well", "", "- [To be filled based on evaluation]", "",
    "### Areas for Improvement", "", "- [To be filled based on evaluation]", "",
    "### Recommendations", "", "- [To be filled based on evaluation]", "",
]
# ----------------------------------------------------------------


def evaluate(answers: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One evaluation row per answer, with empty fields for a manual score and comment.

    ``expected`` holds (question_id, expected_answer).
    """
    if expected is None:
        joined = answers.withColumn("expected_answer", F.lit(None).cast("string"))
    else:
        joined = answers.join(expected.select("question_id", "expected_answer"), "question_id", "left")
    return joined.select(
        "question_id",
        "question",
        F.col("answer").alias("generated_answer"),
        F.slice("sources", 1, 2).alias("retrieved_sources"),
        F.size("sources").alias("num_sources"),
        "expected_answer",
        F.substring("context", 1, 500).alias("context_used"),
        F.lit(None).cast("int").alias("quality_score"),
        F.lit("").alias("comments"),
    )


def _first_two(line) -> Column:
    """Rendered first two sources; ``line`` gets the source and its number from 1."""
    return F.transform(F.slice("retrieved_sources", 1, 2), lambda s, i: line(s, i + 1))


def _product(source: Column) -> Column:
    return F.coalesce(source["product"], F.lit(UNKNOWN))


def evaluation_table(results: DataFrame) -> DataFrame:
    """The table for reading: cut answers and sources as text lines."""
    lines = _first_two(
        lambda s, i: F.concat(
            F.lit("Source "), i, F.lit(" ("), _product(s), F.lit("): "),
            F.substring(s["text"], 1, 100), F.lit("..."),
        )
    )
    return results.select(
        "question_id",
        F.col("question").alias("Question"),
        shortened(F.col("generated_answer"), 300).alias("Generated Answer"),
        strip(F.array_join(lines, "\n")).alias("Retrieved Sources"),
        F.col("quality_score").alias("Quality Score"),
        F.col("comments").alias("Comments/Analysis"),
    )


def report_lines(results: DataFrame) -> DataFrame:
    """The Markdown report as ordered lines (part, question_id, line_no, line).

    The report stays a distributed table, however many questions it has. ``write_lines`` writes it.
    """

    def escaped(text: Column) -> Column:
        return F.replace(text, F.lit("|"), F.lit("\\|"))

    cells = _first_two(
        lambda s, i: F.concat(
            F.lit("**Source "), i, F.lit("** ("), _product(s), F.lit("): "),
            F.substring(s["text"], 1, 80), F.lit("...<br>"),
        )
    )
    row = F.concat(
        F.lit("| "), escaped(F.col("question")),
        F.lit(" | "), escaped(F.substring("generated_answer", 1, 200)), F.lit("... | "),
        F.array_join(cells, ""), F.lit(" | "),
        F.coalesce(F.col("quality_score").cast("string"), F.lit("None")), F.lit(" | "),
        escaped(F.col("comments")), F.lit(" |"),
    )
    body = results.select(
        F.lit(2).alias("part"), "question_id", F.lit(0).alias("line_no"), row.alias("line")
    )
    key_type = results.schema["question_id"].dataType

    def fixed(part: int, lines: list[str], one_row: DataFrame) -> DataFrame:
        return one_row.select(
            F.lit(part).alias("part"),
            F.lit(None).cast(key_type).alias("question_id"),
            F.posexplode(F.array(*map(F.lit, lines))).alias("line_no", "line"),
            "count",
        ).select(
            "part", "question_id", "line_no",
            F.replace("line", F.lit("{count}"), F.col("count").cast("string")).alias("line"),
        )

    count = results.agg(F.count("*").alias("count"))
    return reduce(DataFrame.unionByName, [fixed(1, REPORT_HEAD, count), body, fixed(3, REPORT_TAIL, count)])
