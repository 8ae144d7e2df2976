"""Prompt templates and their rendering as string expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from narrata.functions.text import strip

# --- fixed values: prompt texts; the name of the organisation is a parameter ---
DEFAULT = """You are a financial analyst assistant for {organisation}. Your task is to answer questions about customer complaints. Use the following retrieved complaint excerpts to formulate your answer. If the context doesn't contain the answer, state that you don't have enough information.

Context: {context}

Question: {question}

Answer:"""
DETAILED = """You are an expert financial analyst assistant for {organisation}, a financial services company. Your role is to help answer questions about customer complaints by analyzing retrieved complaint excerpts.

Instructions:
1. Carefully read the provided context (retrieved complaint excerpts)
2. Use ONLY the information from the context to answer the question
3. If the context contains relevant information, provide a clear, concise answer
4. If the context does NOT contain enough information to answer the question, explicitly state: "I don't have enough information in the provided context to answer this question."
5. Do not make up or infer information that is not in the context
6. If multiple complaints are relevant, you can reference patterns or common issues

Context (Retrieved Complaint Excerpts):
{context}

Question: {question}

Answer:"""
CONCISE = """You are a financial analyst assistant. Answer the question using ONLY the provided context. If the context doesn't contain the answer, say "I don't have enough information."

Context: {context}

Question: {question}

Answer:"""
TEMPLATES = {"default": DEFAULT, "detailed": DETAILED, "concise": CONCISE}
# -------------------------------------------------------------------------------


def render(template: str, **values: Column | str) -> Column:
    """Fill ``{name}`` placeholders. Text inside a value is never read as a placeholder.

    ``template`` is the name of a built-in template or a template text of the caller.
    """
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(TEMPLATES.get(template, template)):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in values:
                raise ValueError(f"the template needs a value for {{{name}}}")
            value = values[name]
            parts.append(value if isinstance(value, Column) else F.lit(value))
    return F.concat(*parts)


def without_prompt(answer: Column, prompt: Column) -> Column:
    """Drop the prompt where the generated answer repeats it, and strip what is left of it."""
    rest = strip(F.substring(answer, F.length(prompt) + 1, F.length(answer)))
    return F.when(F.startswith(answer, prompt), rest).otherwise(answer)
