"""Load a file of embedded chunks into the vector table and test it with a question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.operators.embed import Encoder, embed
from narrata.operators.nearest import nearest
from narrata.params import require_columns
from narrata.session import local_table
from narrata.sources.readers import first_readable
from narrata.sources.store import METADATA_NAMES, VectorTable, project_metadata, records

# --- fixed values: metadata columns that are taken along when present ---
METADATA_CANDIDATES = [
    "Product", "Issue", "Company", "State", "Date received", "Complaint ID", "original_index",
    "chunk_index", "num_chunks", "chunk_length",
]
# -------------------------------------------------------------------------


def ingest_embeddings(
    spark: SparkSession,
    candidates: list[str],
    table: VectorTable,
    reset: bool = False,
    metadata: list[str] | None = None,
) -> DataFrame:
    """Append the first source that exists; one row with counts before, added and after."""
    source = first_readable(spark, candidates)
    require_columns(source, ["embedding", "chunk_id", "chunk_text"])
    if reset:
        table.delete()
    present = [c for c in (metadata or METADATA_CANDIDATES) if c in source.columns]
    names = {k: v for k, v in METADATA_NAMES.items() if k in present}
    named = project_metadata(source.select("chunk_id", "chunk_text", "embedding", *present), names)
    before = table.count()
    added = table.add(records(named))
    return table.read().agg(F.count("*").alias("rows_after")).select(
        F.lit(before).cast("long").alias("rows_before"),
        F.lit(added).cast("long").alias("rows_added"),
        "rows_after",
    )


def ask_once(
    table: VectorTable, question: str, factory: Callable[[], Encoder], k: int = 3
) -> DataFrame:
    """The k nearest chunks of one question, embedded by the encoder the table was built with."""
    asked = local_table(
        table.spark, {"question_id": [1], "question": [question]}, "question_id int, question string"
    )
    vectors = asked.withColumn("question_embedding", embed(F.col("question"), factory))
    return nearest(table.read(), vectors, k, payload=["chunk_text"])
