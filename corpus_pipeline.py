"""From raw documents to packed sequences, in five stages.

Each stage takes all documents that the one before kept and hands on a written table, so a lost executor
costs one stage at most. All stages but the last return the columns of ``documents``; rows may carry
further columns, which are not handed on.

Defined cases: rows without a letter (null and empty texts among them) leave in the first stage; rows with
a null id are never compared with others and stay; a document whose every line was an earlier document's
leaves with the second stage; rows that repeat an id do not delete lines from each other, and each stays
or leaves as a near-duplicate by its own text; an empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm import fair_mix, language, line_dedup, near_dup, packing
from narrata.llm.common import WORD, staged
from narrata.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents whose best language has a lower score than this are rejected.
MIN_SCORE = 0.2
#: Parts of texts that a worker remembers while it packs: fewer than for packing alone, as the same workers
#: still hold the word tables of the stages before.
REMEMBERED = 200_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in no language that the labelled ones show."""
    return language.accepted(docs.select(COLUMNS), MIN_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete lines aligned with an earlier document; documents left without a word go."""
    changed = F.size("removed_lines") > 0
    return (
        line_dedup.deduplicated(docs.select(COLUMNS))
        .filter(~changed | F.col("text").rlike(WORD))
        .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(COLUMNS)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near-duplicates (five words to a shingle, similarity 0.8)."""
    docs = docs.select(COLUMNS)
    gone = near_dup.near_duplicates(docs, tagged=True).filter("not kept").select("doc_id", "tag").distinct()
    return docs.withColumn("tag", F.xxhash64("text")).join(gone, ["doc_id", "tag"], "left_anti").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources wants it."""
    return fair_mix.mixed_documents(docs.select(COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mixed documents into sequences."""
    return packing.pack(docs, tokenizer_path(), remembered=REMEMBERED)


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", drop_near_duplicates),
    ("mix", mix_sources),
    ("packing", pack_sequences),
]

#: Languages, alignment and packing have no form in SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
