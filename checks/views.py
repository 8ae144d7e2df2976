"""Views over the test tables, as SQL that both engines run.

``complaints`` puts nulls, blanks, URLs, addresses, phone numbers, boilerplate and mixed dates into
the texts. The others join whole tables: every document, every vector, every benchmark item, every answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COMPLAINTS = """
SELECT CAST(d.doc_id AS STRING) AS complaint_id, d.doc_id,
 CASE WHEN d.doc_id % 37 = 0 THEN NULL ELSE d.lang END AS product,
 CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'poor' END AS issue,
 CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.toxic = 0 THEN 'clean' END AS tags,
 d.source AS company,
 CONCAT('S', CAST(d.doc_id % 7 AS STRING)) AS state,
 LPAD(CAST(d.doc_id AS STRING), 5, '0') AS zip_code,
 CASE WHEN d.doc_id % 31 = 0 THEN 'not a date'
      WHEN d.doc_id % 2 = 0 THEN CONCAT('2024-', LPAD(CAST(1 + d.doc_id % 12 AS STRING),2,'0'), '-', LPAD(CAST(1 + d.doc_id % 28 AS STRING),2,'0'))
      ELSE CONCAT(LPAD(CAST(1 + d.doc_id % 12 AS STRING),2,'0'), '/', LPAD(CAST(1 + d.doc_id % 28 AS STRING),2,'0'), '/2024') END AS date_received,
 CASE WHEN d.doc_id % 17 = 0 THEN NULL
      WHEN d.doc_id % 19 = 0 THEN ''
      WHEN d.doc_id % 23 = 0 THEN '   '
      WHEN d.doc_id % 29 = 0 THEN 'nan'
      WHEN d.doc_id % 11 = 0 THEN CONCAT('I am writing to file a complaint. See http://ex.org/a?b=', CAST(d.doc_id AS STRING), ' or mail a.b@ex.org, call 555-123-4567. FYI: ', d.text)
      ELSE d.text END AS narrative
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

#: Every document and every vector; a document without a vector of its own takes that of its id modulo their number.
CHUNKS = """
SELECT CONCAT(CAST(c.id AS STRING), '_0') AS chunk_id, c.id AS original_index, 0 AS chunk_index,
 COALESCE(c.text, '') AS chunk_text, CAST(LENGTH(COALESCE(c.text, '')) AS INT) AS chunk_length, 1 AS num_chunks,
 CONCAT('p', CAST(v.label AS STRING)) AS product,
 CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'poor' END AS issue,
 c.source AS company, v.embedding
FROM (SELECT COALESCE(d.doc_id, e.vec_id) AS id, d.text, d.source,
  COALESCE(d.doc_id, e.vec_id) % (SELECT COUNT(*) FROM {embeddings}) AS vector_id
  FROM {documents} d FULL OUTER JOIN {embeddings} e ON e.vec_id = d.doc_id) c
 JOIN {embeddings} v ON v.vec_id = c.vector_id LEFT JOIN {labels} l ON c.id = l.doc_id
"""

QUESTIONS = """
SELECT b.item_id AS question_id, CONCAT('What about ', b.text) AS question, e.embedding AS question_embedding,
 CASE WHEN e.label < 5 THEN CONCAT('p', CAST(e.label AS STRING)) END AS product_filter
FROM {benchmark} b LEFT JOIN {embeddings} e ON e.vec_id = b.item_id
"""

#: All assistant turns of a conversation in order.
ANSWERS = """
SELECT b.item_id AS question_id, CONCAT('  ', c.text, ' ') AS answer
FROM {benchmark} b JOIN (SELECT conv_id, <turns in order> AS text FROM {conversations} WHERE role = 'assistant' GROUP BY conv_id) c
 ON c.conv_id = b.item_id
"""
#: The two engines write an ordered join of texts differently.
IN_ORDER = {"spark": "LISTAGG(text, ' ') WITHIN GROUP (ORDER BY turn)", "duckdb": "STRING_AGG(text, ' ' ORDER BY turn)"}


VIEWS = {"complaints": COMPLAINTS, "chunks": CHUNKS, "questions": QUESTIONS, "answers": ANSWERS}
TABLES = ["documents", "labels", "embeddings", "benchmark", "conversations"]


def documents(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """The documents; ``heavy`` marks queries whose text work is costly."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    used = [t for t in TABLES if "{" + t + "}" in VIEWS[name]]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    if heavy:
        frames["documents"] = documents(spark, sf_dir, heavy)
    return spark.sql(VIEWS[name].replace("<turns in order>", IN_ORDER["spark"]), **frames)


def with_views(sql: str, *names: str) -> str:
    """The DuckDB form of a query: the named views as common table expressions in front."""
    plain = {t: t for t in TABLES}
    heads = [f"{n} AS ({VIEWS[n].replace("<turns in order>", IN_ORDER["duckdb"]).format(**plain).strip()})" for n in names]
    return "WITH RECURSIVE " + ",\n".join(heads) + sql
