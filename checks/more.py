"""Queries over data that is less clean: repeated and large loads, mixed columns, odd vectors, whole samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as q
from checks.sql import rounded
from checks.tables import allocation_sql, complaints, over, rounded_columns
from checks.texts import COSINE, K, SIZE, VECTOR, WINDOW, batch_sql, chunks, questions, window_sql, windows
from checks.views import documents, with_views
from narrata.operators import chunk, clean, nearest, profile, pruned, sample, validate
from narrata.session import scratch_path
from narrata.sources import readers, store, writers


# --- the vector table ---------------------------------------------------------------------------
def all_rows(spark, sf_dir):
    """Every document as a row of the vector table."""
    return store.records(
        documents(spark, sf_dir).select(
            F.col("doc_id").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("chunk_text"),
            F.array(F.length("text"), F.col("doc_id")).alias("embedding"), F.col("lang").alias("product"),
        )
    )


def stored_texts(table):
    return table.read().select("chunk_id", F.md5("chunk_text").alias("text_md5"), "product")


def store_add_large(spark, sf_dir):
    """All documents in one load, a third of them twice in it."""
    table = store.VectorTable(spark, scratch_path(spark, "store_large"))
    rows = all_rows(spark, sf_dir)
    table.add(rows.unionByName(rows.filter("CAST(chunk_id AS BIGINT) % 3 = 0")))
    return stored_texts(table)


def store_add_repeat(spark, sf_dir):
    """The same load of all documents twice, then one with half of the ids new."""
    table = store.VectorTable(spark, scratch_path(spark, "store_repeat"))
    rows = all_rows(spark, sf_dir)
    half = rows.withColumn("chunk_id", F.when(F.col("chunk_id").cast("long") % 2 == 0, F.concat("chunk_id", F.lit("x"))).otherwise(F.col("chunk_id")))
    added = [(1, table.add(rows)), (2, table.add(rows)), (3, table.add(half))]
    return spark.createDataFrame(added, "load int, rows_added long")


def store_mixed_columns(spark, sf_dir):
    """Loads with different metadata columns: all are kept, absent ones are null."""
    table = store.VectorTable(spark, scratch_path(spark, "store_mixed"))
    rows = all_rows(spark, sf_dir)
    table.add(rows.filter("CAST(chunk_id AS BIGINT) % 2 = 0"))
    table.add(rows.filter("CAST(chunk_id AS BIGINT) % 2 = 1").withColumnRenamed("product", "state"))
    return table.read().select("chunk_id", "product", "state")


# --- search -------------------------------------------------------------------------------------
def with_odd_vectors(spark, sf_dir):
    """Every fifth vector zero, every seventh with a null and every eleventh with a NaN element."""
    n = F.col("original_index")
    fill = lambda value: F.transform("embedding", lambda x, i: F.when(i == 0, F.lit(value).cast("float")).otherwise(x))
    return chunks(spark, sf_dir).withColumn(
        "embedding",
        F.when(n % 5 == 0, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))).when(n % 7 == 0, fill(None))
        .when(n % 11 == 0, fill(float("nan"))).otherwise(F.col("embedding")),
    )


def top_odd(metric, k):
    def run(spark, sf_dir):
        hits = nearest.nearest_to_vector(with_odd_vectors(spark, sf_dir), VECTOR, k, metric=metric)
        return rounded_columns(hits, 5, "distance")

    return run


def top_odd_sql(distance: str, k: int) -> str:
    return with_views(f"""
        , odd AS (SELECT chunk_id, original_index, CASE WHEN original_index % 5 = 0 THEN list_transform(embedding, lambda x: 0.0)
            ELSE embedding END AS v FROM chunks WHERE original_index % 5 = 0 OR (original_index % 7 <> 0 AND original_index % 11 <> 0))
        SELECT CAST(row_number() OVER (ORDER BY d, chunk_id) AS INTEGER) AS rank, chunk_id, round(d, 5) AS distance
        FROM (SELECT chunk_id, {distance} AS d FROM odd) ORDER BY d, chunk_id LIMIT {k}""", "chunks")


_cosine = f"CASE WHEN original_index % 5 = 0 THEN 1.0 ELSE {COSINE.format(a='v', b=str(VECTOR))} END"
_l2 = f"list_sum(list_transform(list_zip(CAST(v AS DOUBLE[]), {VECTOR}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


# --- samples and tables -------------------------------------------------------------------------
def stratified_share(share: float):
    def run(spark, sf_dir):
        rows = complaints(spark, sf_dir)
        n = int(share * rows.count())
        return sample.stratified_sample(rows, n, "company", "doc_id").select("doc_id", "company")

    return run


def stratified_large_sql() -> str:
    """60 percent of the table; the size of the sample follows the table."""
    sized = allocation_sql("company", 0, 1).replace("* 0)", "* (SELECT CAST(trunc(0.6 * count(*)) AS BIGINT) FROM complaints))")
    sized = sized.replace("CAST(0 - sum", "CAST((SELECT CAST(trunc(0.6 * count(*)) AS BIGINT) FROM complaints) - sum")
    return over(sized + """
        SELECT doc_id, company FROM (
          SELECT doc_id, company, sampled, row_number() OVER (PARTITION BY company
            ORDER BY md5(concat('42-', CAST(doc_id AS VARCHAR))), doc_id) AS place
          FROM complaints JOIN plan ON company = stratum) WHERE place <= sampled""")


def csv_mixed_headers(spark, sf_dir):
    """Files of one folder with different columns in different order."""
    folder = scratch_path(spark, "mixed")
    rows = complaints(spark, sf_dir).select("complaint_id", "product", "state")
    for number, columns in enumerate((["complaint_id", "product", "state"], ["state", "complaint_id"])):
        part = rows.filter(F.col("complaint_id").cast("long") % 2 == number).select(columns)
        part.write.option("header", True).csv(f"{folder}/part={number}")
    return readers.read_csv(spark, f"{folder}/*/*.csv", mixed_headers=True).select("complaint_id", "product", "state")


def dedup_all_columns(spark, sf_dir):
    """All columns but the key compared, over a table that holds every row twice."""
    rows = complaints(spark, sf_dir)
    twice = rows.unionByName(rows.withColumn("doc_id", F.col("doc_id") + 10_000_000))
    return clean.remove_duplicates(twice, keep="first", key="doc_id").select("doc_id", "complaint_id")


def store_add_bucketed(spark, sf_dir):
    """All documents in buckets by id, then a load of which a third is new."""
    path = scratch_path(spark, "store_bucketed")
    table = store.VectorTable(spark, path, buckets=16)
    rows = all_rows(spark, sf_dir)
    counts = [(1, table.add(rows.filter("CAST(chunk_id AS BIGINT) % 3 != 0")))]
    counts.append((2, store.VectorTable(spark, path, buckets=16).add(rows.unionByName(rows))))
    added = spark.createDataFrame(counts, "load int, rows_added long")
    return added.unionByName(table.read().agg(F.lit(3).alias("load"), F.count_distinct("chunk_id").alias("rows_added")))


def csv_bad_rows(spark, sf_dir):
    """A file with short lines, long lines and words for numbers: good rows and quarantine, counted and summed."""
    folder, d = scratch_path(spark, "bad_rows"), F.col("doc_id")
    fields = [F.when(d % 10 == 2, F.concat(F.lit("x"), d)).otherwise(d.cast("string")), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))]
    line = F.when(d % 10 == 0, F.concat_ws(",", *fields[:2])).when(d % 10 == 1, F.concat_ws(",", *fields, F.lit("more"))).otherwise(F.concat_ws(",", *fields))
    documents(spark, sf_dir).select(line).write.text(f"{folder}/raw")
    schema = spark.createDataFrame([], "doc_id long, lang string, source string").schema
    good, bad = readers.split_csv(spark, f"{folder}/raw", schema, f"{folder}/split", header=False)
    counts = good.agg(F.lit("good").alias("kind"), F.count("*").alias("n"), F.sum("doc_id").alias("total"))
    return counts.unionByName(bad.agg(F.lit("bad").alias("kind"), F.count("*").alias("n"), F.sum(F.length("record")).alias("total")))


# --- search that reads parts of the table ------------------------------------------------------
def batch_topk_pruned(spark, sf_dir):
    """Chunks in folders by product; each question looks into its own."""
    path = scratch_path(spark, "by_product")
    rows = chunks(spark, sf_dir).select("chunk_id", "embedding", "product")
    rows.repartition("product").write.partitionBy("product").parquet(path)
    stored = spark.read.schema("chunk_id string, embedding array<float>, product string").parquet(path)
    hits = pruned.nearest_by_value(stored, questions(spark, sf_dir), "product", "product_filter", K)
    return rounded_columns(hits, 5, "distance").select("question_id", "rank", "chunk_id", "distance")


def batch_topk_pivots(spark, sf_dir):
    path = scratch_path(spark, "pivots")
    pruned.write_pivot_table(chunks(spark, sf_dir), path, 16)
    hits = pruned.nearest_by_pivots(spark, path, questions(spark, sf_dir), K)
    return rounded_columns(hits, 5, "distance").select("question_id", "rank", "chunk_id", "distance")


# --- reports from one scan ----------------------------------------------------------------------
def profile_bundle(spark, sf_dir):
    return profile.profile_table(complaints(spark, sf_dir), "product", "narrative")


def summary_table(spark, sf_dir):
    return validate.summary_table(complaints(spark, sf_dir))


def shuffled_positions(spark, sf_dir):
    return sample.shuffled_positions(complaints(spark, sf_dir).select("doc_id", "company"), "doc_id").select("position", "doc_id")


def chunk_report(spark, sf_dir):
    table = chunk.chunk_report(documents(spark, sf_dir), "text", WINDOW, SIZE)
    return rounded_columns(table.select("total_documents", "total_chunks", "mean", "std", "within_10_percent", "percentage_within_20"), 4, "mean", "std", "percentage_within_20")


def chunk_count_bins(spark, sf_dir):
    return chunk.chunk_count_histogram(documents(spark, sf_dir), "text", WINDOW)


def column_types(spark, sf_dir):
    return validate.column_types(complaints(spark, sf_dir))


_profiled = f""", w AS (SELECT {q.has_text("narrative")} AS present, {q.word_count("narrative")} AS words FROM complaints),
    p AS (SELECT product, count(*) AS n FROM complaints WHERE product IS NOT NULL GROUP BY product),
    l AS (SELECT words FROM w WHERE present)"""


def profile_sql() -> str:
    stats = {
        "mean": "avg(words)", "median": "median(words)", "std": "stddev_samp(words)", "min": "min(words)", "max": "max(words)",
        **{f"q{p}": f"quantile_cont(words, 0.{p})" for p in (25, 75, 90, 95, 99)},
    }
    lines = [f"SELECT 'length_stats' AS part, '{name}' AS name, round(CAST({sql} AS DOUBLE), 4) AS value FROM l" for name, sql in stats.items()]
    lines += [
        "SELECT 'category_count', product, CAST(n AS DOUBLE) FROM p",
        "SELECT 'presence', 'total', CAST(count(*) AS DOUBLE) FROM w",
        "SELECT 'presence', 'with_text', CAST(count(*) FILTER (present) AS DOUBLE) FROM w",
        "SELECT 'presence', 'without_text', CAST(count(*) FILTER (NOT present) AS DOUBLE) FROM w",
        "SELECT 'length_counts', 'very_short', CAST(count(*) FILTER (words < 10) AS DOUBLE) FROM l",
        "SELECT 'length_counts', 'very_long', CAST(count(*) FILTER (words > (SELECT quantile_cont(words, 0.95) FROM l)) AS DOUBLE) FROM l",
    ]
    return over(_profiled + " UNION ALL ".join(lines))


COMPLAINT_COLUMNS = "complaint_id doc_id product issue tags company state zip_code date_received narrative".split()


def summary_sql() -> str:
    lines = [
        "SELECT 'shape' AS part, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM complaints", "SELECT 'shape', 'columns', '10'",
        "SELECT 'duplicates', 'rows', CAST((SELECT count(*) FROM complaints) - (SELECT count(*) FROM (SELECT DISTINCT * FROM complaints)) AS VARCHAR)",
        *[f"SELECT 'null_counts', '{c}', CAST(count(*) - count({c}) AS VARCHAR) FROM complaints" for c in COMPLAINT_COLUMNS],
        *[f"SELECT 'column_types', '{c}', '{'bigint' if c == 'doc_id' else 'string'}'" for c in COMPLAINT_COLUMNS],
    ]
    return over(" UNION ALL ".join(lines))


CHECKS = {
    "store_add_large": (
        store_add_large,
        "SELECT CAST(doc_id AS VARCHAR) AS chunk_id, md5(coalesce(text, '')) AS text_md5, lang AS product FROM documents",
    ),
    "store_add_repeat": (
        store_add_repeat,
        """SELECT 1 AS load, count(*) AS rows_added FROM documents UNION ALL SELECT 2, 0
           UNION ALL SELECT 3, count(*) FROM documents WHERE doc_id % 2 = 0""",
    ),
    "store_add_bucketed": (
        store_add_bucketed,
        """SELECT 1 AS load, count(*) AS rows_added FROM documents WHERE doc_id % 3 != 0
           UNION ALL SELECT 2, count(*) FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 3, count(*) FROM documents""",
    ),
    "store_mixed_columns": (
        store_mixed_columns,
        """SELECT CAST(doc_id AS VARCHAR) AS chunk_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS product,
           CASE WHEN doc_id % 2 = 1 THEN lang END AS state FROM documents""",
    ),
    "topk_cosine_zero": (top_odd("cosine", 400), top_odd_sql(_cosine, 400)),
    "topk_bad_vectors": (top_odd("l2", 10), top_odd_sql(_l2, 10)),
    "stratified_sample_large": (stratified_share(0.6), stratified_large_sql()),
    "stratified_sample_whole": (stratified_share(1.5), over("SELECT doc_id, company FROM complaints")),
    "csv_mixed_headers": (
        csv_mixed_headers,
        over("""SELECT complaint_id, CASE WHEN CAST(complaint_id AS BIGINT) % 2 = 0 THEN product END AS product, state FROM complaints"""),
    ),
    "dedup_all_columns": (dedup_all_columns, over("SELECT doc_id, complaint_id FROM complaints")),
    "chunk_report": (
        chunk_report,
        windows(f"""SELECT (SELECT count(text) FROM documents) AS total_documents, count(*) AS total_chunks,
            round(avg(length(chunk_text)), 4) AS mean, round(stddev_pop(length(chunk_text)), 4) AS std,
            count(*) FILTER (length(chunk_text) BETWEEN {SIZE} * 0.9 AND {SIZE} * 1.1) AS within_10_percent,
            round(count(*) FILTER (length(chunk_text) BETWEEN {SIZE} * 0.8 AND {SIZE} * 1.2) / count(*) * 100, 4) AS percentage_within_20
            FROM pieces"""),
    ),
    "chunk_count_bins": (
        chunk_count_bins,
        windows("""SELECT CAST(bin AS INTEGER) AS bin, count(c) AS n
            FROM (SELECT unnest(range(1, (SELECT max(n) + 1 FROM (SELECT count(*) AS n FROM pieces GROUP BY key)))) AS bin)
            LEFT JOIN (SELECT count(*) AS c FROM pieces GROUP BY key) ON c = bin GROUP BY bin"""),
    ),
    "csv_bad_rows": (
        csv_bad_rows,
        """SELECT 'good' AS kind, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS total FROM documents WHERE doc_id % 10 > 2
           UNION ALL SELECT 'bad', count(*), CAST(sum(length(CAST(doc_id AS VARCHAR)) + length(coalesce(lang, '')) + 1
             + CASE doc_id % 10 WHEN 0 THEN 0 WHEN 1 THEN length(coalesce(source, '')) + 6 ELSE length(coalesce(source, '')) + 2 END) AS BIGINT)
           FROM documents WHERE doc_id % 10 <= 2""",
    ),
    "batch_topk_pruned": (batch_topk_pruned, batch_sql("product = product_filter")),
    "batch_topk_pivots": (batch_topk_pivots, batch_sql()),
    "profile_bundle": (lambda spark, sf_dir: rounded_columns(profile_bundle(spark, sf_dir), 4, "value"), profile_sql()),
    "summary": (summary_table, summary_sql()),
    "shuffled": (
        shuffled_positions,
        over("SELECT row_number() OVER (ORDER BY md5(concat('42-', CAST(doc_id AS VARCHAR))), doc_id) AS position, doc_id FROM complaints"),
    ),
    "column_types": (
        column_types,
        over("""SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' ELSE 'string' END AS data_type
            FROM (DESCRIBE SELECT * FROM complaints)"""),
    ),
}
