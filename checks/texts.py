"""Queries over chunks, vectors, retrieval and answers, each with its oracle where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as q
from checks.tables import complaints, histogram_sql, over, rounded_columns
from checks.views import documents, view, with_views
from narrata.functions import prompts as templates
from narrata.operators import answer, chunk, embed, evaluate, nearest
from narrata.plans.answer_batch import answer_batch
from narrata.plans.index_build import build_index, preprocess
from narrata.plans.ingest import ask_once, ingest_embeddings
from narrata.params import JobParams
from narrata.session import scratch_path
from narrata.sources import readers, store, writers
from narrata.streaming.incremental import append_new_files

SIZE, OVERLAP, DIM, K = 500, 50, 64, 5
ORGANISATION = "the company"
VECTOR = [0.125] * DIM
QUESTION = "what does the data of the model say"
WORD_SIZE, WORD_OVERLAP = 40, 8
#: Cut at spaces only, sizes in words.
BY_WORDS = chunk.recursive_splitter(WORD_SIZE, WORD_OVERLAP, [" "], measure=lambda text: len(text.split()))
WINDOW = chunk.window_splitter(SIZE, OVERLAP)
RECURSIVE = chunk.recursive_splitter(SIZE, OVERLAP)


def chunks(spark, sf_dir):
    return view(spark, sf_dir, "chunks")


def questions(spark, sf_dir):
    return view(spark, sf_dir, "questions")


def answers(spark, sf_dir):
    return view(spark, sf_dir, "answers")


# --- chunks -------------------------------------------------------------------------------------
def last_cut(mark: str) -> str:
    """Place after the last occurrence of a mark in the window, 0 when there is none."""
    return f"length(regexp_extract(w, '(?s)^.*{mark}'))"


def window_sql(source: str, text: str = "text", key: str = "doc_id") -> str:
    """Walk of the window splitter. Gives ``pieces(key, chunk_index, chunk_text, num_chunks)``."""
    marks = [r"\. ", "! ", r"\? ", "\\n\\n", "\\n"]
    kinds = " ".join(f"WHEN {last_cut(m)} > 0 THEN {last_cut(m)}" for m in marks)
    return f"""
    texts AS (SELECT {key} AS k, {text} AS t, length({text}) AS n FROM {source} WHERE {q.not_blank(text)}),
    walk(k, i, start, nxt) AS (
      SELECT k, -1, 0, 0 FROM texts
      UNION ALL
      SELECT k, i + 1, nxt, CASE WHEN nxt + {SIZE} >= n THEN n + 1000000000
        WHEN nxt + cut - {OVERLAP} > nxt THEN nxt + cut - {OVERLAP} ELSE nxt + cut END
      FROM (SELECT *, CASE WHEN kind = {SIZE} AND {last_cut(" ")} > 0 THEN {last_cut(" ")} ELSE kind END AS cut
        FROM (SELECT *, CASE {kinds} ELSE {SIZE} END AS kind
          FROM (SELECT walk.k, i, nxt, n, substring(t, nxt + 1, {SIZE}) AS w
            FROM walk JOIN texts USING (k) WHERE nxt < n)))),
    steps AS (SELECT k, i, start, nxt, CASE WHEN nxt >= 1000000000 THEN n ELSE 0 END AS stop, t, n
      FROM walk JOIN texts USING (k) WHERE i >= 0),
    cuts AS (SELECT *, substring(t, start + 1, {SIZE}) AS w FROM steps),
    pieces AS (SELECT k AS key, i AS chunk_index, count(*) OVER (PARTITION BY k) AS num_chunks,
      CASE WHEN stop > 0 THEN substring(t, start + 1) ELSE {q.stripped(
          f"substring(w, 1, CASE WHEN kind = {SIZE} AND {last_cut(' ')} > 0 THEN {last_cut(' ')} ELSE kind END)"
      )} END AS chunk_text FROM (SELECT *, CASE {kinds} ELSE {SIZE} END AS kind FROM cuts))"""


def recursive_sql(source: str, text: str = "text", key: str = "doc_id", overlap: int = OVERLAP) -> str:
    """The recursive splitter on offsets. Gives ``pieces(key, chunk_index, chunk_text, num_chunks)``.

    Nodes are texts to cut at one level. Pieces of a node that are too long become nodes; the others
    form runs, and each run is walked with the first and last piece of a chunk as state.
    """
    marks = "[chr(10) || chr(10), chr(10), '. ', '! ', '? ', '; ', ', ', ' ']"
    cut = f"""
      SELECT k, off, lvl, t, s, CASE WHEN s = 9 THEN range(0, length(t) + 1) ELSE
        list_concat([0], list_concat(list_filter(list_transform(range(1, len(parts)),
          lambda i: CAST(list_sum(list_transform(parts[1:i], lambda p: length(p))) AS BIGINT)
            + (i - 1) * length(mark)), lambda o: o > 0), [length(t)])) END AS bounds
      FROM (SELECT *, string_split(t, mark) AS parts FROM (SELECT *, ({marks})[s] AS mark
        FROM (SELECT *, coalesce(list_min(list_filter(range(lvl, 9),
          lambda i: contains(t, ({marks})[i]))), 9) AS s FROM {{nodes}})))"""
    return f"""
    texts AS (SELECT {key} AS k, {text} AS t FROM {source} WHERE {q.not_blank(text)}),
    nodes(k, t, off, lvl) AS (
      SELECT k, t, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM texts
      UNION ALL
      SELECT k, substring(t, bounds[i] + 1, bounds[i + 1] - bounds[i]), off + bounds[i], s + 1
      FROM (SELECT *, unnest(range(1, len(bounds))) AS i FROM ({cut.format(nodes="nodes")}))
      WHERE bounds[i + 1] - bounds[i] >= {SIZE}),
    spans AS (SELECT k, off, lvl, i, off + bounds[i] AS a, off + bounds[i + 1] AS b
      FROM (SELECT *, unnest(range(1, len(bounds))) AS i FROM ({cut.format(nodes="nodes")}))),
    parted AS (SELECT *, sum(CASE WHEN b - a >= {SIZE} THEN 1 ELSE 0 END)
      OVER (PARTITION BY k, off, lvl ORDER BY i) AS g FROM spans),
    runs AS (SELECT k, list(a ORDER BY i) AS al, list(b ORDER BY i) AS bl FROM parted
      WHERE b - a < {SIZE} GROUP BY k, off, lvl, g),
    walk(k, al, bl, lo, hi) AS (
      SELECT k, al, bl, CAST(1 AS BIGINT), CAST(len(list_filter(bl, lambda b: b - al[1] <= {SIZE})) AS BIGINT) FROM runs
      UNION ALL
      SELECT k, al, bl, nlo, CAST(len(list_filter(bl, lambda b: b - al[nlo] <= {SIZE})) AS BIGINT) FROM (
        SELECT *, CAST(len(list_filter(al,
          lambda a: a < greatest(bl[hi] - {overlap}, bl[hi + 1] - {SIZE}))) AS BIGINT) + 1 AS nlo
        FROM walk WHERE hi < len(al))),
    found AS (SELECT k, al[lo] AS a, {q.stripped("substring(t, al[lo] + 1, bl[hi] - al[lo])")} AS chunk_text
      FROM walk JOIN texts USING (k)),
    pieces AS (SELECT k AS key, CAST(row_number() OVER (PARTITION BY k ORDER BY a) - 1 AS INTEGER) AS chunk_index,
      count(*) OVER (PARTITION BY k) AS num_chunks, chunk_text FROM found WHERE chunk_text <> '')"""


def chunk_by_words(spark, sf_dir):
    """Own measure and separators, as a table function in a lateral join."""
    rows = chunk.chunk_rows(documents(spark, sf_dir), "text", "doc_id", BY_WORDS, ["lang"])
    return rows.withColumn("text_md5", F.md5("chunk_text")).drop("chunk_text")


def by_words_sql() -> str:
    """Greedy windows over the parts between spaces, on running sums of their words."""
    return f"""WITH RECURSIVE
    texts AS (SELECT doc_id AS k, lang, string_split(text, ' ') AS parts FROM documents WHERE {q.not_blank("text")}),
    counted AS (SELECT k, i, len({q.words("part")}) AS w
      FROM (SELECT k, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM texts)),
    sums AS (SELECT k, i, w, CAST(sum(w) OVER (PARTITION BY k ORDER BY i) AS BIGINT) AS c FROM counted),
    lists AS (SELECT k, list(c - w ORDER BY i) AS before, list(c ORDER BY i) AS upto FROM sums GROUP BY k),
    walk(k, i, lo, hi) AS (
      SELECT k, 0, CAST(1 AS BIGINT), CAST(len(list_filter(upto, lambda c: c <= {WORD_SIZE})) AS BIGINT) FROM lists
      UNION ALL
      SELECT k, i + 1, nlo, CAST(len(list_filter(upto, lambda c: c - before[nlo] <= {WORD_SIZE})) AS BIGINT) FROM (
        SELECT *, CAST(len(list_filter(before,
          lambda c: c < greatest(upto[hi] - {WORD_OVERLAP}, upto[hi + 1] - {WORD_SIZE}))) AS BIGINT) + 1 AS nlo
        FROM walk JOIN lists USING (k) WHERE hi < len(upto))),
    pieces AS (SELECT k, i, lang, {q.stripped("array_to_string(parts[lo:hi], ' ')")} AS t FROM walk JOIN texts USING (k))
    SELECT concat(k, '_', i) AS chunk_id, k AS original_index, i AS chunk_index, CAST(length(t) AS INTEGER) AS chunk_length,
      CAST(count(*) OVER (PARTITION BY k) AS INTEGER) AS num_chunks, lang, md5(t) AS text_md5 FROM pieces"""


def windows(sql: str) -> str:
    return f"WITH RECURSIVE {window_sql('documents')} {sql}"


def recursives(sql: str) -> str:
    return f"WITH RECURSIVE {recursive_sql('documents')} {sql}"


def chunked(splitter):
    def run(spark, sf_dir):
        table = chunk.chunk_table(documents(spark, sf_dir, heavy=True), "text", "doc_id", splitter, ["lang", "source"])
        return table.withColumn("text_md5", F.md5("chunk_text")).drop("chunk_text")

    return run


def stats_of(splitter):
    def run(spark, sf_dir):
        stats = chunk.chunk_stats(documents(spark, sf_dir, heavy=True), "text", splitter)
        return rounded_columns(
            stats, 4, "avg_chunks_per_doc", "median_chunks_per_doc", "avg_chunks_per_row", "mean",
            "median", "std", "q25", "q75", "q90", "q95",
        )

    return run


def targets_of(splitter):
    def run(spark, sf_dir):
        table = chunk.chunk_targets(documents(spark, sf_dir, heavy=True), "text", splitter, SIZE)
        return rounded_columns(table, 4, "percentage_within_10", "percentage_within_20")

    return run


def count_histogram(spark, sf_dir):
    return chunk.chunk_count_histogram(documents(spark, sf_dir, heavy=True), "text", WINDOW, last=10)


def length_histogram(spark, sf_dir):
    table = chunk.chunk_length_histogram(documents(spark, sf_dir, heavy=True), "text", WINDOW)
    return rounded_columns(table, 4, "from_value", "to_value", "mean", "median")


_length = "CAST(length(chunk_text) AS INTEGER)"

_chunk_rows = f"""SELECT concat(key, '_', chunk_index) AS chunk_id, key AS original_index, chunk_index,
    {_length} AS chunk_length, CAST(num_chunks AS INTEGER) AS num_chunks, lang, source,
    md5(chunk_text) AS text_md5 FROM pieces JOIN documents ON doc_id = key"""
_chunk_stats = f""", l AS (SELECT {_length} AS v FROM pieces),
    d AS (SELECT key, CAST(count(*) AS INTEGER) AS c FROM pieces GROUP BY key)
    SELECT (SELECT count(text) FROM documents) AS total_documents,
    (SELECT count(*) FROM l) AS total_chunks,
    (SELECT round(avg(c), 4) FROM d) AS avg_chunks_per_doc,
    (SELECT round(CAST(median(c) AS DOUBLE), 4) FROM d) AS median_chunks_per_doc,
    (SELECT max(c) FROM d) AS max_chunks_per_doc,
    (SELECT round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM documents), 4) FROM l) AS avg_chunks_per_row,
    round(avg(v), 4) AS mean, round(CAST(median(v) AS DOUBLE), 4) AS median,
    round(stddev_pop(v), 4) AS std, min(v) AS min, max(v) AS max,
    {", ".join(f"round(CAST(quantile_cont(v, 0.{p}) AS DOUBLE), 4) AS q{p}" for p in (25, 75, 90, 95))}
    FROM l"""
_chunk_targets = """SELECT n AS total_chunks, a AS within_10_percent, b AS within_20_percent,
    round(a / CAST(n AS DOUBLE) * 100, 4) AS percentage_within_10,
    round(b / CAST(n AS DOUBLE) * 100, 4) AS percentage_within_20 FROM (
    SELECT count(*) AS n, count(*) FILTER (length(chunk_text) BETWEEN 450 AND 550) AS a,
    count(*) FILTER (length(chunk_text) BETWEEN 400 AND 600) AS b FROM pieces)"""

CHUNKING = {
    "chunk_window": (chunked(WINDOW), windows(_chunk_rows)),
    "chunk_window_stats": (stats_of(WINDOW), windows(_chunk_stats)),
    "chunk_targets": (targets_of(WINDOW), windows(_chunk_targets)),
    "chunk_count_histogram": (
        count_histogram,
        windows("""SELECT CAST(bin AS INTEGER) AS bin, count(c) AS n
            FROM (SELECT unnest(range(1, 11)) AS bin) LEFT JOIN
            (SELECT least(count(*), 10) AS c FROM pieces GROUP BY key) ON c = bin GROUP BY bin"""),
    ),
    "chunk_histogram": (
        length_histogram, windows(histogram_sql(f"SELECT {_length} AS v FROM pieces", 40)),
    ),
    "chunk_by_words": (chunk_by_words, by_words_sql()),
    "chunk_recursive": (chunked(RECURSIVE), recursives(_chunk_rows)),
    "chunk_recursive_stats": (stats_of(RECURSIVE), recursives(_chunk_stats)),
    "chunk_recursive_targets": (targets_of(RECURSIVE), recursives(_chunk_targets)),
}


# --- vectors ------------------------------------------------------------------------------------
def hash_embed(spark, sf_dir):
    table = embed.embed_table(documents(spark, sf_dir, heavy=True), "text", embed.hashing_encoder(DIM))
    cells = table.select("doc_id", F.posexplode_outer("embedding").alias("position", "weight"))
    return cells.filter("weight <> 0").select("doc_id", "position", F.col("weight").cast("double"))


def vectors_sql(name: str, source: str, text: str, key: str) -> str:
    """``name(key, v)``: the hashed and normalised vector of each text as DOUBLE[]."""
    return f"""
    {name}_words AS (SELECT {key} AS key, unnest({q.words(f"lower({text})")}) AS w FROM {source}),
    {name}_cells AS (SELECT key, CAST(CAST('0x' || substr(md5(w), 1, 8) AS UBIGINT) % {DIM} AS INTEGER) AS position,
      count(*) AS n FROM {name}_words GROUP BY ALL),
    {name}_norms AS (SELECT key, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM {name}_cells GROUP BY key),
    {name}_weights AS (SELECT key, position, CAST(CAST(n / norm AS FLOAT) AS DOUBLE) AS weight
      FROM {name}_cells JOIN {name}_norms USING (key)),
    {name} AS (SELECT grid.key, list(coalesce(weight, 0.0) ORDER BY p) AS v
      FROM (SELECT {key} AS key, unnest(range(0, {DIM})) AS p FROM {source}) grid
      LEFT JOIN {name}_weights w ON w.key = grid.key AND w.position = grid.p GROUP BY grid.key)"""


def store_add(spark, sf_dir):
    """Store part of the chunks, then add all of them twice over, in one append."""
    rows = store.records(chunks(spark, sf_dir))
    table = store.VectorTable(spark, scratch_path(spark, "store_add"))
    table.add(rows.filter(F.col("product") < "p5"))
    table.add(rows.unionByName(rows))
    return table.read().select(
        "chunk_id", F.md5("chunk_text").alias("text_md5"), "product", "issue", "company",
        "original_index", "chunk_index", "chunk_length", F.size("embedding").alias("width"),
    )


def metadata_projection(spark, sf_dir):
    names = {"product": "Product", "issue": "Issue", "company": "Company", "state": "State"}
    raw = complaints(spark, sf_dir).select(
        "doc_id", F.col("date_received").alias("Date received"),
        F.col("complaint_id").alias("Complaint ID"), *[F.col(k).alias(v) for k, v in names.items()],
    )
    return store.project_metadata(raw)


def top_of(metric="l2", where=None, where_text=None):
    def run(spark, sf_dir):
        hits = nearest.nearest_to_vector(
            chunks(spark, sf_dir), VECTOR, 10, where, where_text, metric=metric, payload=["product"]
        )
        return rounded_columns(hits, 5, "distance")

    return run


def batch(**options):
    def run(spark, sf_dir):
        hits = nearest.nearest(chunks(spark, sf_dir), questions(spark, sf_dir), K, **options)
        return rounded_columns(hits, 5, "distance").select("question_id", "rank", "chunk_id", "distance")

    return run


def get_by_ids(spark, sf_dir):
    found = store.get_by_ids(chunks(spark, sf_dir), ["0_0", "7_0", "499_0", "nowhere"])
    return found.select("chunk_id", "product", "chunk_length")


def store_info(spark, sf_dir):
    table = store.VectorTable(spark, scratch_path(spark, "store_info"), "complaints")
    table.add(store.records(chunks(spark, sf_dir)))
    return table.info().select("collection_name", "document_count")


def reset_store(spark, sf_dir):
    """Counts of a table after a load, after a reset, and after a second load."""
    rows = store.records(chunks(spark, sf_dir))
    table = store.VectorTable(spark, scratch_path(spark, "reset_store"))
    first = table.add(rows)
    table.reset()
    empty = table.count()
    second = table.add(rows)
    steps = [("loaded", first), ("reset", empty), ("loaded again", second)]
    return spark.createDataFrame(steps, "step string, document_count long")


L2 = "pow(list_distance(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), 2)"
COSINE = "1 - list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def top_sql(distance: str = L2, condition: str = "TRUE") -> str:
    d = distance.format(a="embedding", b=str(VECTOR))
    return with_views(f"""
        SELECT CAST(row_number() OVER (ORDER BY d, chunk_id) AS INTEGER) AS rank, chunk_id,
        round(d, 5) AS distance, product
        FROM (SELECT *, {d} AS d FROM chunks WHERE {condition}) ORDER BY d, chunk_id LIMIT 10""", "chunks")


def hits_sql(condition: str = "TRUE", distance: str = L2) -> str:
    d = distance.format(a="embedding", b="question_embedding")
    return f""",
    hits AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY distance, chunk_id)
        AS INTEGER) AS rank FROM (SELECT question_id, chunk_id, chunk_text, product, issue, company,
        {d} AS distance FROM questions, chunks WHERE {condition})) WHERE rank <= {K})"""


def batch_sql(condition: str = "TRUE", distance: str = L2) -> str:
    return with_views(
        hits_sql(condition, distance)
        + "SELECT question_id, rank, chunk_id, round(distance, 5) AS distance FROM hits",
        "questions", "chunks",
    )


_own = "(product_filter IS NULL OR product_filter = product)"

VECTORS = {
    "hash_embed": (
        hash_embed,
        f"""WITH {vectors_sql("v", "documents", "text", "doc_id").rsplit(",\n    v AS", 1)[0]}
            SELECT key AS doc_id, position, weight FROM v_weights""",
    ),
    "store_add": (
        store_add,
        with_views("""
            SELECT chunk_id, md5(chunk_text) AS text_md5, product, issue, company, original_index,
            chunk_index, chunk_length, CAST(len(embedding) AS INTEGER) AS width FROM chunks""", "chunks"),
    ),
    "metadata_projection": (
        metadata_projection,
        over("""SELECT doc_id, coalesce(product, '') AS product, coalesce(issue, '') AS issue,
                coalesce(company, '') AS company, coalesce(state, '') AS state,
                coalesce(date_received, '') AS date_received, complaint_id FROM complaints"""),
    ),
    "topk_l2": (top_of(), top_sql()),
    "topk_cosine": (top_of("cosine"), top_sql(COSINE)),
    "topk_filtered": (top_of(where={"product": "p3"}), top_sql(condition="product = 'p3'")),
    "topk_text_filter": (
        top_of(where_text="tion"), top_sql(condition="contains(chunk_text, 'tion')"),
    ),
    "batch_topk": (batch(), batch_sql()),
    "batch_topk_cosine": (batch(metric="cosine"), batch_sql(distance=COSINE)),
    "batch_topk_own_filter": (
        batch(filter_col="product", question_filter="product_filter"), batch_sql(_own),
    ),
    "batch_topk_blocks": (batch(max_sent=7, chunks_per_block=100), batch_sql()),
    "get_by_ids": (
        get_by_ids,
        with_views("""
            SELECT chunk_id, product, chunk_length FROM chunks
            WHERE chunk_id IN ('0_0', '7_0', '499_0', 'nowhere')""", "chunks"),
    ),
    "store_info": (
        store_info,
        with_views("""
            SELECT 'complaints' AS collection_name, count(*) AS document_count FROM chunks""", "chunks"),
    ),
    "embedding_info": (
        lambda spark, sf_dir: embed.embedding_info(chunks(spark, sf_dir)),
        with_views("""
            SELECT CAST(len(embedding) AS INTEGER) AS dimension, count(*) AS count FROM chunks
            GROUP BY 1""", "chunks"),
    ),
    "reset_store": (
        reset_store,
        with_views("""
            SELECT 'loaded' AS step, count(*) AS document_count FROM chunks
            UNION ALL SELECT 'reset', 0 UNION ALL SELECT 'loaded again', count(*) FROM chunks""", "chunks"),
    ),
}


# --- answers ------------------------------------------------------------------------------------
PAYLOAD = ["chunk_text", "product", "issue", "company"]


def hits(spark, sf_dir) -> DataFrame:
    return nearest.nearest(chunks(spark, sf_dir), questions(spark, sf_dir), K, payload=PAYLOAD)


def answered(spark, sf_dir) -> DataFrame:
    return answer.assemble_answers(
        questions(spark, sf_dir), hits(spark, sf_dir), answers(spark, sf_dir)
    )


def without_hits(spark, sf_dir):
    """Every second question looks for a product that no chunk has."""
    nowhere = F.when(F.col("question_id") % 2 == 0, F.lit("nothing")).otherwise(F.col("product_filter"))
    asked = questions(spark, sf_dir).withColumn("wanted", nowhere)
    found = nearest.nearest(
        chunks(spark, sf_dir), asked, K, payload=PAYLOAD, filter_col="product", question_filter="wanted"
    )
    return answer.assemble_answers(asked, found, answers(spark, sf_dir))


def answers_no_hits(spark, sf_dir):
    return flat(without_hits(spark, sf_dir))


def evaluation_expected(spark, sf_dir):
    """Expected answers for the questions with a filter; the others have none."""
    asked = questions(spark, sf_dir).filter("product_filter IS NOT NULL")
    expected = asked.select("question_id", F.concat(F.lit("about "), "product_filter").alias("expected_answer"))
    rows = evaluate.evaluate(without_hits(spark, sf_dir), expected)
    return rows.select("question_id", "generated_answer", "num_sources", "expected_answer", "quality_score", "comments")


def report_file(spark, sf_dir):
    """The report written as a text file, read back and counted by line."""
    folder = scratch_path(spark, "report")
    lines = evaluate.report_lines(evaluated(spark, sf_dir))
    path = writers.write_lines(lines, f"{folder}/report.md", ["part", "question_id", "line_no"])
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def evaluated(spark, sf_dir) -> DataFrame:
    return evaluate.evaluate(answered(spark, sf_dir))


def context(spark, sf_dir):
    return answer.pack_context(hits(spark, sf_dir))


def prompt(template):
    def run(spark, sf_dir):
        rows = answer.prompts(answered(spark, sf_dir), template, ORGANISATION)
        return rows.select(
            "question_id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("prompt_length")
        )

    return run


def flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        "question_id", "question", "answer", F.md5("context").alias("context_md5"),
        F.size("sources").alias("num_sources"),
    )


def flat_answers(spark, sf_dir):
    return flat(answered(spark, sf_dir))


def flat_sources(spark, sf_dir):
    rows = answered(spark, sf_dir).select("question_id", F.inline("sources"))
    return rounded_columns(rows, 5, "distance")


def relevance(spark, sf_dir):
    score = answer.relevance(F.col("distance"))
    rows = hits(spark, sf_dir).select("question_id", "rank", score.alias("relevance"))
    return rounded_columns(rows, 5, "relevance")


def source_markdown(spark, sf_dir):
    return answer.source_markdown(answered(spark, sf_dir)).select("question_id", "source_markdown")


def evaluation(spark, sf_dir):
    sources = F.transform("retrieved_sources", lambda s: F.concat_ws(":", s["rank"], s["product"]))
    return evaluated(spark, sf_dir).withColumn("retrieved_sources", F.array_join(sources, ","))


def evaluation_table(spark, sf_dir):
    return evaluate.evaluation_table(evaluated(spark, sf_dir))


def evaluation_markdown(spark, sf_dir):
    return evaluate.report_lines(evaluated(spark, sf_dir))


def strip_prompt(spark, sf_dir):
    """Generated texts that repeat the question in front, for the questions with a filter."""
    rows = questions(spark, sf_dir).join(answers(spark, sf_dir), "question_id")
    repeated = F.when(
        F.col("product_filter").isNotNull(), F.concat("question", "answer")
    ).otherwise(F.col("answer"))
    return rows.select(
        "question_id", templates.without_prompt(repeated, F.col("question")).alias("answer")
    )


_context = f"""{hits_sql()},
    heads AS (SELECT *, concat('[Document ', rank, ']') AS tag,
      CASE WHEN coalesce(product, '') <> '' THEN concat(' Product: ', product) ELSE '' END AS p,
      CASE WHEN coalesce(issue, '') <> '' THEN concat(', Issue: ', issue) ELSE '' END AS i FROM hits),
    full_pieces AS (SELECT *, concat(tag, p, i, chr(10), chunk_text, chr(10)) AS piece FROM heads),
    sized AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY question_id ORDER BY rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM full_pieces),
    shown AS (SELECT question_id, rank, CASE WHEN used + length(piece) <= 2000 THEN piece
      WHEN used <= 2000 AND 2000 - used - length(tag) - 4 > 100 THEN concat(tag, p, chr(10),
        substring(chunk_text, 1, CAST(2000 - used - length(tag) - 4 AS BIGINT)), '...', chr(10)) END AS part FROM sized),
    contexts AS (SELECT question_id, coalesce(string_agg(part, chr(10) ORDER BY rank), '') AS context
      FROM shown GROUP BY question_id)"""
_answered = f"""{_context},
    named AS (SELECT question_id, rank, distance,
      CASE WHEN length(chunk_text) > 200 THEN concat(substring(chunk_text, 1, 200), '...') ELSE chunk_text END AS text,
      coalesce(product, 'Unknown') AS product, coalesce(issue, 'Unknown') AS issue,
      coalesce(company, 'Unknown') AS company FROM hits WHERE rank <= 3),
    counted AS (SELECT question_id, CAST(count(*) AS INTEGER) AS num_sources FROM named GROUP BY question_id),
    answered AS (SELECT q.question_id, q.question, coalesce(context, '') AS context,
      coalesce(num_sources, 0) AS num_sources,
      CASE WHEN num_sources IS NULL THEN {q.quoted(answer.NO_HITS_ANSWER)}
      ELSE {q.stripped(f"coalesce(answer, {q.quoted(answer.FAILED_ANSWER)})")} END AS answer
      FROM questions q LEFT JOIN contexts USING (question_id) LEFT JOIN counted USING (question_id)
      LEFT JOIN answers USING (question_id))"""


def answered_sql(sql: str) -> str:
    return with_views(f"{_answered}\n{sql}", "questions", "chunks", "answers")


def without_hits_sql(sql: str) -> str:
    """As ``answered_sql``, with the filters of ``without_hits``."""
    own = "question_id % 2 = 1 AND (product_filter IS NULL OR product_filter = product)"
    return answered_sql(sql).replace("FROM questions, chunks WHERE TRUE", f"FROM questions, chunks WHERE {own}")


def prompt_sql(template: str) -> str:
    text = templates.TEMPLATES[template].replace("{organisation}", ORGANISATION)
    before, rest = text.split("{context}")
    middle, after = rest.split("{question}")
    parts = f"concat({q.quoted(before)}, context, {q.quoted(middle)}, question, {q.quoted(after)})"
    return answered_sql(
        f"""SELECT question_id, md5(p) AS prompt_md5, CAST(length(p) AS INTEGER) AS prompt_length
            FROM (SELECT question_id, {parts} AS p FROM answered)"""
    )


def source_lines(line: str, joint: str) -> str:
    return f"""(SELECT question_id, string_agg({line}, {joint} ORDER BY rank) AS lines
        FROM named WHERE rank <= 2 GROUP BY question_id)"""


_block = """concat('#### Source ', rank, chr(10), chr(10), '**Product:** ', product, '  ', chr(10),
    '**Issue:** ', issue, '  ', chr(10), '**Company:** ', company, '  ', chr(10), '**Relevance:** ',
    printf('%.1f%%', round_even(greatest(0.0, least(1.0, 1 - distance)) * 1000, 0) / 10), '  ', chr(10),
    chr(10), '**Text Excerpt:**', chr(10), '> ', text, chr(10), chr(10), '---', chr(10), chr(10))"""
_head = "\n".join(
    f"SELECT 1 AS part, {i} AS line_no, replace({q.quoted(line)}, '{{count}}', "
    f"(SELECT CAST(count(*) AS VARCHAR) FROM answered)) AS line UNION ALL"
    for i, line in enumerate(evaluate.REPORT_HEAD)
)
_tail = "\nUNION ALL ".join(
    f"SELECT 3 AS part, {i} AS line_no, {q.quoted(line)} AS line"
    for i, line in enumerate(evaluate.REPORT_TAIL)
)

ANSWERS = {
    "context": (
        context, with_views(_context + "SELECT question_id, context FROM contexts", "questions", "chunks"),
    ),
    "prompt_default": (prompt("default"), prompt_sql("default")),
    "prompt_detailed": (prompt("detailed"), prompt_sql("detailed")),
    "prompt_concise": (prompt("concise"), prompt_sql("concise")),
    "answers": (
        flat_answers,
        answered_sql("""SELECT question_id, question, answer, md5(context) AS context_md5, num_sources
                        FROM answered"""),
    ),
    "sources": (
        flat_sources,
        answered_sql("""SELECT question_id, rank, text, product, issue, company,
                        round(distance, 5) AS distance FROM named"""),
    ),
    "relevance": (
        relevance,
        with_views(hits_sql() + """SELECT question_id, rank,
            round(greatest(0.0, least(1.0, 1 - distance)), 5) AS relevance FROM hits""", "questions", "chunks"),
    ),
    "source_markdown": (
        source_markdown,
        answered_sql(f"""SELECT question_id, concat({q.quoted(answer.SOURCES_TITLE)}, chr(10),
            string_agg({_block}, chr(10) ORDER BY rank)) AS source_markdown FROM named GROUP BY question_id"""),
    ),
    "evaluation": (
        evaluation,
        answered_sql(f"""SELECT question_id, question, answer AS generated_answer,
            lines AS retrieved_sources, num_sources, CAST(NULL AS VARCHAR) AS expected_answer,
            substring(context, 1, 500) AS context_used, CAST(NULL AS INTEGER) AS quality_score,
            '' AS comments FROM answered LEFT JOIN
            {source_lines("concat(rank, ':', product)", "','")} USING (question_id)"""),
    ),
    "evaluation_table": (
        evaluation_table,
        answered_sql(f"""SELECT question_id, question AS "Question",
            CASE WHEN length(answer) > 300 THEN concat(substring(answer, 1, 300), '...') ELSE answer END
            AS "Generated Answer", {q.stripped("lines")} AS "Retrieved Sources",
            CAST(NULL AS INTEGER) AS "Quality Score", '' AS "Comments/Analysis" FROM answered LEFT JOIN
            {source_lines("concat('Source ', rank, ' (', product, '): ', substring(text, 1, 100), '...')", "chr(10)")}
            USING (question_id)"""),
    ),
    "evaluation_markdown": (
        evaluation_markdown,
        answered_sql(f"""SELECT part, CAST(NULL AS BIGINT) AS question_id, line_no, line FROM (
            {_head} {_tail}) UNION ALL SELECT 2, question_id, 0,
            concat('| ', replace(question, '|', chr(92) || '|'), ' | ',
            replace(substring(answer, 1, 200), '|', chr(92) || '|'), '... | ', lines, ' | None |  |')
            FROM answered LEFT JOIN
            {source_lines("concat('**Source ', rank, '** (', product, '): ', substring(text, 1, 80), '...<br>')", "''")}
            USING (question_id)"""),
    ),
    "answers_no_hits": (
        answers_no_hits,
        without_hits_sql("""SELECT question_id, question, answer, md5(context) AS context_md5, num_sources
                            FROM answered"""),
    ),
    "evaluation_expected": (
        evaluation_expected,
        without_hits_sql("""SELECT question_id, answer AS generated_answer, num_sources,
            'about ' || product_filter AS expected_answer, CAST(NULL AS INTEGER) AS quality_score, '' AS comments
            FROM answered JOIN questions USING (question_id)"""),
    ),
    "strip_prompt": (
        strip_prompt,
        with_views(f"""
            SELECT question_id, CASE WHEN product_filter IS NOT NULL THEN {q.stripped("answer")}
            ELSE answer END AS answer FROM questions JOIN answers USING (question_id)""",
            "questions", "answers"),
    ),
}
ANSWERS["report_file"] = (
    report_file,
    f"""SELECT piece AS line, count(*) AS n FROM (SELECT unnest(string_split(line, chr(10))) AS piece
        FROM ({ANSWERS["evaluation_markdown"][1]})) GROUP BY piece""",
)


# --- jobs and round trips -----------------------------------------------------------------------
def index_params(**changes) -> JobParams:
    return JobParams(**{
        "key_col": "doc_id", "text_col": "narrative", "product_col": "product",
        "metadata": ["product", "issue", "company", "state", "date_received", "complaint_id"],
        "products": ["en", "fr", "de", "xx"], "sample_size": 333, "stratify_col": "product",
        "splitter": "window", "embedding_dim": DIM, **changes,
    })


NAMES = {c: c for c in ("product", "issue", "company", "state", "date_received", "complaint_id")}


def index_build_counts(spark, sf_dir):
    built = build_index(
        complaints(spark, sf_dir, heavy=True), index_params(), scratch_path(spark, "index"), metadata_names=NAMES
    )
    return built.counts


def index_build_overlap_75(spark, sf_dir):
    """The six-step form: recursive chunks, overlap 75, embeddings kept as a file."""
    built = build_index(
        complaints(spark, sf_dir, heavy=True), index_params(splitter="recursive", chunk_overlap=75),
        scratch_path(spark, "index75"), metadata_names=NAMES, save_embeddings=True, save_csv=False,
    )
    return built.counts


def preprocess_profile(spark, sf_dir):
    """The profile step of the job, over the filtered rows that its first stage wrote."""
    built = preprocess(
        complaints(spark, sf_dir), index_params(), scratch_path(spark, "profiled"), with_sample=False, with_profile=True
    )
    categories = built.profile["category_distribution"].select(F.lit("category").alias("part"), F.col("category").alias("name"), "n")
    lengths = built.profile["short_long_counts"].select(
        F.expr("stack(2, 'length', 'very_short', very_short_count, 'length', 'very_long', very_long_count) AS (part, name, n)")
    )
    return categories.unionByName(lengths).unionByName(built.counts.select(F.lit("stage").alias("part"), F.col("stage").alias("name"), F.col("rows").alias("n")))


def ask_table(spark, sf_dir):
    """One question against the hashed vectors of all documents."""
    rows = documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("chunk_text")
    )
    folder = scratch_path(spark, "ask")
    vectors = writers.written(embed.embed_table(rows, "chunk_text", embed.hashing_encoder(DIM)), f"{folder}/embedded")
    table = store.VectorTable(spark, f"{folder}/vectors")
    table.add(store.records(vectors))
    found = ask_once(table, QUESTION, embed.hashing_encoder(DIM), 10)
    return rounded_columns(found, 5, "distance").select("rank", "chunk_id", "distance")


def ingest_counts(spark, sf_dir):
    folder = scratch_path(spark, "ingest")
    path = writers.write_embeddings(chunks(spark, sf_dir), f"{folder}/embeddings.parquet")
    table = store.VectorTable(spark, f"{folder}/vectors")
    table.add(store.records(chunks(spark, sf_dir).filter(F.col("product") < "p5")))
    metadata = ["product", "issue", "company", "original_index", "chunk_index", "num_chunks", "chunk_length"]
    return ingest_embeddings(
        spark, [f"{folder}/nowhere.parquet", path], table, metadata=metadata
    )


def incremental_append(spark, sf_dir):
    folder = scratch_path(spark, "incremental")
    writers.write_embeddings(chunks(spark, sf_dir), f"{folder}/arrivals")
    arrivals = spark.read.parquet(f"{folder}/arrivals")
    table = store.VectorTable(spark, f"{folder}/vectors")
    added = [
        (run, append_new_files(spark, f"{folder}/arrivals", arrivals.schema, table, f"{folder}/checkpoint"))
        for run in (1, 2)
    ]
    return spark.createDataFrame(added, "run int, rows_added long")


def answer_batch_job(spark, sf_dir):
    """Documents to chunks to vectors to a stored table; benchmark texts as questions."""
    folder = scratch_path(spark, "answer_batch")
    params = index_params(
        key_col="doc_id", text_col="text", metadata=["lang", "source"], embedding_dim=DIM,
    )
    table = chunk.chunk_table(documents(spark, sf_dir, heavy=True), "text", "doc_id", WINDOW, ["lang", "source"])
    table = writers.written(table, f"{folder}/chunks")
    stored = store.VectorTable(spark, f"{folder}/vectors")
    vectors = writers.written(embed.embed_table(table, "chunk_text", embed.hashing_encoder(DIM)), f"{folder}/embedded")
    named = store.project_metadata(vectors, {"lang": "product", "issue": "issue", "source": "company"}, None)
    stored.add(store.records(named))
    asked = questions(spark, sf_dir).select("question_id", "question")
    return answer_batch(stored.read(), asked, params, answers(spark, sf_dir), organisation=ORGANISATION)


def flat_answer_batch(spark, sf_dir):
    return answer_batch_job(spark, sf_dir).select(
        "question_id", "answer", F.md5("prompt").alias("prompt_md5"),
        F.length("context").alias("context_length"), F.size("sources").alias("num_sources"),
    )


def csv_roundtrip(spark, sf_dir):
    rows = complaints(spark, sf_dir).drop("doc_id")
    path = writers.write_csv(rows, f"{scratch_path(spark, 'csv')}/complaints.csv")
    back = readers.read_csv(spark, path, readers.raw_schema(rows.columns))
    return back.withColumn("narrative", F.md5("narrative"))


def parquet_roundtrip(spark, sf_dir):
    rows = complaints(spark, sf_dir)
    folder = scratch_path(spark, "both")
    paths = writers.write_both(rows, folder, "filtered")
    back = readers.first_readable(spark, [f"{folder}/nowhere.parquet", paths["parquet"], paths["csv"]])
    return back.withColumn("narrative", F.md5("narrative"))


def parquet_copy(spark, sf_dir):
    """A CSV file read by way of its Parquet copy: made on the first call, used on the second."""
    folder = scratch_path(spark, "copy")
    rows = complaints(spark, sf_dir).select("complaint_id", "product", "state", "zip_code")
    csv_path = writers.write_csv(rows, f"{folder}/raw.csv")
    writers.parquet_copy(spark, csv_path, f"{folder}/raw.parquet")
    return writers.parquet_copy(spark, f"{folder}/gone.csv", f"{folder}/raw.parquet")


def embedding_roundtrip(spark, sf_dir):
    path = writers.write_embeddings(chunks(spark, sf_dir), f"{scratch_path(spark, 'embeddings')}/e.parquet")
    cells = spark.read.parquet(path).select("chunk_id", F.posexplode("embedding").alias("position", "value"))
    return cells.select("chunk_id", "position", F.col("value").cast("double").alias("value"))


_index = f""",
    stage2 AS (SELECT * FROM complaints WHERE product IN ('en', 'fr', 'de', 'xx')),
    stage3 AS (SELECT * FROM stage2 WHERE {q.real_text("narrative")}),
    c AS (SELECT product AS stratum, count(*) AS available, CAST(sum(count(*)) OVER () AS BIGINT) AS total
      FROM stage3 GROUP BY product),
    a AS (SELECT *, greatest(CAST(trunc(available / CAST(total AS DOUBLE) * 333) AS BIGINT), 1) AS base FROM c),
    r AS (SELECT *, 333 - sum(base) OVER () AS rest, row_number() OVER (ORDER BY base DESC, stratum) AS place FROM a),
    plan AS (SELECT stratum, least(available, CASE WHEN place <= rest THEN base + 1 ELSE base END) AS sampled FROM r),
    drawn AS (SELECT * FROM (SELECT stage3.*, sampled, (SELECT count(*) FROM stage3) < 333 AS whole,
      row_number() OVER (PARTITION BY product ORDER BY md5(concat('42-', CAST(doc_id AS VARCHAR))), doc_id) AS nth
      FROM stage3 JOIN plan ON product = stratum) WHERE whole OR nth <= sampled),
    """
_stage_counts = """
    SELECT 1 AS step, 'loaded' AS stage, count(*) AS rows FROM complaints
    UNION ALL SELECT 2, 'product_filter', count(*) FROM stage2
    UNION ALL SELECT 3, 'narrative_filter', count(*) FROM stage3
    UNION ALL SELECT 4, 'sample', count(*) FROM drawn
    UNION ALL SELECT 5, 'chunks', count(*) FROM pieces
    UNION ALL SELECT 6, 'vectors', count(*) FROM pieces"""

JOBS = {
    "index_build_counts": (
        index_build_counts,
        over(_index + window_sql("drawn", "narrative") + _stage_counts),
    ),
    "index_build_overlap_75": (
        index_build_overlap_75,
        over(_index + recursive_sql("drawn", "narrative", overlap=75) + _stage_counts),
    ),
    "ingest_counts": (
        ingest_counts,
        with_views("""
            SELECT count(*) FILTER (product < 'p5') AS rows_before,
            count(*) FILTER (product >= 'p5') AS rows_added, count(*) AS rows_after FROM chunks""", "chunks"),
    ),
    "incremental_append": (
        incremental_append,
        with_views("""
            SELECT 1 AS run, count(*) AS rows_added FROM chunks UNION ALL SELECT 2, 0""", "chunks"),
    ),
    "csv_roundtrip": (
        csv_roundtrip,
        over("""SELECT * EXCLUDE (doc_id) REPLACE (
                md5(CASE WHEN narrative NOT IN ('', 'nan') THEN narrative END) AS narrative) FROM complaints"""),
    ),
    "parquet_roundtrip": (
        parquet_roundtrip, over("SELECT * REPLACE (md5(narrative) AS narrative) FROM complaints"),
    ),
    "parquet_copy": (
        parquet_copy, over("SELECT complaint_id, product, state, zip_code FROM complaints"),
    ),
    "embedding_roundtrip": (
        embedding_roundtrip,
        with_views(f"""
            SELECT chunk_id, CAST(p AS INTEGER) AS position, CAST(embedding[p + 1] AS DOUBLE) AS value
            FROM chunks, (SELECT unnest(range(0, {DIM})) AS p)""", "chunks"),
    ),
}


def answer_batch_sql() -> str:
    """The whole way from documents to prompts in SQL: windows, hashed vectors, hits, contexts."""
    pieces = f"""{window_sql("documents")},
    stored AS (SELECT concat(key, '_', chunk_index) AS chunk_id, chunk_text, lang AS product,
      CAST(NULL AS VARCHAR) AS issue, source AS company FROM pieces JOIN documents ON doc_id = key),
    {vectors_sql("cv", "stored", "chunk_text", "chunk_id")},
    {vectors_sql("qv", "questions", "question", "question_id")},
    chunks AS (SELECT stored.*, cv.v AS embedding FROM stored JOIN cv ON key = chunk_id),
    asked AS (SELECT question_id, question, qv.v AS question_embedding FROM questions JOIN qv ON key = question_id)"""
    tail = _answered.replace("FROM questions, chunks", "FROM asked, chunks")
    return with_views(
        f""",\n{pieces}{tail}
        SELECT question_id, answer, md5(concat({", ".join(_prompt_parts())})) AS prompt_md5,
        CAST(length(context) AS INTEGER) AS context_length, num_sources FROM answered""",
        "questions", "answers",
    )


def _prompt_parts() -> list[str]:
    text = templates.TEMPLATES["default"].replace("{organisation}", ORGANISATION)
    before, rest = text.split("{context}")
    middle, after = rest.split("{question}")
    return [q.quoted(before), "context", q.quoted(middle), "question", q.quoted(after)]


JOBS["answer_batch"] = (flat_answer_batch, answer_batch_sql())
_stage3_words = f"SELECT {q.word_count('narrative')} AS v FROM stage3"
JOBS["preprocess_profile"] = (
    preprocess_profile,
    over(f"""{_index.rstrip().rstrip(",")}, l AS ({_stage3_words})
    SELECT 'category' AS part, product AS name, count(*) AS n FROM stage3 GROUP BY product
    UNION ALL SELECT 'length', 'very_short', count(*) FILTER (v < 10) FROM l
    UNION ALL SELECT 'length', 'very_long', count(*) FILTER (v > (SELECT quantile_cont(v, 0.95) FROM l)) FROM l
    UNION ALL SELECT 'stage', 'loaded', count(*) FROM complaints UNION ALL SELECT 'stage', 'product_filter', count(*) FROM stage2
    UNION ALL SELECT 'stage', 'narrative_filter', count(*) FROM stage3"""),
)
JOBS["ask_once"] = (
    ask_table,
    f"""WITH asked AS (SELECT 1 AS id, {q.quoted(QUESTION)} AS t),
    stored AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, coalesce(text, '') AS t FROM documents),
    {vectors_sql("cv", "stored", "t", "chunk_id")}, {vectors_sql("qv", "asked", "t", "id")}
    SELECT CAST(row_number() OVER (ORDER BY d, chunk_id) AS INTEGER) AS rank, chunk_id, round(d, 5) AS distance
    FROM (SELECT cv.key AS chunk_id, {L2.format(a="cv.v", b="qv.v")} AS d FROM cv, qv) ORDER BY d, chunk_id LIMIT 10""",
)

CHECKS = {**CHUNKING, **VECTORS, **ANSWERS, **JOBS}
