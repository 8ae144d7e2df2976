"""Queries over validation, cleaning, filters and profile, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as q
from checks.views import view, with_views
from narrata.functions import text as tx
from narrata.operators import clean, profile, sample, validate
from narrata.session import scratch_path

PRODUCTS = ["en", "fr", "de", "xx"]
LISTED = "('en', 'fr', 'de', 'xx')"
VIEW_COLUMNS = [
    "complaint_id", "doc_id", "product", "issue", "tags", "company", "state", "zip_code",
    "date_received", "narrative",
]
EXPECTED = ["complaint_id", "product", "sub_product", "narrative", "date_received", "date_sent"]
KEY = "md5(concat('42-', CAST(doc_id AS VARCHAR)))"


def complaints(spark, sf_dir, heavy=False):
    return view(spark, sf_dir, "complaints", heavy)


def over(sql: str) -> str:
    return with_views("\n" + sql, "complaints")


def rounded_columns(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def text_query(expression, column: str = "narrative"):
    """Apply a text expression to the complaints and return hash and length."""

    def run(spark, sf_dir):
        t = complaints(spark, sf_dir, heavy=True).select("doc_id", expression(F.col(column)).alias("t"))
        return t.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("text_length"))

    return run


def on(function, *args, **kwargs):
    return lambda spark, sf_dir: function(complaints(spark, sf_dir), *args, **kwargs)


# --- validation ---------------------------------------------------------------------------------
def validate_shape(spark, sf_dir):
    return validate.shape(complaints(spark, sf_dir)).withColumn("columns", F.array_join("columns", ","))


def duplicate_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return validate.duplicate_rows(docs.drop("doc_id"))


def shape_summary(spark, sf_dir):
    raw = complaints(spark, sf_dir)
    done = clean.remove_empty_narratives(raw, "narrative")
    return validate.shape_change(raw, clean.select_columns(done, ["doc_id", "product", "narrative"]))


def low_cardinality(spark, sf_dir):
    return validate.low_cardinality(
        complaints(spark, sf_dir), exclude=["narrative", "date_received"]
    )


_null_counts = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM complaints"
    for c in VIEW_COLUMNS
)
_expected = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, {str(c in VIEW_COLUMNS).upper()} AS present, "
    f"CAST({'count(' + c + ')' if c in VIEW_COLUMNS else 'count(NULL)'} AS BIGINT) AS non_null FROM complaints"
    for i, c in enumerate(EXPECTED, 1)
)
_ratios = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, "
    f"count(DISTINCT {c}) / CAST(count(*) AS DOUBLE) AS unique_ratio FROM complaints"
    for c in VIEW_COLUMNS if c not in ("doc_id", "narrative", "date_received")
)

VALIDATION = {
    "validate_shape": (
        validate_shape,
        over(f"""SELECT count(*) AS row_count, {len(VIEW_COLUMNS)} AS column_count,
                 '{",".join(VIEW_COLUMNS)}' AS columns, count(*) > 0 AS is_valid FROM complaints"""),
    ),
    "null_counts": (on(validate.null_counts), over(_null_counts)),
    "duplicate_rows": (
        duplicate_rows,
        """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
           FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)""",
    ),
    "missing_columns": (on(validate.expected_column_report, EXPECTED), over(_expected)),
    "low_cardinality": (
        low_cardinality, over(f"SELECT * FROM ({_ratios}) WHERE unique_ratio < 0.5"),
    ),
    "shape_summary": (
        shape_summary,
        over(f"""SELECT count(*) AS original_rows, {len(VIEW_COLUMNS)} AS original_columns,
                 count(*) FILTER ({q.real_text("narrative")}) AS current_rows, 3 AS current_columns,
                 count(*) - count(*) FILTER ({q.real_text("narrative")}) AS rows_removed,
                 {len(VIEW_COLUMNS) - 3} AS columns_removed FROM complaints"""),
    ),
}


# --- cleaning -----------------------------------------------------------------------------------
def dedup(keep):
    def run(spark, sf_dir):
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        kept = clean.remove_duplicates(docs, ["text"], keep, key="doc_id")
        return kept.select("doc_id", "lang", "n_chars")

    return run


def dedup_sql(condition: str, order: str = "") -> str:
    return f"""SELECT doc_id, lang, n_chars FROM (SELECT *,
        row_number() OVER (PARTITION BY text ORDER BY doc_id {order}) AS place,
        count(*) OVER (PARTITION BY text) AS copies FROM documents) WHERE {condition}"""


def cleaning_effect_written(spark, sf_dir):
    """The effect counted by the write of the cleaned table, and the texts found in that table."""
    rows, counts = clean.write_cleaned(complaints(spark, sf_dir), "narrative", scratch_path(spark, "cleaned"))
    return rows.agg(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()], F.count("narrative").alias("written"))


def cleaning_effect(spark, sf_dir):
    text = F.col("narrative")
    return clean.cleaning_effect(complaints(spark, sf_dir, heavy=True), text, tx.clean_text(text))


def drop_all_null(spark, sf_dir):
    kept = clean.handle_missing(complaints(spark, sf_dir), "drop", ["issue", "tags", "product"])
    return kept.select("doc_id", "product", "issue", "tags")


def fill_nulls(spark, sf_dir):
    filled = clean.handle_missing(
        complaints(spark, sf_dir), "fill", ["issue", "tags", "absent"], "unknown"
    )
    return filled.select("doc_id", "product", "issue", "tags")


def standardize_dates(spark, sf_dir):
    parsed = clean.standardize_dates(complaints(spark, sf_dir), formats=["yyyy-MM-dd", "MM/dd/yyyy"])
    return parsed.select("doc_id", F.date_format("date_received", "yyyy-MM-dd").alias("day"))


def valid_dates(spark, sf_dir):
    return clean.valid_dates(clean.standardize_dates(complaints(spark, sf_dir)))


def derived_features(spark, sf_dir):
    return clean.add_derived_features(complaints(spark, sf_dir, heavy=True), "narrative").select(
        "doc_id", "narrative_word_count", "narrative_char_count", "has_narrative"
    )


_day = "coalesce(try_strptime(date_received, '%Y-%m-%d'), try_strptime(date_received, '%m/%d/%Y'))"
_n = "narrative"

CLEANING = {
    "dedup_first": (dedup("first"), dedup_sql("place = 1")),
    "dedup_last": (dedup("last"), dedup_sql("place = 1", "DESC")),
    "dedup_none": (dedup(False), dedup_sql("copies = 1")),
    "clean_narratives": (
        text_query(tx.clean_narrative), over(q.text_result(q.clean_narrative(_n), "complaints")),
    ),
    "lower_text": (text_query(F.lower), over(q.text_result(f"lower({_n})", "complaints"))),
    "strip_urls": (
        text_query(tx.remove_urls), over(q.text_result(q.replaced(_n, q.URL), "complaints")),
    ),
    "strip_emails": (
        text_query(tx.remove_emails), over(q.text_result(q.replaced(_n, q.EMAIL), "complaints")),
    ),
    "strip_phones": (
        text_query(tx.remove_phones), over(q.text_result(q.replaced(_n, q.PHONE), "complaints")),
    ),
    "strip_boilerplate": (
        text_query(tx.remove_boilerplate),
        over(q.text_result(q.without_boilerplate(_n), "complaints")),
    ),
    "strip_special": (
        text_query(tx.remove_special), over(q.text_result(q.replaced(_n, q.SPECIAL), "complaints")),
    ),
    "strip_special_keep_punct": (
        text_query(lambda c: tx.remove_special(c, preserve_punctuation=True)),
        over(q.text_result(q.replaced(_n, q.SPECIAL_KEEP_PUNCTUATION), "complaints")),
    ),
    "normalize_ws": (
        text_query(tx.normalize_whitespace), over(q.text_result(q.normalized(_n), "complaints")),
    ),
    "clean_text": (
        text_query(tx.clean_text), over(q.text_result(q.clean_text(_n), "complaints")),
    ),
    "cleaning_effect_written": (
        cleaning_effect_written,
        over(f"""SELECT count(raw) AS before, count(cleaned) AS after, count(*) - count(cleaned) AS empty_after,
            count(*) FILTER (raw IS NOT NULL AND cleaned IS NULL) AS emptied, count(cleaned) AS written
            FROM (SELECT narrative AS raw, {q.clean_text("narrative")} AS cleaned FROM complaints)"""),
    ),
    "cleaning_effect": (
        cleaning_effect,
        over(f"""SELECT count(narrative) AS before, count(c) AS "after",
                 count(*) - count(c) AS empty_after,
                 count(*) FILTER (narrative IS NOT NULL AND c IS NULL) AS emptied
                 FROM (SELECT narrative, {q.clean_text(_n)} AS c FROM complaints)"""),
    ),
    "drop_all_null": (
        drop_all_null,
        over("""SELECT doc_id, product, issue, tags FROM complaints
                WHERE coalesce(issue, tags, product) IS NOT NULL"""),
    ),
    "fill_nulls": (
        fill_nulls,
        over("""SELECT doc_id, product, coalesce(issue, 'unknown') AS issue,
                coalesce(tags, 'unknown') AS tags FROM complaints"""),
    ),
    "standardize_dates": (
        standardize_dates,
        over(f"SELECT doc_id, strftime({_day}, '%Y-%m-%d') AS day FROM complaints"),
    ),
    "valid_dates": (
        valid_dates,
        over(f"SELECT 'date_received' AS column_name, count({_day}) AS valid_dates FROM complaints"),
    ),
    "derived_features": (
        derived_features,
        over(f"""SELECT doc_id, {q.word_count(_n)} AS narrative_word_count,
                 CAST(coalesce(length(narrative), 0) AS INTEGER) AS narrative_char_count,
                 {q.has_text(_n)} AS has_narrative FROM complaints"""),
    ),
}


# --- filters ------------------------------------------------------------------------------------
def filter_products(spark, sf_dir):
    kept = clean.filter_by_products(complaints(spark, sf_dir), PRODUCTS, "product")
    return kept.select("doc_id", "product", "company")


def kept_share(spark, sf_dir):
    kept = clean.filter_by_products(complaints(spark, sf_dir), PRODUCTS, "product")
    return clean.kept_share(kept, "product")


def remove_empty(spark, sf_dir):
    kept = clean.remove_empty_narratives(complaints(spark, sf_dir), "narrative")
    return kept.select("doc_id", F.md5("narrative").alias("text_md5"))


def by_conditions(keep):
    def run(spark, sf_dir):
        rules = {"product": ["en", "fr"], "issue": "good", "absent": 1}
        kept = clean.filter_by_conditions(complaints(spark, sf_dir), rules, keep)
        return kept.select("doc_id", "product", "issue")

    return run


def select_present(spark, sf_dir):
    return clean.select_columns(complaints(spark, sf_dir), ["doc_id", "nowhere", "state", "zip_code"])


FILTERS = {
    "filter_products": (
        filter_products,
        over(f"SELECT doc_id, product, company FROM complaints WHERE product IN {LISTED}"),
    ),
    "absent_products": (
        on(clean.absent_values, PRODUCTS, "product"),
        over("""SELECT CAST(position AS INTEGER) AS position, value
                FROM (VALUES (1, 'en'), (2, 'fr'), (3, 'de'), (4, 'xx')) listed(position, value)
                WHERE value NOT IN (SELECT product FROM complaints WHERE product IS NOT NULL)"""),
    ),
    "kept_share": (
        kept_share,
        over(f"""SELECT product AS value, n, {q.rounded("n / total * 100", 2)} AS percent FROM (
                 SELECT product, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total
                 FROM complaints WHERE product IN {LISTED} GROUP BY product)"""),
    ),
    "remove_empty": (
        remove_empty,
        over(f"""SELECT doc_id, md5(narrative) AS text_md5 FROM complaints
                 WHERE {q.real_text("narrative")}"""),
    ),
    "filter_all_conditions": (
        by_conditions(True),
        over("""SELECT doc_id, product, issue FROM complaints
                WHERE product IN ('en', 'fr') AND issue = 'good'"""),
    ),
    "drop_any_condition": (
        by_conditions(False),
        over("""SELECT doc_id, product, issue FROM complaints
                WHERE coalesce(product NOT IN ('en', 'fr'), TRUE) AND coalesce(issue <> 'good', TRUE)"""),
    ),
    "select_present": (select_present, over("SELECT doc_id, state, zip_code FROM complaints")),
    "filter_funnel": (
        on(clean.filter_funnel, PRODUCTS, "product", "narrative"),
        over(f"""SELECT a AS initial_count, b AS after_product_filter, c AS after_narrative_filter,
                 a - b AS removed_by_product, b - c AS removed_by_narrative, a - c AS total_removed,
                 c / CAST(a AS DOUBLE) * 100 AS retention_rate FROM (
                 SELECT count(*) AS a, count(*) FILTER (product IN {LISTED}) AS b,
                 count(*) FILTER (product IN {LISTED} AND {q.real_text("narrative")}) AS c
                 FROM complaints)"""),
    ),
}


# --- profile ------------------------------------------------------------------------------------
def length_stats(spark, sf_dir):
    names = ["mean", "median", "std", "q25", "q75", "q90", "q95", "q99"]
    return rounded_columns(profile.length_stats(complaints(spark, sf_dir, heavy=True), "narrative"), 4, *names)


def short_long(spark, sf_dir):
    return rounded_columns(
        profile.short_long_counts(complaints(spark, sf_dir, heavy=True), "narrative"), 4, "very_long_threshold"
    )


def length_histogram(spark, sf_dir):
    table = profile.length_histogram(complaints(spark, sf_dir, heavy=True), "narrative")
    return rounded_columns(table, 4, "from_value", "to_value", "mean", "median")


def length_boxplot(spark, sf_dir):
    boxes = profile.length_boxplot(complaints(spark, sf_dir, heavy=True), "narrative", "product")
    return rounded_columns(boxes, 4, "q1", "median", "q3")


def share_comparison(spark, sf_dir):
    raw = complaints(spark, sf_dir)
    return profile.share_comparison(raw, clean.remove_empty_narratives(raw, "narrative"), "product")


def distribution_sql(source: str, column: str, digits: int = 2) -> str:
    share = q.rounded("n / total * 100", digits)
    return f"""SELECT category, n, {share} AS percent FROM (
        SELECT {column} AS category, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total
        FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"""


def histogram_sql(values: str, bins: int) -> str:
    """``values`` selects one column ``v``."""
    return f"""
    , given AS ({values}),
    box AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE CAST(min(v) AS DOUBLE) END AS low,
      CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE CAST(max(v) AS DOUBLE) END AS high,
      avg(v) AS mean, median(v) AS median FROM given),
    placed AS (SELECT least(CAST(floor(CAST({bins} AS DOUBLE) * (v - low) / (high - low)) AS INTEGER) + 1,
      {bins}) AS bin, count(*) AS n FROM given, box GROUP BY 1)
    SELECT CAST(b.bin AS INTEGER) AS bin, round(low + (b.bin - 1) * ((high - low) / {bins}), 4) AS from_value,
      round(low + b.bin * ((high - low) / {bins}), 4) AS to_value, coalesce(n, 0) AS n,
      round(mean, 4) AS mean, round(CAST(median AS DOUBLE), 4) AS median
    FROM (SELECT unnest(range(1, {bins + 1})) AS bin) b LEFT JOIN placed USING (bin), box"""


_lengths = f"SELECT {q.word_count(_n)} AS v FROM complaints WHERE {q.has_text(_n)}"

PROFILE = {
    "category_distribution": (
        on(profile.category_distribution, "product"), over(distribution_sql("complaints", "product")),
    ),
    "category_bars": (
        on(profile.category_bars, "product"),
        over(f"""SELECT category, n, {q.rounded("n / total * 100", 1)} AS percent FROM (
                 SELECT product AS category, count(*) AS n,
                 CAST(sum(count(*)) OVER () AS DOUBLE) AS total
                 FROM complaints GROUP BY product) WHERE category IS NOT NULL"""),
    ),
    "distribution_headline": (
        on(profile.distribution_headline, "product"),
        over(f""", d AS ({distribution_sql("complaints", "product")})
                 SELECT (SELECT count(*) FROM d) AS total_values,
                 top.category AS most_common, top.n AS most_common_count,
                 top.percent AS most_common_percent, low.category AS least_common,
                 low.n AS least_common_count, low.percent AS least_common_percent,
                 (SELECT CAST(median(n) AS DOUBLE) FROM d) AS median_count
                 FROM (SELECT * FROM d ORDER BY n DESC, category LIMIT 1) top,
                 (SELECT * FROM d ORDER BY n, category DESC LIMIT 1) low"""),
    ),
    "length_counts": (
        on(profile.length_counts, "narrative"),
        over(f"""SELECT count(*) AS total_rows,
                 count(*) FILTER ({q.has_text(_n)}) AS rows_with_narratives,
                 count(*) FILTER (NOT {q.has_text(_n)}) AS rows_without_narratives FROM complaints"""),
    ),
    "length_stats": (
        length_stats,
        over(f"""SELECT round(avg(v), 4) AS mean, round(CAST(median(v) AS DOUBLE), 4) AS median,
                 round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max,
                 {", ".join(f"round(CAST(quantile_cont(v, 0.{p}) AS DOUBLE), 4) AS q{p}" for p in (25, 75, 90, 95, 99))}
                 FROM ({_lengths})"""),
    ),
    "short_long_counts": (
        short_long,
        over(f""", l AS ({_lengths}), t AS (SELECT CAST(quantile_cont(v, 0.95) AS DOUBLE) AS q95 FROM l)
                 SELECT count(*) FILTER (v < 10) AS very_short_count,
                 round(max(q95), 4) AS very_long_threshold,
                 count(*) FILTER (v > q95) AS very_long_count FROM l, t"""),
    ),
    "presence": (
        on(profile.presence, "narrative"),
        over(f"""SELECT t AS total, w AS with_count, {q.rounded("w / CAST(t AS DOUBLE) * 100", 2)} AS with_percent,
                 t - w AS without_count,
                 {q.rounded("(t - w) / CAST(t AS DOUBLE) * 100", 2)} AS without_percent
                 FROM (SELECT count(*) AS t, count(*) FILTER ({q.has_text(_n)}) AS w FROM complaints)"""),
    ),
    "missing_blank": (
        on(profile.missing_blank, "narrative"),
        over(f"""SELECT count(*) FILTER (narrative IS NULL) AS missing,
                 count(*) FILTER (NOT {q.not_blank(_n)}) AS blank FROM complaints"""),
    ),
    "length_histogram": (
        length_histogram,
        over(histogram_sql(
            f"SELECT {q.word_count(_n)} AS v FROM complaints WHERE narrative IS NOT NULL", 50)),
    ),
    "length_boxplot": (
        length_boxplot,
        over(f""", l AS (SELECT product AS category, {q.word_count(_n)} AS v FROM complaints
                 WHERE product IS NOT NULL AND narrative IS NOT NULL),
                 b AS (SELECT category, count(*) AS total, quantile_cont(CAST(v AS DOUBLE), 0.25) AS q1,
                   quantile_cont(CAST(v AS DOUBLE), 0.5) AS median,
                   quantile_cont(CAST(v AS DOUBLE), 0.75) AS q3 FROM l GROUP BY category),
                 m AS (SELECT l.*, b.* EXCLUDE (category),
                   v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
                   FROM l JOIN b USING (category))
                 SELECT category, total, round(q1, 4) AS q1, round(median, 4) AS median,
                 round(q3, 4) AS q3, min(v) FILTER (inside) AS whisker_low,
                 max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
                 FROM m GROUP BY category, total, q1, median, q3"""),
    ),
    "share_comparison": (
        share_comparison,
        over(f""", a AS ({distribution_sql("complaints", "product")}),
                 kept AS (SELECT * FROM complaints WHERE {q.real_text("narrative")}),
                 b AS ({distribution_sql("kept", "product")})
                 SELECT category, coalesce(a.n, 0) AS original_n,
                 coalesce(a.percent, 0) AS original_percent, coalesce(b.n, 0) AS sample_n,
                 coalesce(b.percent, 0) AS sample_percent FROM a FULL JOIN b USING (category)"""),
    ),
}


# --- samples ------------------------------------------------------------------------------------
SIZE = 333


def allocation(column, n, least):
    def run(spark, sf_dir):
        counts = sample.strata_counts(complaints(spark, sf_dir), column)
        return sample.allocation(counts, n, least)

    return run


def stratified(spark, sf_dir):
    return sample.stratified_sample(complaints(spark, sf_dir), SIZE, "product", "doc_id")


def stratified_sample(spark, sf_dir):
    return stratified(spark, sf_dir).select("doc_id", "product")


def sampling_report(spark, sf_dir):
    report = sample.sampling_report(complaints(spark, sf_dir), stratified(spark, sf_dir), "product")
    return rounded_columns(report, 4, "difference_pct")


def sampling_stats(spark, sf_dir):
    stats = sample.sampling_stats(
        complaints(spark, sf_dir), stratified(spark, sf_dir), "product", SIZE
    )
    return rounded_columns(stats, 4, "sampling_ratio", "max_difference", "mean_difference")


def simple_sample(spark, sf_dir):
    return sample.simple_sample(complaints(spark, sf_dir), SIZE, "doc_id").select("doc_id", "company")


def prefix_sample(spark, sf_dir):
    return sample.prefix_sample(complaints(spark, sf_dir), 50, "doc_id").select("doc_id", "company")


def allocation_sql(column: str, n: int, least: int) -> str:
    return f"""
    , c AS (SELECT {column} AS stratum, count(*) AS available,
        CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM complaints GROUP BY {column}),
    a AS (SELECT *, greatest(CAST(trunc(available / CAST(total AS DOUBLE) * {n}) AS BIGINT), {least}) AS base
        FROM c WHERE stratum IS NOT NULL),
    r AS (SELECT *, CAST({n} - sum(base) OVER () AS BIGINT) AS rest,
        row_number() OVER (ORDER BY base DESC, stratum) AS place,
        coalesce(CAST(sum(base - {least}) OVER (ORDER BY base, stratum
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before FROM a),
    allocated AS (SELECT stratum, available, total, CAST(CASE
        WHEN rest > 0 AND place <= rest THEN base + 1
        WHEN rest < 0 THEN base - greatest(0, least(base - {least}, -rest - before))
        ELSE base END AS BIGINT) AS requested FROM r),
    plan AS (SELECT *, least(requested, available) AS sampled FROM allocated)"""


_drawn = f"""{allocation_sql("product", SIZE, 1)},
    drawn AS (SELECT doc_id, product FROM (SELECT doc_id, product, sampled,
        (SELECT count(*) FROM complaints) < {SIZE} AS whole,
        row_number() OVER (PARTITION BY product ORDER BY {KEY}, doc_id) AS place
        FROM complaints LEFT JOIN plan ON product = stratum) WHERE whole OR place <= sampled)"""
_shares = f"""{_drawn},
    o AS (SELECT product AS stratum, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total
        FROM complaints GROUP BY product),
    s AS (SELECT product AS stratum, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total
        FROM drawn GROUP BY product),
    report AS (SELECT o.stratum, o.n AS original_count,
        {q.rounded("o.n / o.total * 100", 2)} AS original_pct, coalesce(s.n, 0) AS sample_count,
        coalesce({q.rounded("s.n / s.total * 100", 2)}, 0) AS sample_pct
        FROM o LEFT JOIN s USING (stratum) WHERE o.stratum IS NOT NULL)"""

SAMPLES = {
    "allocation": (
        allocation("product", SIZE, 1), over(allocation_sql("product", SIZE, 1) + " SELECT * FROM plan"),
    ),
    "allocation_minimum": (
        allocation("company", 70, 5), over(allocation_sql("company", 70, 5) + " SELECT * FROM plan"),
    ),
    "allocation_reduced": (
        allocation("product", 41, 9), over(allocation_sql("product", 41, 9) + " SELECT * FROM plan"),
    ),
    "stratified_sample": (stratified_sample, over(_drawn + " SELECT * FROM drawn")),
    "sampling_report": (
        sampling_report,
        over(_shares + """ SELECT *, round(sample_pct - original_pct, 4) AS difference_pct FROM report"""),
    ),
    "sampling_stats": (
        sampling_stats,
        over(_shares + f""" SELECT a AS original_size, b AS sample_size,
             CAST({SIZE} AS BIGINT) AS target_size, round(b / CAST(a AS DOUBLE) * 100, 4) AS sampling_ratio,
             b BETWEEN 10000 AND 15000 AS within_target_range, max_difference, mean_difference
             FROM (SELECT (SELECT count(*) FROM complaints) AS a, (SELECT count(*) FROM drawn) AS b,
               round(max(abs(sample_pct - original_pct)), 4) AS max_difference,
               round(avg(abs(sample_pct - original_pct)), 4) AS mean_difference FROM report)"""),
    ),
    "request_summary": (
        on(sample.request_summary, SIZE, "product"),
        over(allocation_sql("product", SIZE, 1) + f"""
             SELECT stratum, requested, sampled, available,
             {q.rounded("available / CAST(total AS DOUBLE) * 100", 2)} AS percent FROM plan
             WHERE sampled > 0"""),
    ),
    "simple_sample": (
        simple_sample,
        over(f"SELECT doc_id, company FROM complaints ORDER BY {KEY}, doc_id LIMIT {SIZE}"),
    ),
    "prefix_sample": (
        prefix_sample,
        over(f"""SELECT doc_id, company FROM (SELECT * FROM complaints ORDER BY doc_id LIMIT 150)
                 ORDER BY {KEY}, doc_id LIMIT 50"""),
    ),
}

CHECKS = {**VALIDATION, **CLEANING, **FILTERS, **PROFILE, **SAMPLES}
