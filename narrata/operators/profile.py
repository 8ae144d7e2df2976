"""Exploratory profile: category shares, text lengths, histograms, box plots.

Lengths are first counted per distinct value. That table has at most one row per possible length,
so means, exact percentiles and histograms come from it and the data is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import text as tx
from narrata.operators import validate
from narrata.session import pinned_if_small, scratch_path


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def category_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percent per value. Nulls are left out of both."""
    counts = (
        df.filter(_q(column).isNotNull())
        .groupBy(_q(column).alias("category"))
        .agg(F.count("*").alias("n"))
    )
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select(
        "category", "n", tx.round_even(F.col("n") / total * 100, 2).alias("percent")
    )


def distribution_headline(df: DataFrame, column: str) -> DataFrame:
    """Number of values, most and least common value, median count. Ties go by name."""
    counts = category_distribution(df, column)
    ranked = F.struct((-F.col("n")).alias("negative"), "category", "percent")
    top = counts.agg(
        F.count("*").alias("total_values"),
        F.min(ranked).alias("most"),
        F.max(ranked).alias("least"),
        F.median("n").alias("median_count"),
    )
    return top.select(
        "total_values",
        F.col("most.category").alias("most_common"),
        (-F.col("most.negative")).alias("most_common_count"),
        F.col("most.percent").alias("most_common_percent"),
        F.col("least.category").alias("least_common"),
        (-F.col("least.negative")).alias("least_common_count"),
        F.col("least.percent").alias("least_common_percent"),
        "median_count",
    )


def category_bars(df: DataFrame, column: str) -> DataFrame:
    """The bar-chart table: counts in falling order, percent of all rows to one decimal."""
    counts = df.groupBy(_q(column).alias("category")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    percent = tx.round_even(F.col("n") / total * 100, 1)
    return (
        counts.filter("category IS NOT NULL")
        .select("category", "n", percent.alias("percent"))
        .orderBy(F.desc("n"), "category")
    )


def value_counts(values: DataFrame, *by: str) -> DataFrame:
    """Rows per distinct ``value`` (and group). The input of the statistics below."""
    return values.groupBy(*by, "value").agg(F.count("*").alias("n"))


def weighted_stats(quantiles: dict[str, float], sample_std: bool = True) -> list[Column]:
    """Mean, median, standard deviation, range and exact quantiles over (value, n) rows."""
    value, n = F.col("value").cast("double"), F.col("n")
    total, linear, square = F.sum(n), F.sum(value * n), F.sum(value * value * n)
    divisor = F.nullif(total - (1 if sample_std else 0), F.lit(0))
    variance = F.greatest((square - linear * linear / total) / divisor, F.lit(0.0))
    return [
        (linear / total).alias("mean"),
        F.percentile("value", F.lit(0.5), n).alias("median"),
        F.when(divisor.isNotNull(), F.sqrt(variance)).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *[F.percentile("value", F.lit(p), n).alias(name) for name, p in quantiles.items()],
    ]


def _word_lengths(df: DataFrame, text_col: str) -> DataFrame:
    text = _q(text_col)
    return value_counts(df.filter(tx.has_text(text)).select(tx.word_count(text).alias("value")))


def length_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Rows in total, with text and without."""
    return _length_counts(df.select(tx.has_text(_q(text_col)).alias("present"), F.lit(1).alias("n")))


def _length_counts(rows: DataFrame) -> DataFrame:
    """The same from (present, n) rows."""
    return rows.agg(
        _total(F.lit(True)).alias("total_rows"),
        _total(F.col("present")).alias("rows_with_narratives"),
        _total(~F.col("present")).alias("rows_without_narratives"),
    )


def _total(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")


def length_stats(df: DataFrame, text_col: str) -> DataFrame:
    """Word-count statistics of the texts that are present. All null when there is none."""
    return _length_stats(_word_lengths(df, text_col))


def _length_stats(lengths: DataFrame) -> DataFrame:
    quantiles = {"q25": 0.25, "q75": 0.75, "q90": 0.90, "q95": 0.95, "q99": 0.99}
    return lengths.agg(*weighted_stats(quantiles))


def short_long_counts(df: DataFrame, text_col: str, short: int = 10) -> DataFrame:
    """Texts under ``short`` words, the 95th percentile, and texts above it."""
    return _short_long_counts(_word_lengths(df, text_col), short)


def _short_long_counts(lengths: DataFrame, short: int = 10) -> DataFrame:
    q95 = lengths.agg(F.percentile("value", F.lit(0.95), F.col("n")).alias("q95")).scalar()
    marked = lengths.select("value", "n", q95.alias("threshold"))
    return marked.agg(
        _total(F.col("value") < short).alias("very_short_count"),
        F.max("threshold").alias("very_long_threshold"),
        _total(F.col("value") > F.col("threshold")).alias("very_long_count"),
    )


def presence(df: DataFrame, text_col: str) -> DataFrame:
    """Counts and percentages with and without text."""
    return _presence(df.select(tx.has_text(_q(text_col)).alias("present"), F.lit(1).alias("n")))


def _presence(rows: DataFrame) -> DataFrame:
    """The same from (present, n) rows."""
    total = F.nullif("total", F.lit(0))
    return _length_counts(rows).toDF("total", "with_count", "without_count").select(
        "total",
        "with_count",
        tx.round_even(F.col("with_count") / total * 100, 2).alias("with_percent"),
        "without_count",
        tx.round_even(F.col("without_count") / total * 100, 2).alias("without_percent"),
    )


def missing_blank(df: DataFrame, text_col: str) -> DataFrame:
    """Null texts, and texts that are there but blank."""
    text = _q(text_col)
    return df.agg(
        F.count_if(text.isNull()).alias("missing"),
        F.count_if(F.coalesce(tx.is_blank(text), F.lit(False))).alias("blank"),
    )


def histogram(lengths: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins over (value, n) rows, empty bins included, with mean and median.

    The last bin holds the maximum. When all values are equal the range is widened by a half on
    each side.
    """
    frame = lengths.agg(
        F.min("value").cast("double").alias("low"),
        F.max("value").cast("double").alias("high"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.percentile("value", F.lit(0.5), F.col("n")).alias("median"),
    ).select(
        F.when(F.col("low") == F.col("high"), F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(F.col("low") == F.col("high"), F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        "mean",
        "median",
    )
    box = frame.select(F.struct("*").alias("box")).scalar()
    placed = lengths.select("value", "n", box.alias("box")).select(
        F.least(
            F.width_bucket(
                F.col("value").cast("double"), F.col("box.low"), F.col("box.high"), F.lit(bins)
            ),
            F.lit(bins),
        ).cast("int").alias("bin"),
        "n",
    )
    filled = placed.groupBy("bin").agg(F.sum("n").alias("n"))
    spark = lengths.sparkSession
    bins_df = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (F.col("box.high") - F.col("box.low")) / bins
    return (
        bins_df.join(filled, "bin", "left")
        .select("bin", F.coalesce("n", F.lit(0)).alias("n"), box.alias("box"))
        .select(
            "bin",
            (F.col("box.low") + (F.col("bin") - 1) * width).alias("from_value"),
            (F.col("box.low") + F.col("bin") * width).alias("to_value"),
            "n",
            F.col("box.mean").alias("mean"),
            F.col("box.median").alias("median"),
        )
    )


def length_histogram(df: DataFrame, text_col: str, bins: int = 50) -> DataFrame:
    """Histogram of word counts of the texts that are not null."""
    text = _q(text_col)
    lengths = value_counts(df.filter(text.isNotNull()).select(tx.word_count(text).alias("value")))
    return histogram(lengths, bins)


def length_boxplot(df: DataFrame, text_col: str, category_col: str) -> DataFrame:
    """Per category: quartiles, whiskers at the last value within 1.5 box heights, outliers."""
    text, category = _q(text_col), _q(category_col)
    lengths = value_counts(
        df.filter(text.isNotNull() & category.isNotNull()).select(
            category.alias("category"), tx.word_count(text).alias("value")
        ),
        "category",
    )
    boxes = lengths.groupBy("category").agg(
        F.sum("n").alias("total"),
        *[
            F.percentile("value", F.lit(p), F.col("n")).alias(name)
            for name, p in {"q1": 0.25, "median": 0.5, "q3": 0.75}.items()
        ],
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        lengths.join(boxes, "category")
        .groupBy("category", "total", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )


def share_comparison(original: DataFrame, sample: DataFrame, column: str) -> DataFrame:
    """Count and percent per category in two tables, side by side."""
    left = category_distribution(original, column).toDF("category", "original_n", "original_percent")
    right = category_distribution(sample, column).toDF("category", "sample_n", "sample_percent")
    return left.join(right, "category", "full_outer").select(
        "category",
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("original_n", "original_percent", "sample_n", "sample_percent")
        ],
    )


def profile(df: DataFrame, category_col: str, text_col: str) -> dict[str, DataFrame | None]:
    """All parts of the profile. A part whose column is absent is None.

    The text is read once: its parts come from the counts per (present, words), which are fetched
    when they are small, as they are but for absurd texts.
    """
    parts: dict[str, DataFrame | None] = dict.fromkeys(
        ["category_distribution", "distribution_headline", "length_counts", "length_stats",
         "short_long_counts", "presence"]
    )
    if category_col in df.columns:
        parts["category_distribution"] = category_distribution(df, category_col)
        parts["distribution_headline"] = distribution_headline(df, category_col)
    if text_col in df.columns:
        text = _q(text_col)
        words = df.select(tx.has_text(text).alias("present"), tx.word_count(text).alias("value"))
        counts = pinned_if_small(value_counts(words, "present"))
        lengths = counts.filter("present").select("value", "n")
        parts["length_counts"] = _length_counts(counts)
        parts["length_stats"] = _length_stats(lengths)
        parts["short_long_counts"] = _short_long_counts(lengths)
        parts["presence"] = _presence(counts)
    parts.update(validate.summary(df))
    return parts


def profile_table(df: DataFrame, category_col: str, text_col: str, short: int = 10) -> DataFrame:
    """The whole profile as rows (part, name, value), from one scan of the table.

    Each row of the table gives a cell for its category and one for its length. Cells are counted with
    partial sums and written; every part of the profile comes from that small table. A part whose column
    is absent has no rows, and statistics of no text are null.
    """
    spark, cells = df.sparkSession, []
    if category_col in df.columns:
        cells.append(F.struct(F.lit("category").alias("cell"), _q(category_col).cast("string").alias("name"), F.lit(None).cast("long").alias("value")))
    if text_col in df.columns:
        words = F.when(tx.has_text(_q(text_col)), tx.word_count(_q(text_col)).cast("long"))
        cells.append(F.struct(F.lit("length").alias("cell"), F.lit(None).cast("string").alias("name"), words.alias("value")))
    if not cells:
        return spark.createDataFrame([], "part string, name string, value double")
    counted = df.select(F.inline(F.array(*cells))).groupBy("cell", "name", "value").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "profile-cells")
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    lengths = counted.filter("cell = 'length'").select("value", "n", F.col("value").isNotNull().alias("present"))
    known = lengths.filter("present")

    def rows(part: str, table: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("name"), _q(c).cast("double").alias("value")) for c in table.columns]
        return table.select(F.lit(part).alias("part"), F.inline(F.array(*pairs)))

    out = counted.filter("cell = 'category' AND name IS NOT NULL").select(F.lit("category_count").alias("part"), "name", F.col("n").cast("double").alias("value"))
    if text_col in df.columns:
        presence = _length_counts(lengths).toDF("total", "with_text", "without_text")
        extremes = _short_long_counts(known, short).select(F.col("very_short_count").alias("very_short"), F.col("very_long_count").alias("very_long"))
        for part, table in (("length_stats", _length_stats(known)), ("presence", presence), ("length_counts", extremes)):
            out = out.unionByName(rows(part, table))
    return out
