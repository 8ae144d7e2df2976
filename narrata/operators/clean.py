"""Row cleaning: duplicates, missing values, dates, derived features and filters."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import text as tx
from narrata.functions.dates import parse_date
from narrata.operators.validate import row_identity
from narrata.params import require_columns
from narrata.session import local_table
from narrata.sources.readers import keep_columns
from narrata.sources.writers import Counted, written


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def remove_duplicates(
    df: DataFrame, subset: list[str] | None = None, keep: str | bool = "first", key: str | None = None
) -> DataFrame:
    """Drop repeated rows, judged by all columns or by ``subset``.

    ``keep`` is 'first' or 'last' in the order of the unique column ``key``, or False for rows
    that have no copy. The group-by shuffles one number per distinct value (by its hash) and task,
    and the semi-join is on the unique key, so a value with very many copies fills no single task.
    Without ``subset`` all columns but the key are compared. A null key fails the run.
    """
    if keep not in ("first", "last", False):
        raise ValueError("keep must be 'first', 'last' or False")
    if subset is None and keep is not False and key is None:
        return df.dropDuplicates()
    if subset is None:
        subset = [c for c in df.columns if c != key]
    if key is None and keep is False:
        groups = df.groupBy(*map(_q, subset)).agg(F.count("*").alias("_copies"))
        alone = groups.filter("_copies = 1").drop("_copies")
        if set(subset) == set(df.columns):
            return alone.select(*map(_q, df.columns))
    if key is None:
        raise ValueError("a table has no row order: name a unique column as key")
    require_columns(df, [*subset, key])
    given = F.when(_q(key).isNull(), F.raise_error(F.lit(f"null in the key column {key}"))).otherwise(_q(key))
    pick = F.max(given) if keep == "last" else F.min(given)
    groups = df.groupBy(*row_identity(df, subset)).agg(
        pick.alias("_kept"), F.count("*").alias("_copies")
    )
    if keep is False:
        groups = groups.filter("_copies = 1")
    return df.join(groups.select(F.col("_kept").alias(key)), key, "left_semi").select(
        *map(_q, df.columns)
    )


def clean_narratives(df: DataFrame, text_col: str, **options) -> DataFrame:
    """Apply the narrative cleaning to a column. A table without the column is left alone."""
    if text_col not in df.columns:
        warnings.warn(f"column {text_col!r} not found, nothing cleaned", stacklevel=2)
        return df
    return df.withColumn(text_col, tx.clean_narrative(_q(text_col), **options))


def clean_text_narratives(df: DataFrame, text_col: str, **options) -> DataFrame:
    """Apply the full text cleaning chain to a column. A table without it is left alone."""
    if text_col not in df.columns:
        warnings.warn(f"column {text_col!r} not found, nothing cleaned", stacklevel=2)
        return df
    return df.withColumn(text_col, tx.clean_text(_q(text_col), **options))


def cleaning_effect(df: DataFrame, raw: Column, cleaned: Column) -> DataFrame:
    """Non-null texts before and after cleaning, and texts that cleaning emptied, in one pass."""
    pairs = df.select(raw.alias("raw"), cleaned.alias("cleaned"))
    return pairs.agg(*_effect_counts(F.col("raw"), F.col("cleaned")))


def _effect_counts(raw: Column, cleaned: Column) -> list[Column]:
    return [
        F.count(raw).alias("before"),
        F.count(cleaned).alias("after"),
        F.count_if(cleaned.isNull()).alias("empty_after"),
        F.count_if(raw.isNotNull() & cleaned.isNull()).alias("emptied"),
    ]


def write_cleaned(
    df: DataFrame, text_col: str, path: str, **options
) -> tuple[DataFrame, dict[str, int]]:
    """Write the table with its text cleaned; the effect is counted by the write itself.

    Gives the written table and the counts of ``cleaning_effect``. The raw table is read once and
    each text is cleaned once.
    """
    require_columns(df, [text_col])
    pairs = df.withColumn("_cleaned", tx.clean_text(_q(text_col), **options))
    counted = Counted(pairs, *_effect_counts(_q(text_col), F.col("_cleaned")))
    cleaned = [F.col("_cleaned").alias(c) if c == text_col else _q(c) for c in df.columns]
    return written(counted.rows.select(*cleaned), path), counted.counts()


def handle_missing(
    df: DataFrame, strategy: str = "drop", columns: list[str] | None = None, fill_value=None
) -> DataFrame:
    """'drop' rows where all listed columns are null, 'fill' nulls with a value, or 'keep'."""
    columns = columns or df.columns
    if strategy == "drop":
        require_columns(df, columns)
        return df.na.drop(how="all", subset=columns)
    if strategy == "fill":
        if fill_value is None:
            raise ValueError("fill_value must be given when strategy is 'fill'")
        present = [c for c in columns if c in df.columns]
        return df.withColumns({c: F.coalesce(_q(c), F.lit(fill_value)) for c in present})
    if strategy == "keep":
        return df
    raise ValueError(f"unknown strategy: {strategy}")


def date_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower()]


def standardize_dates(
    df: DataFrame, columns: list[str] | None = None, formats: list[str] | None = None
) -> DataFrame:
    """Parse the given date columns, or all with "date" in the name. Bad values become null."""
    wanted = date_columns(df) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({c: parse_date(_q(c).cast("string"), formats) for c in wanted})


def valid_dates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of parsed dates per date column, in one pass."""
    wanted = columns or date_columns(df)
    counts = df.agg(*[F.count(_q(c)).alias(f"n{i}") for i, c in enumerate(wanted)])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("valid_dates"))
        for i, c in enumerate(wanted)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def add_derived_features(df: DataFrame, text_col: str) -> DataFrame:
    """Word count, character count and presence flag of the narrative."""
    if text_col not in df.columns:
        return df
    text = _q(text_col)
    return df.withColumns(
        {
            "narrative_word_count": tx.word_count(text),
            "narrative_char_count": tx.char_count(text),
            "has_narrative": tx.has_text(text),
        }
    )


def filter_by_products(
    df: DataFrame, products: list[str], product_col: str = "Product", must_exist: bool = True
) -> DataFrame:
    """Keep rows of the listed products.

    ``must_exist`` raises when no listed product occurs. That check is a scan with the filter
    pushed down which stops at the first row found.
    """
    require_columns(df, [product_col])
    kept = df.filter(_q(product_col).isin(products))
    if must_exist:
        require_products(not kept.select(F.lit(1)).isEmpty(), products, product_col)
    return kept


def require_products(found: bool, products: list[str], product_col: str) -> None:
    if not found:
        raise ValueError(f"none of the products occurs in {product_col!r}: {products}")


def absent_values(df: DataFrame, values: list[str], column: str) -> DataFrame:
    """Listed values that the column never holds, with their place in the list."""
    listed = local_table(
        df.sparkSession,
        {"position": range(1, len(values) + 1), "value": values},
        "position int, value string",
    )
    found = df.filter(_q(column).isin(values)).select(_q(column).alias("value")).distinct()
    return listed.join(found, "value", "left_anti").select("position", "value")


def kept_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their percentage of all rows."""
    counts = df.groupBy(_q(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    share = tx.round_even(F.col("n") / total * 100, 2)
    return counts.select("value", "n", share.alias("percent"))


def remove_empty_narratives(df: DataFrame, text_col: str) -> DataFrame:
    """Drop rows whose text is null, blank or a written-out null."""
    require_columns(df, [text_col])
    return df.filter(tx.has_real_text(_q(text_col)))


def filter_by_conditions(df: DataFrame, conditions: dict, keep: bool = True) -> DataFrame:
    """Rows that match all conditions, or with ``keep=False`` rows that match none.

    A condition is a value or a list of values. Unknown columns are ignored. A null never matches,
    so ``keep=False`` lets nulls through.
    """
    tests = []
    for name, wanted in conditions.items():
        if name in df.columns:
            listed = list(wanted) if isinstance(wanted, (list, tuple)) else [wanted]
            match = _q(name).isin(listed)
            tests.append(match if keep else ~F.coalesce(match, F.lit(False)))
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the listed columns that exist, warn about the others."""
    return keep_columns(df, columns)


def funnel_counts(products: list[str], product_col: str, text_col: str) -> list[Column]:
    """The counts of the funnel, for an aggregation or for ``Counted``."""
    listed = F.coalesce(_q(product_col).isin(products), F.lit(False))
    return [
        F.count("*").alias("initial_count"),
        F.count_if(listed).alias("after_product_filter"),
        F.count_if(listed & tx.has_real_text(_q(text_col))).alias("after_narrative_filter"),
    ]


def filter_funnel(
    df: DataFrame, products: list[str], product_col: str, text_col: str
) -> DataFrame:
    """Counts along the two filters (product, then text) from one pass over two columns."""
    counts = df.agg(*funnel_counts(products, product_col, text_col))
    first, second, third = (F.col(c) for c in counts.columns)
    return counts.select(
        first,
        second,
        third,
        (first - second).alias("removed_by_product"),
        (second - third).alias("removed_by_narrative"),
        (first - third).alias("total_removed"),
        F.when(first > 0, third / first * 100).otherwise(F.lit(0.0)).alias("retention_rate"),
    )
