"""Validation and dataset summaries. Results are DataFrames, computed in one pass each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrata.params import EXPECTED_COLUMNS


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count, column list, and whether the table is non-empty."""
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array(*map(F.lit, df.columns)).alias("columns"),
        (F.col("row_count") > 0).alias("is_valid"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, from one aggregation over all columns."""
    counts = df.agg(
        *[(F.count("*") - F.count(_q(c))).alias(f"n{i}") for i, c in enumerate(df.columns)]
    )
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def row_identity(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Grouping columns that are equal exactly for rows with equal ``columns``. Nulls are equal.

    Where text is among them this is one SHA-256 of all values, each with its length in front, so
    the shuffle carries 64 characters per row and not the texts. Numbers alone, and nested columns,
    are grouped as they are.
    """
    columns = columns or df.columns
    kinds = [df.schema[c].dataType for c in columns]
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if T.StringType() not in kinds or any(isinstance(k, nested) for k in kinds):
        return [_q(c) for c in columns]
    # As in a group-by, -0.0 equals 0.0 and a NaN another NaN.
    floating = (T.FloatType, T.DoubleType)
    texts = [((_q(c) + F.lit(0.0)) if isinstance(k, floating) else _q(c)).cast("string") for c, k in zip(columns, kinds, strict=True)]
    marked = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return [F.sha2(F.concat(*marked), 256).alias("row_hash")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier row in every column. Nulls are equal."""
    copies = df.groupBy(*row_identity(df)).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")


def missing_columns(df: DataFrame, expected: list[str] | None = None) -> list[str]:
    """Expected columns that the table lacks, in the expected order. A schema check only."""
    return [c for c in (expected or EXPECTED_COLUMNS) if c not in df.columns]


def expected_column_report(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Per expected column: its position, whether it is present, and its non-null values."""
    expected = expected or EXPECTED_COLUMNS
    found = [c for c in expected if c in df.columns]
    counts = df.agg(F.count("*").alias("rows"), *[F.count(_q(c)).alias(f"c_{c}") for c in found])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(c in found).alias("present"),
            (_q(f"c_{c}") if c in found else F.lit(0).cast("long")).alias("non_null"),
        )
        for i, c in enumerate(expected)
    ]
    return counts.select(F.inline(F.array(*rows)))


def low_cardinality(
    df: DataFrame, exclude: list[str] | None = None, ratio: float = 0.5, approximate: bool = False
) -> DataFrame:
    """Text columns whose distinct values are fewer than ``ratio`` of the rows.

    The exact form groups (column, value) pairs with map-side partial counts, so a value that
    fills a third of the table costs one row per task. ``approximate`` uses sketches and moves no
    values at all.
    """
    names = [
        f.name
        for f in df.schema.fields
        if f.dataType == T.StringType() and f.name not in (exclude or [])
    ]
    if approximate:
        sketches = df.agg(
            F.count("*").alias("rows"),
            *[F.approx_count_distinct(_q(c)).alias(f"d_{c}") for c in names],
        )
        pairs = [
            F.struct(F.lit(c).alias("column_name"), _q(f"d_{c}").alias("distinct_values"), "rows")
            for c in names
        ]
        stats = sketches.select(F.inline(F.array(*pairs)))
    else:
        cells = df.select(
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("column_name"), _q(c).alias("value")) for c in names
            ]))
        )
        stats = (
            cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))
            .groupBy("column_name")
            .agg(F.count("value").alias("distinct_values"), F.sum("n").alias("rows"))
        )
    share = F.col("distinct_values") / F.col("rows")
    return stats.select("column_name", "distinct_values", share.alias("unique_ratio")).filter(
        F.col("unique_ratio") < ratio
    )


def summary(df: DataFrame) -> dict[str, DataFrame]:
    """Shape, nulls, types and duplicates as named frames."""
    return {
        "shape": shape(df),
        "null_counts": null_counts(df),
        "column_types": column_types(df),
        "duplicate_rows": duplicate_rows(df),
    }


def shape_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns before and after a job, and how many of each went."""
    counted = reduce(
        DataFrame.unionByName,
        [
            before.agg(F.count("*").alias("before"), F.lit(0).cast("long").alias("after")),
            after.agg(F.lit(0).cast("long").alias("before"), F.count("*").alias("after")),
        ],
    ).agg(F.sum("before").alias("original_rows"), F.sum("after").alias("current_rows"))
    n_before, n_after = len(before.columns), len(after.columns)
    return counted.select(
        "original_rows",
        F.lit(n_before).alias("original_columns"),
        "current_rows",
        F.lit(n_after).alias("current_columns"),
        (F.col("original_rows") - F.col("current_rows")).alias("rows_removed"),
        F.lit(n_before - n_after).alias("columns_removed"),
    )


def summary_table(df: DataFrame) -> DataFrame:
    """Shape, nulls, types and duplicates as rows (part, name, value), from one scan of the table.

    Equal rows have equal nulls, so the groups that count duplicates carry the nulls of their columns too.
    """
    flags = [F.max(_q(c).isNull().cast("long")).alias(f"null_{i}") for i, c in enumerate(df.columns)]
    groups = df.groupBy(*row_identity(df)).agg(F.count("*").alias("copies"), *flags)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("string")
    counts = groups.agg(
        total("copies").alias("rows"), total(F.col("copies") - 1).alias("duplicates"),
        *[total(F.col("copies") * F.col(f"null_{i}")).alias(f"null_{i}") for i in range(len(df.columns))],
    )
    row = lambda part, name, value: F.struct(F.lit(part).alias("part"), F.lit(name).alias("name"), value.alias("value"))
    every = [
        row("shape", "rows", F.col("rows")), row("shape", "columns", F.lit(str(len(df.columns)))), row("duplicates", "rows", F.col("duplicates")),
        *[row("null_counts", c, F.col(f"null_{i}")) for i, c in enumerate(df.columns)],
        *[row("column_types", c, F.lit(kind)) for c, kind in df.dtypes],
    ]
    return counts.select(F.inline(F.array(*every)))
