"""Sinks. Each is one distributed write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from narrata.params import require_columns
from narrata.sources.readers import first_readable, read_csv


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a stage and go on from the written table. The known schema saves reading it back."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Counted:
    """A frame whose rows are counted by the job that writes them, without a further scan.

    ``rows`` goes into the write; ``counts`` holds the named aggregates once that is done. Tasks that
    are repeated after a lost executor count once as long as nothing is shuffled between ``rows`` and
    the sink, so put filters and projections there and no more. An aggregate of an empty table that
    is planned away counts 0. Filters above ``rows`` do not reach the scan, which has to see every row.

    Once a session has observed something, Spark logs an error of its listener whenever a later query
    fails its analysis, such as the look for a table that is not there yet. It has no effect.
    """

    def __init__(self, df: DataFrame, *aggregates: Column):
        self._observation = Observation()
        self.rows = df.observe(self._observation, *aggregates)
        self._names = df.agg(*aggregates).columns

    def counts(self) -> dict[str, int]:
        found = self._observation.get
        return {name: found.get(name) or 0 for name in self._names}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Quotes are doubled and blanks at the ends of a value are kept."""
    options = {"header": True, "quote": '"', "escape": '"'}
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options, **blanks).csv(path)
    return path


def write_both(
    df: DataFrame, folder: str, name: str, csv: bool = True, parquet: bool = True
) -> dict[str, str]:
    """Write CSV and Parquet copies from one evaluation of the frame."""
    if not (csv or parquet):
        raise ValueError("choose at least one of csv and parquet")
    paths: dict[str, str] = {}
    if parquet:
        paths["parquet"] = f"{folder}/{name}.parquet"
        # The CSV copy reads the Parquet copy back, so the work before it is not done twice.
        df = written(df, paths["parquet"])
    if csv:
        paths["csv"] = write_csv(df, f"{folder}/{name}.csv")
    return paths


def write_embeddings(df: DataFrame, path: str, embedding_col: str = "embedding") -> str:
    """Write vectors as float lists next to the other columns."""
    require_columns(df, [embedding_col])
    floats = F.col(embedding_col).cast("array<float>")
    return write_parquet(df.withColumn(embedding_col, floats), path)


def parquet_copy(spark: SparkSession, csv_path: str, parquet_path: str, **csv_options) -> DataFrame:
    """Read the Parquet copy of a CSV file, making the copy on the first call."""
    try:
        return first_readable(spark, [parquet_path])
    except FileNotFoundError:
        write_parquet(read_csv(spark, csv_path, **csv_options), parquet_path, mode="errorifexists")
        return spark.read.parquet(parquet_path)


def write_lines(lines: DataFrame, path: str, order: list[str], text_col: str = "line") -> str:
    """Write text lines in order. The sort is by range, so a long report spans several files."""
    lines.orderBy(*order).select(text_col).write.mode("overwrite").text(path)
    return path
