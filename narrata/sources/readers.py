"""Scans: CSV, Parquet, column-pruned loads and source resolution."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrata.functions.text import NULL_TOKENS_CSV, tokens_to_null
from narrata.operators.sample import simple_sample
from narrata.params import ESSENTIAL_COLUMNS, EXPECTED_COLUMNS


def raw_schema(columns: list[str] | None = None) -> T.StructType:
    """All text: ids and ZIP codes keep their leading zeros, dates are parsed later."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns or EXPECTED_COLUMNS])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_tokens: bool = True,
    multi_line: bool = True,
    mixed_headers: bool = False,
) -> DataFrame:
    """Read CSV with a header, quoted line breaks and doubled quotes.

    Without a schema the header names the columns and every column is text. ``null_tokens`` turns
    the usual written-out nulls into null. A file with line breaks inside quotes cannot be split,
    so one file is one task: read many files, or convert once with ``parquet_copy``. Files known
    to have none are read in splits with ``multi_line=False``.

    A file whose header differs from the first one's fails the read. ``mixed_headers`` allows that: the
    first lines are read in a pass of their own, and files are united by column name.
    """
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "enforceSchema": False}
    fields = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    parts = []
    for files in _files_by_header(spark, path) if mixed_headers else [path]:
        # The header decides which field a column is, so files may lack or reorder columns.
        present = spark.read.options(**options).csv(files if isinstance(files, str) else files[0]).columns
        kinds = T.StructType([T.StructField(c, fields.get(c, T.StringType())) for c in present])
        parts.append(spark.read.options(**options).schema(kinds).csv(files))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if not null_tokens:
        return df
    return df.select(
        *[
            (tokens_to_null(F.col(f"`{f.name}`"), NULL_TOKENS_CSV) if f.dataType == T.StringType()
             else F.col(f"`{f.name}`")).alias(f.name)
            for f in df.schema.fields
        ]
    )


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a path, those with the same first line together. One row for each header comes back."""
    lines = spark.read.text(path).filter("_metadata.file_block_start = 0").select("_metadata.file_path", "value")
    heads = lines.mapInArrow(_first_lines, "file_path string, value string")
    rows = heads.groupBy("value").agg(F.sort_array(F.collect_set("file_path")).alias("files")).collect()
    return sorted(r["files"] for r in rows)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = None
    for batch in batches:
        files = batch.column(0).to_pylist()
        first = [i for i, file in enumerate(files) if file != (files[i - 1] if i else before)]
        before = files[-1] if files else before
        yield batch.take(pa.array(first, pa.int64()))


def read_source(spark: SparkSession, path: str, **csv_options) -> DataFrame:
    """Read one path by its suffix: CSV (also compressed) or Parquet."""
    name = path.rstrip("/").lower()
    if name.endswith((".csv", ".csv.gz", ".csv.bz2")):
        return read_csv(spark, path, **csv_options)
    return spark.read.parquet(path)


def first_readable(spark: SparkSession, paths: list[str], **csv_options) -> DataFrame:
    """The first path of an ordered list that exists."""
    for path in paths:
        try:
            return read_source(spark, path, **csv_options)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    raise FileNotFoundError(f"none of these sources exists: {paths}")


def keep_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep the wanted columns that exist, warn about the others. Pruning reaches the scan."""
    wanted = columns or ESSENTIAL_COLUMNS
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        warnings.warn(f"columns not found: {absent}", stacklevel=2)
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])


def reuse(df: DataFrame) -> DataFrame:
    """Keep a table that several jobs read. It spills to disk; ``release`` gives it back."""
    return df.persist()


class LoadedTables:
    """Tables kept between calls by source and sample size, until they are cleared."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._kept: dict[tuple, DataFrame] = {}

    def load(
        self, paths: list[str], sample: int | None = None, key: str | None = None, seed: int = 42
    ) -> DataFrame:
        """The first path that exists, or a sample of it by its unique column ``key``."""
        if sample is not None and key is None:
            raise ValueError("a sample needs a unique column as key")
        name = (*paths, sample, key, seed)
        if name not in self._kept:
            table = first_readable(self.spark, paths)
            if sample is not None:
                table = simple_sample(table, sample, key, seed)
            self._kept[name] = reuse(table)
        return self._kept[name]

    def clear(self) -> None:
        for table in self._kept.values():
            release(table)
        self._kept.clear()


def release(df: DataFrame) -> DataFrame:
    return df.unpersist()

CORRUPT = "_record"


def split_csv(
    spark: SparkSession, path: str, schema: T.StructType, folder: str, header: bool = True, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Read CSV by a schema and keep malformed records apart: (good rows, quarantine with file and record).

    A record is malformed when it has more or fewer fields than the schema, when a quote never closes, or when
    a value is not of its column's type. The files are read once; both parts are folders of one written table,
    so a count of either is a count of Parquet rows. With ``multi_line`` a quote that never closes takes the rest
    of its file with it.
    """
    if CORRUPT in schema.fieldNames():
        raise ValueError(f"the name {CORRUPT} is taken by the malformed record")
    options = {"header": header, "quote": '"', "escape": '"', "multiLine": multi_line, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = spark.read.options(**options).schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).csv(path)
    marked = read.select("*", F.col("_metadata.file_path").alias("_file")).withColumn("_bad", F.col(CORRUPT).isNotNull())
    marked.write.partitionBy("_bad").parquet(folder)
    written = spark.read.schema(marked.schema).parquet(folder)
    good = written.filter("NOT _bad").select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    return good, written.filter("_bad").select(F.col("_file").alias("file"), F.col(CORRUPT).alias("record"))
