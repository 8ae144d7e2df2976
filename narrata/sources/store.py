"""The vector table: one Parquet folder with unique ids.

An append keeps the first copy of an id and skips ids that are stored, so a repeated load adds
nothing. Spark has no MERGE on Parquet, so this is an aggregate and an anti-join on the id.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrata.params import require_columns
from narrata.session import local_table, scratch_path

MAX_PUSHED_IDS = 1000
#: The partition column of a table in buckets.
BUCKET = "id_bucket"

# --- fixed values: stored names of the metadata columns ---
METADATA_NAMES = {
    "Product": "product",
    "Issue": "issue",
    "Company": "company",
    "State": "state",
    "Date received": "date_received",
    "Complaint ID": "complaint_id",
}
# -----------------------------------------------------------


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def project_metadata(
    df: DataFrame, names: dict[str, str] | None = None, null_text: str | None = ""
) -> DataFrame:
    """Rename metadata columns to their stored names, null text to ``null_text``.

    Absent columns become ``null_text`` too. All other columns stay as they are.
    """
    names = METADATA_NAMES if names is None else names
    others = [_q(c) for c in df.columns if c not in names]
    renamed = [
        F.coalesce(_q(old).cast("string") if old in df.columns else F.lit(None).cast("string"),
                   F.lit(null_text)).alias(new)
        for old, new in names.items()
    ]
    return df.select(*others, *renamed)


def storable(value: Column, kind: T.DataType) -> Column:
    """Text, numbers and booleans stay; any other type becomes text. Null stays null."""
    plain = (T.StringType, T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType)
    return value if isinstance(kind, plain) else value.cast("string")


def records(
    df: DataFrame,
    id_col: str = "chunk_id",
    text_col: str = "chunk_text",
    embedding_col: str = "embedding",
    metadata: list[str] | None = None,
) -> DataFrame:
    """Rows in the form of the vector table: id, text, vector, metadata."""
    require_columns(df, [embedding_col, id_col, text_col])
    core = {id_col, text_col, embedding_col}
    metadata = [c for c in df.columns if c not in core] if metadata is None else metadata
    require_columns(df, metadata)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        _q(id_col).cast("string").alias("chunk_id"),
        _q(text_col).cast("string").alias("chunk_text"),
        _q(embedding_col).cast("array<float>").alias("embedding"),
        *[storable(_q(c), kinds[c]).alias(c) for c in metadata if c not in core],
    )


def first_per_id(rows: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """One row per id, the smallest of equal ids, so a repeated run keeps the same one.

    The aggregate keeps one row per id and task before the shuffle.
    """
    others = [c for c in rows.columns if c != id_col]
    picked = rows.groupBy(_q(id_col)).agg(F.min(F.struct(*map(_q, others))).alias("row"))
    return picked.select(*[_q(c) if c == id_col else F.col("row")[c].alias(c) for c in rows.columns])


def new_rows(rows: DataFrame, stored: DataFrame | None, id_col: str = "chunk_id") -> DataFrame:
    """Rows to append: the first of each id, ids already stored left out. A null id fails.

    Of the table the ids alone are read (see ``touched_buckets`` for a table in buckets). The ids to add are written once; rows are joined to them, by a broadcast where Spark finds them
    small, and only rows of ids that repeat in the load are compared with each other.
    """
    ids = rows.groupBy(_checked_id(id_col).alias(id_col)).agg((F.count("*") > 1).alias("_repeats"))
    if stored is not None:
        ids = ids.join(stored.select(_q(id_col)), id_col, "left_anti")
    path = scratch_path(rows.sparkSession, "ids")
    ids.write.parquet(path)
    fresh = rows.sparkSession.read.schema(ids.schema).parquet(path)
    columns = list(map(_q, rows.columns))
    once = rows.join(fresh.filter("NOT _repeats"), id_col, "left_semi")
    again = rows.join(fresh.filter("_repeats"), id_col, "left_semi")
    return once.select(*columns).unionByName(first_per_id(again.select(*columns), id_col))


def bucket_of(id_col: Column, buckets: int) -> Column:
    """Number of the bucket of an id."""
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def touched_buckets(stored: DataFrame, rows: DataFrame, buckets: int, id_col: str = "chunk_id") -> DataFrame:
    """The part of a table in buckets that can hold ids of the load: a filter on its folders.

    No more numbers than there are buckets are fetched.
    """
    touched = rows.select(bucket_of(_q(id_col), buckets).alias("b")).distinct().collect()
    return stored.filter(_q(BUCKET).isin([r["b"] for r in touched]))


def _checked_id(id_col: str) -> Column:
    return F.when(_q(id_col).isNull(), F.raise_error(F.lit("a row to store has no id"))).otherwise(_q(id_col))


def with_columns_of(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows with the columns of the table too, as null; a column may not change its type."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    for field in stored.schema.fields:
        if field.name not in kinds:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        elif kinds[field.name].simpleString() != field.dataType.simpleString():
            raise ValueError(
                f"column {field.name} is {field.dataType.simpleString()} in the table and {kinds[field.name].simpleString()} in the load"
            )
    return rows


class VectorTable:
    """A named vector table in a folder.

    With ``buckets`` its rows lie in folders by a hash of the id, so an append reads the ids of the folders
    only that its own ids fall into. The number belongs to the table: each opening gives the same.
    """

    def __init__(
        self, spark: SparkSession, path: str, name: str = "complaints", reset: bool = False, buckets: int = 0
    ):
        self.spark, self.path, self.name, self.buckets = spark, path, name, buckets
        if reset:
            self.delete()

    def exists(self) -> bool:
        return self._found() is not None

    def read(self) -> DataFrame:
        """All columns of all loads; a load without a column has null in it."""
        return self._files().drop(BUCKET)

    def _files(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.path)

    def _found(self) -> DataFrame | None:
        try:
            return self.read()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise

    def add(self, rows: DataFrame, partition_by: list[str] | None = None) -> int:
        """Append records whose id is not stored yet and return how many were added.

        The ids are read before the rows are, so costly work belongs into a table written first.
        """
        require_columns(rows, ["chunk_id", "chunk_text", "embedding"])
        stored = self._found()
        if stored is not None:
            rows = with_columns_of(rows, stored)
        kept = stored
        if self.buckets and stored is not None:
            kept = touched_buckets(self._files(), rows, self.buckets)
        fresh = new_rows(rows, kept)
        before = stored.count() if stored is not None else 0
        folders = list(partition_by or [])
        if self.buckets:
            # Adaptive execution splits large buckets and merges small ones, so files are neither many nor huge.
            fresh = fresh.withColumn(BUCKET, bucket_of(_q("chunk_id"), self.buckets)).hint("rebalance", BUCKET)
            folders = [BUCKET, *folders]
        writer = fresh.write.mode("append")
        if folders:
            writer = writer.partitionBy(*folders)
        writer.parquet(self.path)
        return self.spark.read.schema(rows.schema).parquet(self.path).count() - before

    def count(self) -> int:
        """Stored rows, from the Parquet footers."""
        stored = self._found()
        return 0 if stored is None else stored.count()

    def info(self) -> DataFrame:
        """Name, number of documents and place."""
        stored = self._found()
        if stored is None:
            stored = self.spark.createDataFrame([], "chunk_id string")
        return stored.agg(F.count("*").alias("document_count")).select(
            F.lit(self.name).alias("collection_name"), "document_count", F.lit(self.path).alias("path")
        )

    def get_by_ids(self, ids: list[str]) -> DataFrame:
        return get_by_ids(self.read(), ids)

    def reset(self) -> None:
        """Empty the table and keep its columns."""
        empty = self.spark.createDataFrame([], self.read().schema)
        if self.buckets:  # the columns are kept by an empty file in one of the folders
            self.delete()
        empty.write.mode("overwrite").parquet(f"{self.path}/{BUCKET}=0" if self.buckets else self.path)

    def delete(self) -> None:
        """Remove the table with its folder."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def get_by_ids(stored: DataFrame, ids: list[str], id_col: str = "chunk_id") -> DataFrame:
    """Rows with the given ids. A short list becomes a filter that reaches the scan."""
    if len(ids) <= MAX_PUSHED_IDS:
        return stored.filter(_q(id_col).isin(ids))
    wanted = local_table(stored.sparkSession, {id_col: ids}, f"`{id_col}` string")
    return stored.join(wanted, id_col, "left_semi").select(*map(_q, stored.columns))
