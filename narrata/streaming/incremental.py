"""Incremental load of the vector table from a folder of embedding files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from narrata.sources.store import VectorTable, records


def append_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: VectorTable,
    checkpoint: str,
    metadata: list[str] | None = None,
    files_per_batch: int | None = None,
) -> int:
    """Append the files that arrived since the last call and return the rows added.

    The checkpoint remembers which files are done. A batch that is repeated after a failure adds
    nothing twice, because ids that are stored are left out.
    """
    before = table.count()

    def append(batch: DataFrame, _: int) -> None:
        table.add(records(batch, metadata=metadata))

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.count() - before
