"""Session helpers: the local test session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "narrata") -> SparkSession:
    """A session for tests and the bench. A cluster brings its own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder the cluster sets in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return f"{shared.rstrip('/')}/narrata-{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return os.path.join(tempfile.mkdtemp(prefix="narrata-"), name)


def pinned_if_small(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """Turn a small control table into a local relation whose size the planner knows.

    The table is fetched with one row more than the bound. Within the bound, joins against the
    result are broadcast because Catalyst sees its size, and the aggregation behind it is not
    run again. Beyond the bound the frame is returned as it was and joins stay distributed.
    """
    rows = df.limit(max_rows + 1).toArrow()
    return df if rows.num_rows > max_rows else local_table(df.sparkSession, rows, df.schema)


def local_table(spark: SparkSession, rows: pa.Table | dict, schema) -> DataFrame:
    """A small table made on the driver, as a local relation. The Arrow way keeps its size known."""
    if isinstance(rows, dict):
        rows = pa.table(rows)
    return spark.createDataFrame(rows, schema)
