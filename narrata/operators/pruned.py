"""Exact search that reads only the parts of a table that can hold a hit.

Two layouts of the vector table make parts:

* by a metadata column (``nearest_by_value``): a question with a filter looks into the folder of its value
  only. The values asked for prune the folders that the scan reads, and a task computes
  distances only between chunks and questions of the same value.
* by pivots (``write_pivot_table``, ``nearest_by_pivots``): every chunk lies in the cell of its nearest pivot
  with its distance to it. A question first searches its own cell, which gives it a bound on the distance of
  its k-th hit. By the triangle inequality a chunk at distance r from a pivot is no nearer to the question than
  |d(question, pivot) - r|, so other cells, and in them the chunks beyond the bound, are skipped.

No chunk is copied or shuffled: questions are sent to the tasks in blocks of bounded size, each block a scan of
the parts it needs, and the shuffle carries k narrow rows per question, part and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrata.operators.nearest import MAX_SENT_BYTES, MAX_SENT_QUESTIONS, _arrow_schema, _Best, _matrix
from narrata.params import require_columns
from narrata.session import scratch_path

PIVOTS = 64
#: Rounding error that a bound allows for, as a share of it.
MARGIN = 1e-9


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _blocks(questions: DataFrame, question_id: str, max_sent: int) -> Iterator[pa.Table]:
    """The questions in blocks that fit the bound, each fetched when its turn comes."""
    head = questions.limit(max_sent + 1).toArrow()
    if head.num_rows <= max_sent and head.nbytes <= MAX_SENT_BYTES:
        if head.num_rows:
            yield head
        return
    count = questions.count()
    per_row = max(1, head.nbytes // head.num_rows)
    blocks = -(-2 * count // max(1, min(max_sent, MAX_SENT_BYTES // per_row)))
    for block in range(blocks):
        part = questions.filter(F.pmod(F.xxhash64(_q(question_id)), F.lit(blocks)) == block).toArrow()
        if part.num_rows:
            yield part


def _scan_parts(scanned: DataFrame, asked: dict, k: int, schema: T.StructType) -> DataFrame:
    """The best k per question of each task. ``scanned`` has id, vector, part and, with bounds, reach.

    ``asked`` has for each part its questions (id, vector) and, with bounds, their distance to the part's
    pivot and the distance of their k-th hit so far.
    """
    sent = scanned.sparkSession.sparkContext.broadcast(asked)
    arrow_schema = _arrow_schema(scanned.sparkSession, schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            for part in pc.unique(batch.column(2)).to_pylist():
                if part is None or part not in sent.value:
                    continue
                questions, distance, bound = sent.value[part]
                rows = batch.filter(pc.equal(batch.column(2), part))
                if part not in best:
                    best[part] = _Best(questions, k, "l2")
                if bound is not None:
                    best[part].bound = np.minimum(best[part].bound, bound * bound * (1 + MARGIN) + MARGIN)
                    reach = rows.column(3).to_numpy(zero_copy_only=False)
                    slack = bound * (1 + MARGIN) + MARGIN
                    near = (reach >= (distance - slack).min()) & (reach <= (distance + slack).max())
                    rows = rows.filter(pa.array(near))
                best[part].add(rows.select([0, 1]))
        for found in best.values():
            yield from found.result(arrow_schema).to_batches()

    return scanned.mapInArrow(scan, schema)


def _hits(rows: DataFrame, question_id: str, id_col: str, k: int) -> DataFrame:
    order = Window.partitionBy(_q(question_id)).orderBy("distance", _q(id_col))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _schema(questions: DataFrame, chunks: DataFrame, question_id: str, id_col: str) -> T.StructType:
    return T.StructType([
        T.StructField(question_id, questions.schema[question_id].dataType),
        T.StructField(id_col, chunks.schema[id_col].dataType), T.StructField("distance", T.DoubleType()),
    ])


def nearest_by_value(
    chunks: DataFrame,
    questions: DataFrame,
    filter_col: str,
    question_filter: str,
    k: int = 5,
    id_col: str = "chunk_id",
    vector_col: str = "embedding",
    question_id: str = "question_id",
    question_vector: str = "question_embedding",
    max_sent: int = MAX_SENT_QUESTIONS,
) -> DataFrame:
    """The k nearest chunks (squared Euclidean) of the question's own value, for questions that have one.

    Where the table is partitioned by ``filter_col``, only the folders of the values asked for are read. A
    blank value has no folder of its own and matches nothing; questions without a value have no row.
    """
    require_columns(chunks, [id_col, vector_col, filter_col])
    require_columns(questions, [question_id, question_vector, question_filter])
    asked = questions.select(_q(question_id), _q(question_vector), _q(question_filter)).filter(
        _q(question_vector).isNotNull() & (_q(question_filter) != "")
    )
    schema = _schema(asked, chunks, question_id, id_col)
    found = None
    for block in _blocks(asked, question_id, max_sent):
        values = pc.unique(block.column(2)).to_pylist()
        parts = {v: (block.filter(pc.equal(block.column(2), v)).select([0, 1]), None, None) for v in values}
        # As many values as the block has at most: a filter that reaches the folders when the scan is planned.
        scanned = chunks.select(_q(id_col), _q(vector_col), _q(filter_col)).filter(_q(filter_col).isin(values))
        some = _hits(_scan_parts(scanned, parts, k, schema), question_id, id_col, k)
        found = some if found is None else found.unionByName(some)
    return found if found is not None else chunks.sparkSession.createDataFrame([], schema.add("rank", T.IntegerType()))


def _pivots(chunks: DataFrame, number: int, id_col: str, vector_col: str) -> np.ndarray:
    """Vectors of the chunks with the smallest hashes, without repeats; any choice gives the same hits."""
    finite = F.forall(_q(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    picked = chunks.filter(_q(vector_col).isNotNull() & finite).select(_q(vector_col).alias("v"), F.xxhash64(_q(id_col)).alias("h"))
    rows = picked.orderBy("h").limit(number).select("v").toArrow()
    return np.unique(_matrix(rows.column(0).combine_chunks()), axis=0) if rows.num_rows else np.zeros((0, 0))


def _to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, each from the differences themselves."""
    return np.sqrt(np.stack([((vectors - p) ** 2).sum(axis=1) for p in pivots], axis=1))


def write_pivot_table(
    chunks: DataFrame, path: str, pivots: int = PIVOTS, id_col: str = "chunk_id", vector_col: str = "embedding"
) -> None:
    """Write ids and vectors in cells by nearest pivot, sorted by the distance to it, and the pivots beside them.

    Chunks whose vector is null or has a null or infinite element have no distance and are left out, as in ``nearest``.
    """
    spark = chunks.sparkSession
    rows = chunks.select(_q(id_col).alias("id"), _q(vector_col).cast("array<double>").alias("vector"))
    points = _pivots(rows, pivots, "id", "vector")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("vector").is_valid())
            if not batch.num_rows or not len(points):
                continue
            vectors = _matrix(batch.column("vector"), points.shape[1], batch.column("id"))
            finite = np.isfinite(vectors).all(axis=1)
            batch, vectors = batch.filter(pa.array(finite)), vectors[finite]
            distances = _to_pivots(vectors, points)
            cell = distances.argmin(axis=1) if len(vectors) else np.zeros(0, np.int64)
            reach = distances[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reach), pa.array(cell, pa.int32())], ["id", "vector", "reach", "cell"])

    kind = rows.schema["id"].dataType.simpleString()
    placed = rows.mapInArrow(place, f"id {kind}, vector array<double>, reach double, cell int")
    # Cells of any size: rows of a cell go to several files, each a range of distances.
    placed.repartitionByRange("cell", "reach").sortWithinPartitions("cell", "reach").write.partitionBy("cell").parquet(f"{path}/cells")
    spark.createDataFrame(
        pa.table({"cell": pa.array(range(len(points)), pa.int32()), "pivot": pa.array(points.tolist(), pa.list_(pa.float64()))}), "cell int, pivot array<double>"
    ).write.parquet(f"{path}/pivots")


def nearest_by_pivots(
    spark: SparkSession,
    path: str,
    questions: DataFrame,
    k: int = 5,
    id_col: str = "chunk_id",
    question_id: str = "question_id",
    question_vector: str = "question_embedding",
    max_sent: int = MAX_SENT_QUESTIONS,
) -> DataFrame:
    """The k nearest chunks (squared Euclidean) per question in a table that ``write_pivot_table`` wrote.

    Exact. The first round reads the questions' own cells, the second only cells, and in them only distances to
    the pivot, that can still hold a nearer chunk. Each round of a block of questions is a written table.
    """
    require_columns(questions, [question_id, question_vector])
    asked = questions.select(_q(question_id), _q(question_vector)).filter(_q(question_vector).isNotNull())
    pivots = spark.read.parquet(f"{path}/pivots").orderBy("cell").toArrow()  # at most as many rows as pivots
    empty = _empty_hits(asked, question_id, id_col)
    if not pivots.num_rows:
        return spark.createDataFrame([], empty)
    points = _matrix(pivots.column("pivot").combine_chunks())
    cells = spark.read.parquet(f"{path}/cells")
    kinds = cells.schema
    cells = cells.select(F.col("id").alias(id_col), "vector", "cell", "reach")
    ranges = {r["cell"]: (r["low"], r["high"]) for r in cells.groupBy("cell").agg(F.min("reach").alias("low"), F.max("reach").alias("high")).collect()}
    schema = T.StructType([*empty.fields[:1], T.StructField(id_col, kinds["id"].dataType), T.StructField("distance", T.DoubleType())])
    found = None
    for block in _blocks(asked, question_id, max_sent):
        distances = _to_pivots(_matrix(block.column(1).combine_chunks(), points.shape[1], block.column(0).combine_chunks()), points)
        known = sorted(ranges)
        own = np.array(known)[distances[:, known].argmin(axis=1)]
        first = _round(cells, block, {c: (np.flatnonzero(own == c), None, None) for c in np.unique(own).tolist()}, k, schema)
        bound = _bounds(first, block, question_id, k)
        parts = {}
        for c in known:
            low, high = ranges[c]
            d = distances[:, c]
            least = np.maximum(0.0, np.maximum(d - high, low - d))  # nothing of the cell is nearer
            rows = np.flatnonzero((own != c) & (least <= bound * (1 + MARGIN) + MARGIN))
            if len(rows):
                parts[c] = (rows, d[rows], bound[rows])
        every = first.unionByName(_round(cells, block, parts, k, schema)) if parts else first
        some = _hits(every, question_id, id_col, k)
        found = some if found is None else found.unionByName(some)
    return found if found is not None else spark.createDataFrame([], empty)


def _empty_hits(asked: DataFrame, question_id: str, id_col: str) -> T.StructType:
    return T.StructType([
        T.StructField(question_id, asked.schema[question_id].dataType), T.StructField(id_col, T.StringType()),
        T.StructField("distance", T.DoubleType()), T.StructField("rank", T.IntegerType()),
    ])


def _round(cells: DataFrame, block: pa.Table, parts: dict, k: int, schema: T.StructType) -> DataFrame:
    """The best rows of the cells in ``parts``, which name the questions (row numbers), their distances and bounds."""
    asked = {c: (block.take(pa.array(rows)), d, b) for c, (rows, d, b) in parts.items()}
    wanted = cells.filter(F.col("cell").isin(list(parts)))
    bounded = [(d - b * (1 + MARGIN) - MARGIN, d + b * (1 + MARGIN) + MARGIN, c) for c, (_, d, b) in parts.items() if b is not None]
    if bounded and all(np.isfinite(low).all() for low, _, _ in bounded):
        low, high = min(low.min() for low, _, _ in bounded), max(high.max() for _, high, _ in bounded)
        wanted = wanted.filter(F.col("reach").between(float(low), float(high)))  # reaches the row groups of the scan
    rows = _scan_parts(wanted, asked, k, schema)
    path = scratch_path(cells.sparkSession, "pivot-round")
    rows.write.parquet(path)
    return cells.sparkSession.read.schema(rows.schema).parquet(path)


def _bounds(first: DataFrame, block: pa.Table, question_id: str, k: int) -> np.ndarray:
    """Distance of each question's k-th hit in its own cell; infinite where the cell has fewer. One row a question."""
    kth = _hits(first, question_id, first.columns[1], k).filter(F.col("rank") == k).select(_q(question_id), F.sqrt("distance").alias("d")).toArrow()
    known = dict(zip(kth.column(0).to_pylist(), kth.column(1).to_pylist(), strict=True))
    return np.array([known.get(q, np.inf) for q in block.column(0).to_pylist()])
