"""Exact nearest neighbours of a batch of questions.

Every distance has to be looked at, but no pair of question and chunk becomes a row. Tasks scan
their own chunks as Arrow batches, multiply them with the matrix of questions, and keep the best k
per question. The shuffle carries at most k narrow rows per question and task. Text and metadata
are joined to the winners afterwards, so the scan reads ids and vectors only.

The questions are sent to all tasks while they fit a bound on rows and bytes that is checked
first. A larger set is cut into blocks, chunks into blocks of bounded size, and each pair of blocks
is one cogrouped task: the same result without a broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrata.params import require_columns
from narrata.session import local_table

MAX_SENT_QUESTIONS = 4096
MAX_SENT_BYTES = 64 * 1024 * 1024
CHUNKS_PER_BLOCK = 50_000
MAX_SENT_HITS = 200_000
CELLS_PER_STEP = 2_000_000  # question x chunk distances held at once in a task
PAIRS_PER_STEP = 50_000  # pairs whose distance is computed exactly at once


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _matrix(vectors: pa.Array, width: int | None = None, ids: pa.Array | None = None) -> np.ndarray:
    """Rows of a list column without nulls, as doubles; null elements are NaN. All have the same width."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    width = width if width is not None else int(lengths[0]) if len(lengths) else 0
    if (lengths != width).any():
        wrong = np.flatnonzero(lengths != width)[:5]
        names = [ids[int(i)].as_py() for i in wrong] if ids is not None else wrong.tolist()
        raise ValueError(f"vectors of another width than {width}: {names}")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), width)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms > 0, norms, 1.0)


def _rows_by_value(column: pa.ChunkedArray) -> dict:
    """Row numbers per value, nulls left out."""
    rows: dict = {}
    for i, value in enumerate(column.to_pylist()):
        if value is not None:
            rows.setdefault(value, []).append(i)
    return rows


class _Best:
    """The k nearest chunks per question among the batches seen so far in one task."""

    def __init__(self, questions: pa.Table, k: int, metric: str):
        self.k, self.metric = k, metric
        self.ids = questions.column(0).combine_chunks()
        vectors = _matrix(questions.column(1).combine_chunks(), ids=self.ids)
        if not np.isfinite(vectors).all():
            wrong = np.flatnonzero(~np.isfinite(vectors).all(axis=1))[:5]
            raise ValueError(f"question vectors with null or infinite elements: {[self.ids[int(i)].as_py() for i in wrong]}")
        self.vectors = _unit(vectors) if metric == "cosine" else vectors
        self.squares = (self.vectors * self.vectors).sum(axis=1)
        self.wanted = _rows_by_value(questions.column(2)) if questions.num_columns > 2 else None
        self.bound = np.full(len(self.ids), np.inf)
        self.question = np.empty(0, dtype=np.int64)
        self.distance = np.empty(0)
        self.chunk = np.empty(0, dtype=object)

    def add(self, chunks: pa.RecordBatch | pa.Table) -> None:
        chunks = chunks.filter(chunks.column(1).is_valid())
        step = max(1, CELLS_PER_STEP // max(1, len(self.ids)))
        for start in range(0, chunks.num_rows, step):
            self._add(chunks.slice(start, step))

    def _add(self, part: pa.RecordBatch | pa.Table) -> None:
        if not len(self.ids):
            return
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in part.columns]
        vectors = _matrix(columns[1], self.vectors.shape[1], columns[0])
        finite = np.isfinite(vectors).all(axis=1)
        if not finite.all():  # a chunk with a null or infinite element has no distance and is no hit
            vectors, columns = vectors[finite], [c.filter(pa.array(finite)) for c in columns]
        if not len(vectors):
            return
        if self.metric == "cosine":
            vectors = _unit(vectors)
        squares = (vectors * vectors).sum(axis=1)
        # A fast estimate picks candidates; a margin far above its rounding error keeps it safe.
        estimate = self.squares[:, None] + squares[None, :] - 2.0 * (self.vectors @ vectors.T)
        if self.metric == "cosine":  # nothing is similar to a zero vector
            estimate[:, squares == 0] = estimate[self.squares == 0, :] = 2.0
        if self.wanted is not None:
            for value, asking in self.wanted.items():
                other = pc.fill_null(pc.not_equal(columns[2], value), True)
                estimate[np.ix_(asking, np.flatnonzero(other.to_numpy(zero_copy_only=False)))] = np.inf
        bound = self.bound
        if estimate.shape[1] > self.k:
            bound = np.minimum(bound, np.partition(estimate, self.k - 1, axis=1)[:, self.k - 1])
        margin = 1e-9 * (1.0 + self.squares + squares.max())
        question, row = np.nonzero((estimate <= (bound + margin)[:, None]) & np.isfinite(estimate))
        if len(question):
            names = np.array(columns[0].take(pa.array(row)).to_pylist(), dtype=object)
            self._merge(question, self._exact(question, row, vectors), names)

    def _exact(self, question: np.ndarray, row: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Distances summed in one fixed order, so that equal vectors have equal distances."""
        out = np.empty(len(question))
        for start in range(0, len(question), PAIRS_PER_STEP):
            pairs = slice(start, start + PAIRS_PER_STEP)
            difference = self.vectors[question[pairs]] - vectors[row[pairs]]
            out[pairs] = (difference * difference).sum(axis=1)
        if self.metric == "cosine":
            out[~self.vectors.any(axis=1)[question] | ~vectors.any(axis=1)[row]] = 2.0
        return out

    def _merge(self, question: np.ndarray, distance: np.ndarray, chunk: np.ndarray) -> None:
        question = np.concatenate([self.question, question])
        distance = np.concatenate([self.distance, distance])
        chunk = np.concatenate([self.chunk, chunk])
        _, name_order = np.unique(chunk, return_inverse=True)
        order = np.lexsort((name_order, distance, question))
        question, distance, chunk = question[order], distance[order], chunk[order]
        first = np.searchsorted(question, question, side="left")
        rank = np.arange(len(question)) - first
        kept = rank < self.k
        full = rank == self.k - 1
        self.bound[question[full]] = distance[full]
        self.question, self.distance, self.chunk = question[kept], distance[kept], chunk[kept]

    def result(self, schema: pa.Schema) -> pa.Table:
        # For unit vectors the squared distance is 2 - 2 cos.
        distance = self.distance / 2.0 if self.metric == "cosine" else self.distance
        return pa.Table.from_arrays(
            [
                self.ids.take(pa.array(self.question)).cast(schema.field(0).type),
                pa.array(self.chunk.tolist(), schema.field(1).type),
                pa.array(distance, pa.float64()),
            ],
            schema=schema,
        )


def _arrow_schema(spark: SparkSession, schema: T.StructType) -> pa.Schema:
    return spark.createDataFrame([], schema).toArrow().schema


def nearest(
    chunks: DataFrame,
    questions: DataFrame,
    k: int = 5,
    metric: str = "l2",
    id_col: str = "chunk_id",
    vector_col: str = "embedding",
    question_id: str = "question_id",
    question_vector: str = "question_embedding",
    filter_col: str | None = None,
    question_filter: str | None = None,
    payload: list[str] | None = None,
    max_sent: int = MAX_SENT_QUESTIONS,
    chunks_per_block: int = CHUNKS_PER_BLOCK,
) -> DataFrame:
    """The k nearest chunks per question with a rank from 1; ties go by chunk id.

    ``metric`` is 'l2' (squared Euclidean) or 'cosine' (one minus cosine). Where a question has a
    value in ``question_filter``, only chunks with that value in ``filter_col`` count. ``payload``
    names chunk columns to bring along. Chunk ids are unique, as the vector table keeps them.
    """
    if k <= 0:
        raise ValueError(f"k must be positive, got {k}")
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric: {metric}")
    require_columns(chunks, [id_col, vector_col, *([filter_col] if filter_col else []), *(payload or [])])
    require_columns(questions, [question_id, question_vector])
    if bool(filter_col) != bool(question_filter):
        raise ValueError("filter_col and question_filter go together")

    asked = questions.select(
        _q(question_id), _q(question_vector), *([_q(question_filter)] if question_filter else [])
    ).filter(_q(question_vector).isNotNull())
    scanned = chunks.select(_q(id_col), _q(vector_col), *([_q(filter_col)] if filter_col else []))
    schema = T.StructType(
        [
            T.StructField(question_id, asked.schema[0].dataType),
            T.StructField(id_col, scanned.schema[0].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    head = asked.limit(max_sent + 1).toArrow()
    sent = head.num_rows <= max_sent and head.nbytes <= MAX_SENT_BYTES
    if sent:
        partial = _scan_with_sent_questions(scanned, head, k, metric, schema)
    else:
        partial = _scan_by_blocks(scanned, asked, k, metric, schema, max_sent, chunks_per_block)
    order = Window.partitionBy(_q(question_id)).orderBy("distance", _q(id_col))
    hits = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    if not payload:
        return hits
    extra = [c for c in payload if c != id_col]
    few = sent and head.num_rows * k <= MAX_SENT_HITS
    winners = F.broadcast(hits) if few else hits
    return chunks.select(_q(id_col), *map(_q, extra)).join(winners, id_col).select(
        *[_q(c) for c in (question_id, "rank", id_col, "distance", *extra)]
    )


def _scan_with_sent_questions(
    scanned: DataFrame, questions: pa.Table, k: int, metric: str, schema: T.StructType
) -> DataFrame:
    sent = scanned.sparkSession.sparkContext.broadcast(questions)
    arrow_schema = _arrow_schema(scanned.sparkSession, schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(sent.value, k, metric)
        for batch in batches:
            best.add(batch)
        yield from best.result(arrow_schema).to_batches()

    return scanned.mapInArrow(scan, schema)


def _scan_by_blocks(
    scanned: DataFrame,
    asked: DataFrame,
    k: int,
    metric: str,
    schema: T.StructType,
    max_sent: int,
    chunks_per_block: int,
) -> DataFrame:
    question_blocks = max(1, math.ceil(2 * asked.count() / max_sent))
    chunk_blocks = max(1, math.ceil(scanned.count() / chunks_per_block))
    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, others: int) -> DataFrame:
        """Each row in one block of its own side and in all blocks of the other side."""
        block = F.pmod(F.xxhash64(*map(_q, df.columns[:2])), F.lit(own_blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.withColumns({own: block, other: every})

    left = dealt(scanned, "_cb", chunk_blocks, "_qb", question_blocks)
    right = dealt(asked, "_qb", question_blocks, "_cb", chunk_blocks)
    arrow_schema = _arrow_schema(scanned.sparkSession, schema)

    def one_block(chunk_part: pa.Table, question_part: pa.Table) -> pa.Table:
        best = _Best(question_part.drop_columns(["_qb", "_cb"]), k, metric)
        best.add(chunk_part.drop_columns(["_qb", "_cb"]))
        return best.result(arrow_schema)

    return (
        left.groupBy("_qb", "_cb").cogroup(right.groupBy("_qb", "_cb")).applyInArrow(one_block, schema)
    )


def nearest_to_vector(
    chunks: DataFrame,
    vector: list[float],
    k: int = 5,
    where: dict | None = None,
    where_text: str | None = None,
    text_col: str = "chunk_text",
    metric: str = "l2",
    **columns,
) -> DataFrame:
    """The k nearest chunks of one query vector.

    ``where`` holds column = value pairs and ``where_text`` a string the text must contain; both
    are filters on the scan.
    """
    kept = chunks
    for name, value in (where or {}).items():
        kept = kept.filter(_q(name) == F.lit(value))
    if where_text is not None:
        kept = kept.filter(_q(text_col).contains(where_text))
    one = _one_question(chunks.sparkSession, vector)
    return nearest(kept, one, k, metric, **columns).drop("question_id")


def _one_question(spark: SparkSession, vector: list[float]) -> DataFrame:
    return local_table(
        spark,
        {"question_id": [1], "question_embedding": [[float(v) for v in vector]]},
        "question_id int, question_embedding array<double>",
    )
