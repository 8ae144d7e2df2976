"""Hard negatives by a vertical scan of the dimensions, in blocks of rows (branch-and-bound on decomposed data).

Anchors look for their positives, the nearest rows of their own label, and then for each positive for the
nearest rows of another label whose score lies in a window set by the positive's score. Scores are inner
products of whole numbers, floor(scale * x) for every component.

A task turns its rows into columns, one for each dimension, with the least and largest value of each. For an
anchor it reads the columns by descending size of the anchor's own component, so that the largest
contributions come first. After each step the columns not yet read can add no less than the sum of their
smallest and no more than the sum of their largest contributions; rows that cannot reach a window or the best
found so far leave the candidates, until the last step gives the exact scores of those that remain. Only
scores that are certain raise the bound: those of rows that are surely in the window.

Anchors grow with the table, so they are dealt into blocks of about ``ANCHORS`` rows and ``ANCHOR_BYTES``;
one block at a time is sent to the tasks, in two scans (positives, then negatives), and the result of each
block is a written table. The shuffles carry the best rows of each task. No pair of rows becomes a row.

Defined cases: rows with a null id, label or vector, or with a null, infinite or NaN component take no part;
a shorter vector counts as having zeros behind, an empty one scores 0; rows of the anchor's own id are
never its positives or negatives, other rows that repeat an id are rows of their own; each row of a
repeated anchor has its results; without a positive, or with positives of negative score, there is no
negative; an empty table gives an empty result. Scores beyond 64 bits raise an error. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.llm.common import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's score.
LOW, HIGH = 30, 90
ANCHORS, ANCHOR_BYTES = 20_000, 32 << 20
#: Rows of a block where the cores allow for it, and rows of a task at most.
BLOCK, MOST = 8192, 1_000_000
FIRST_STEP = 8
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53
NOTHING = np.iinfo(np.int64).min


def _whole(vectors: pa.Array, scale: int, width: int | None = None) -> np.ndarray:
    """A row for each vector: whole numbers as doubles, cut or filled with zeros to the same width."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    width = width if width is not None else int(sizes.max(initial=0))
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out, place = np.zeros((len(sizes), width)), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = place < width
    out[np.repeat(np.arange(len(sizes)), sizes)[kept], place[kept]] = values[kept]
    return out


class Anchors:
    """A block of anchors, as it is sent to the tasks: ids, labels, components and their order by size."""

    def __init__(self, rows: pa.Table, scale: int):
        self.ids, self.labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        self.values = _whole(rows["vector"].combine_chunks(), scale)
        self.order = np.argsort(-np.abs(self.values), axis=1, kind="stable")
        self.width, self.scale = self.values.shape[1], scale


class Block:
    """Rows as columns of dimensions, sorted by label, with the range of each dimension."""

    def __init__(self, batch: pa.RecordBatch, anchors: Anchors):
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        order = np.argsort(labels, kind="stable")
        self.labels, self.ids = labels[order], batch.column("id").to_numpy(zero_copy_only=False)[order]
        self.columns = np.ascontiguousarray(_whole(batch.column("vector"), anchors.scale, anchors.width)[order].T)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)
        self.size = np.maximum(-self.least, self.most)

    def scan(self, anchors: Anchors, number: int, rows: np.ndarray, alive: Callable) -> tuple[np.ndarray, np.ndarray]:
        """The rows of ``rows`` that ``alive`` (partial sums, least and largest rest) keeps to the end, and their scores."""
        values, order, width = anchors.values[number], anchors.order[number], anchors.width
        if not len(rows):
            return rows, np.zeros(0, np.int64)
        if float(np.abs(values) @ self.size) >= EXACT:  # beyond doubles: whole numbers of any size, no bounds
            whole = [int(v) for v in values]
            scores = [sum(a * int(x) for a, x in zip(whole, self.columns[:, row], strict=True)) for row in rows]
            return rows, np.array(scores, np.int64)
        first, second = values * self.least, values * self.most
        rest_low = np.append(np.cumsum(np.minimum(first, second)[order][::-1])[::-1], 0.0)
        rest_high = np.append(np.cumsum(np.maximum(first, second)[order][::-1])[::-1], 0.0)
        partial, done, stop = np.zeros(len(rows)), 0, min(FIRST_STEP, width)
        while True:
            columns = order[done:stop]
            part = self.columns[columns]
            partial = partial + values[columns] @ (part if len(rows) == part.shape[1] else part[:, rows])
            kept = alive(partial, rest_low[stop], rest_high[stop])
            rows, partial = rows[kept], partial[kept]
            if stop == width or not len(rows):
                return rows, partial.astype(np.int64)
            done, stop = stop, min(2 * stop, width)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by id."""
    if len(scores) > 4 * k:
        kept = scores >= np.partition(scores, -k)[-k]
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class _Found:
    """The best k (score, id) of each of a number of lists, among the rows that a task has seen."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((lists, k), NOTHING), np.zeros((lists, k), np.int64)

    def floor(self, number: int) -> int:
        return self.scores[number, -1]

    def add(self, number: int, scores: np.ndarray, ids: np.ndarray) -> None:
        full = self.scores[number] != NOTHING
        scores, ids = _best(np.append(self.scores[number][full], scores), np.append(self.ids[number][full], ids), self.k)
        self.scores[number, :len(scores)], self.ids[number, :len(ids)] = scores, ids

    def batches(self) -> Iterator[pa.RecordBatch]:
        number, place = np.nonzero(self.scores != NOTHING)
        arrays = [pa.array(number.astype(np.int64)), pa.array(self.ids[number, place]), pa.array(self.scores[number, place])]
        yield from pa.Table.from_arrays(arrays, ["list", "id", "score"]).to_batches(max_chunksize=10_000)


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, -k)[-k] if len(values) >= k else -math.inf


def _scan(rows: DataFrame, sent, lists: int, k: int, look: Callable) -> DataFrame:
    """list, id, score: the best k of each list, of all tasks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found(lists, k)
        for batch in batches:
            if batch.num_rows:
                look(sent.value, Block(batch, sent.value[0]), found)
        yield from found.batches()

    best = rows.mapInArrow(scan, "list long, id long, score long")
    place = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k)


def _positives(sent_value: tuple, block: Block, found: _Found) -> None:
    (anchors,) = sent_value
    for number in range(len(anchors.ids)):
        start, stop = np.searchsorted(block.labels, anchors.labels[number], "left"), np.searchsorted(block.labels, anchors.labels[number], "right")
        rows = np.arange(start, stop)
        rows = rows[block.ids[rows] != anchors.ids[number]]

        def alive(partial, low, high, number=number):
            return partial + high >= max(found.floor(number), _kth(partial, found.k) + low)

        rows, scores = block.scan(anchors, number, rows, alive)
        if len(rows):
            found.add(number, scores, block.ids[rows])


def _negatives(sent_value: tuple, block: Block, found: _Found) -> None:
    """``sent_value`` has the anchors, and of each list (by anchor) its anchor and window; lists are sorted by anchor."""
    anchors, owner, lows, highs = sent_value
    firsts = np.searchsorted(owner, np.arange(len(anchors.ids) + 1))
    for number in np.unique(owner):
        lists = range(firsts[number], firsts[number + 1])
        rows = np.flatnonzero((block.labels != anchors.labels[number]) & (block.ids != anchors.ids[number]))

        def alive(partial, low, high, lists=lists):
            kept = np.zeros(len(partial), bool)
            for i in lists:
                floor = max(lows[i], found.floor(i))
                certain = partial[(partial + low >= floor) & (partial + high <= highs[i])]
                floor = max(floor, _kth(certain, found.k) + low)
                kept |= (partial + high >= floor) & (partial + low <= highs[i])
            return kept

        rows, scores = block.scan(anchors, number, rows, alive)
        for i in lists:
            inside = (scores >= max(lows[i], found.floor(i))) & (scores <= highs[i])
            if inside.any():
                found.add(i, scores[inside], block.ids[rows[inside]])


def _windows(positives: pa.Table, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor number and least and largest score of every list; (1, 0) where no score can be."""
    scores = positives["score"].to_pylist()
    lows, highs = [-(-low * s // 100) for s in scores], [high * s // 100 for s in scores]
    return positives["list"].to_numpy(), np.array(lows, np.int64), np.array(highs, np.int64)


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells by the id column which rows are anchors. For each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = vectors.sparkSession
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("asks")
    )
    count, asking, size = rows.agg(F.count("*"), F.count_if("asks"), F.sum(F.when(F.col("asks"), 8 * F.size("vector")))).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not asking:
        return spark.createDataFrame([], result)
    parts = min(math.ceil(count / BLOCK), max(4 * spark.sparkContext.defaultParallelism, math.ceil(count / MOST)))
    dealt = rows.select("id", "label", "vector").repartition(parts, "id")
    blocks, written = max(math.ceil(2 * asking / anchors_at_once) if asking > anchors_at_once else 1, math.ceil(size / ANCHOR_BYTES)), None
    for block in range(blocks):
        asked = rows.filter(F.col("asks") & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)).select("id", "label", "vector").toArrow()
        if not asked.num_rows:
            continue
        anchors = Anchors(asked.sort_by([("id", "ascending"), ("label", "ascending")]), scale)
        sent = spark.sparkContext.broadcast((anchors,))
        near = _scan(dealt, sent, len(anchors.ids), positives, _positives).toArrow()
        near = near.sort_by([("list", "ascending"), ("rank", "ascending")])
        sent.unpersist()
        owner, lows, highs = _windows(near, low, high)
        if not len(owner):
            continue
        sent = spark.sparkContext.broadcast((anchors, owner, lows, highs))
        far = _scan(dealt, sent, len(owner), negatives, _negatives)
        named = pa.table({"list": np.arange(len(owner)), "anchor_id": anchors.ids[owner], "positive_id": near["id"], "positive_score": near["score"]})
        pairs = far.join(F.broadcast(spark.createDataFrame(named)), "list").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        pairs = staged(pairs, "hard-negatives")
        sent.unpersist()
        written = pairs if written is None else written.unionByName(pairs)
    return written if written is not None else spark.createDataFrame([], result)
