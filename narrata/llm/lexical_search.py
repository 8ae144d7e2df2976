"""Ranked lexical search without an index: one automaton of all query terms reads the texts.

The terms of all items are put between boundary signs and built into one Aho-Corasick automaton. A task maps
every sign that is no part of a term to the boundary sign, byte by byte, runs the automaton over the text,
and so counts how often each term occurs as a whole term. The automaton's outputs are term numbers, which a
table of postings maps to items. Documents are read twice and nothing of them is stored: the first scan counts
documents, terms and the documents that hold each term; with these the second one scores every document for
every item and keeps the best of each item. The shuffles carry counts by term and the best rows of each task;
the result of a block of items is a written table.

Weights and scores are integers: a term's weight is floor(1000 * ln((2N+2) / (2df+1))), a document's length
term m = 75 + (25 n N) div L, and a score sums weight * ((10^9 tf) div (1000 tf + 12 m)) over the terms of an
item with their repeats.

Bounds: the items are dealt into blocks of about ``POSTINGS`` (item, term) pairs, and one block at a time is
sent to the tasks, so what is sent does not grow with the items; a block holds one item at least. Scores are
held for ``CELLS`` pairs of document and item at once. Every number that reaches the driver belongs to a block.

Defined cases: a null text has no terms, as has a text of separators; items without a term have no rows; rows
of items that share an item_id (null included) are one item with the terms of all of them; rows of documents
that repeat an id are documents of their own; a null doc_id ranks last among equal scores; without documents
or items the result is empty. Only item_id, doc_id and text are read, other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from narrata.llm.common import staged

#: Fixed value: a term is a run of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 20
POSTINGS = 400_000
CELLS = 2_000_000
#: Documents, and bytes of text, that a task looks at together.
STEP_ROWS, STEP_BYTES = 256, 4 << 20
#: Parts in which a task's best rows of an item are thinned before one task ranks them.
PARTS = 32

_BOUND = 10
_is_term = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_TABLE = bytes(ord(chr(b).lower()) if b < 128 and _is_term[b] else b if _is_term[b] else _BOUND for b in range(256))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times: how often each term stands in the texts of an item."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(terms).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times"))


class Query:
    """The terms of a block of items, and which items each belongs to. This is what is sent to the tasks."""

    def __init__(self, rows: pa.Table):
        items = rows["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        terms = rows["term"].combine_chunks().dictionary_encode()
        self.items: pa.Array = items.dictionary
        self.terms: list[str] = terms.dictionary.to_pylist()
        term = terms.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        self.item = items.indices.to_numpy(zero_copy_only=False)[order].astype(np.int64)
        self.times = rows["times"].to_numpy()[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(self.terms):
            found.add_word("\n" + term.encode().decode("latin-1") + "\n", number)
        found.make_automaton()
        return found


def _steps(texts: pa.Array, rows: int) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes with boundary signs, some at a time."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at + len(some) < len(texts) and len(some) < rows and size < STEP_BYTES:
            text = texts[at + len(some)]
            some.append(text.as_buffer().to_pybytes().translate(_TABLE) if text.is_valid else b"")
            size += len(some[-1])
        yield at, some
        at += len(some)


def _occurrences(automaton, n_terms: int, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each text; then text, term and number of occurrences of each query term in a text."""
    joined = b"\n" + b"\n".join(texts) + b"\n"
    ends = np.cumsum([len(t) + 1 for t in texts])  # the boundary after each text
    signs = np.frombuffer(joined, np.uint8) != _BOUND
    starts = np.flatnonzero(signs[1:] & ~signs[:-1]) + 1
    sizes = np.bincount(np.searchsorted(ends, starts), minlength=len(texts))
    hits = np.fromiter(chain.from_iterable(automaton.iter(joined.decode("latin-1"))) if n_terms else (), np.int64)
    cells, number = np.unique(np.searchsorted(ends, hits[::2]) * max(n_terms, 1) + hits[1::2], return_counts=True)
    return sizes, cells // max(n_terms, 1), cells % max(n_terms, 1), number


def _counted(docs: DataFrame, sent) -> DataFrame:
    """(key, number): documents holding each term by its number; -1 counts documents with a term, -2 all terms."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = sent.value
        automaton, held = query.automaton(), np.zeros(len(query.terms), np.int64)
        with_term = all_terms = 0
        for batch in batches:
            for _, texts in _steps(batch.column("text"), STEP_ROWS):
                sizes, _, term, _ = _occurrences(automaton, len(query.terms), texts)
                held += np.bincount(term, minlength=len(held))
                with_term, all_terms = with_term + int((sizes > 0).sum()), all_terms + int(sizes.sum())
        keys = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*keys.tolist(), -1, -2], pa.int32()), pa.array([*held[keys].tolist(), with_term, all_terms], pa.int64())], ["key", "number"]
        )

    return docs.select("text").mapInArrow(scan, "key int, number long").groupBy("key").agg(F.sum("number").alias("number"))


class _Best:
    """The highest-scoring documents of each item among those that a task has seen."""

    def __init__(self, items: int, top: int):
        self.top, self.floor, self.rows = top, np.ones(items, np.int64), None

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        """``scores`` has a row for each document and a column for each item."""
        if len(scores) >= self.top:
            self.floor = np.maximum(self.floor, np.partition(scores, -self.top, axis=0)[-self.top])
        doc, item = np.nonzero(scores >= self.floor)
        if not len(doc):
            return
        rows = pa.table({"item": item, "score": scores[doc, item], "doc_id": ids.take(pa.array(doc))})
        rows = rows if self.rows is None else pa.concat_tables([self.rows, rows])
        rows = rows.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
        item, score = rows["item"].to_numpy(), rows["score"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.top - 1
        self.floor[item[last]] = score[last]
        self.rows = rows.filter(pa.array(place < self.top))


def _scored(docs: DataFrame, sent, weights: np.ndarray, n_docs: int, n_terms: int, top: int, id_kind: str) -> DataFrame:
    """item_id, doc_id, score: the best rows of each task."""

    def scores(query: Query, sizes, doc, term, number) -> np.ndarray:
        out = np.zeros(len(sizes) * len(query.items), np.int64)
        m = 75 + 25 * sizes * n_docs // n_terms
        value = weights[term] * (1_000_000_000 * number // (1000 * number + 12 * m[doc]))
        wide = query.first[term + 1] - query.first[term]
        at = 0
        while at < len(doc):  # so many pairs of document and term that their items fit
            upto = max(at + 1, at + int(np.searchsorted(np.cumsum(wide[at:at + CELLS]), CELLS)))
            w = wide[at:upto]
            posting = np.arange(w.sum()) + np.repeat(query.first[term[at:upto]] - np.cumsum(w) + w, w)
            np.add.at(out, np.repeat(doc[at:upto], w) * len(query.items) + query.item[posting], np.repeat(value[at:upto], w) * query.times[posting])
            at = upto
        return out.reshape(len(sizes), len(query.items))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = sent.value
        automaton, best = query.automaton(), _Best(len(query.items), top)
        rows = max(1, min(STEP_ROWS, CELLS // len(query.items)))
        for batch in batches:
            for at, texts in _steps(batch.column("text"), rows):
                best.add(scores(query, *_occurrences(automaton, len(query.terms), texts)), batch.column("doc_id").slice(at, len(texts)))
        if best.rows is not None:
            items = query.items.take(best.rows["item"].combine_chunks())
            yield from pa.table({"item_id": items, "doc_id": best.rows["doc_id"], "score": best.rows["score"]}).to_batches()

    return docs.mapInArrow(scan, f"item_id {id_kind}, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")


def _ranked(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, postings: int = POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0, ties by doc_id."""
    spark, docs, terms = docs.sparkSession, docs.select("doc_id", "text"), item_terms(items.select("item_id", "text"))
    kind = terms.schema["item_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    blocks, found = max(1, math.ceil(2 * terms.count() / postings)), None
    for block in range(blocks):
        rows = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        if not rows.num_rows:
            continue
        sent = spark.sparkContext.broadcast(Query(rows))
        counts = dict(map(tuple, _counted(docs, sent).collect()))
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        if not n_terms:
            continue
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(sent.value.terms))], np.int64)
        some = _scored(docs, sent, weights, n_docs, n_terms, top, kind)
        thinned = _ranked(some.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))), top, "item_id", "part")
        some = staged(_ranked(thinned, top, "item_id").select("item_id", "rank", "doc_id", "score"), "lexical-search")
        sent.unpersist()
        found = some if found is None else found.unionByName(some)
    return empty if found is None else found
