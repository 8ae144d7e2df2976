"""Overlapping text chunks.

The two splitters need a left-to-right scan in which each cut depends on the one before, which
built-in expressions cannot do in linear time. They run as Arrow UDFs on the text column only.
Everything around them (ids, counts, lengths, statistics) is built-in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import text as tx
from narrata.functions.batches import slices
from narrata.operators.profile import histogram, value_counts
from narrata.params import SEPARATORS, check_chunking, require_columns

# --- fixed values: sentence ends of the window splitter, in order of preference ---
SENTENCE_ENDS = [". ", "! ", "? ", "\n\n", "\n"]
#: Bytes of text that a worker splits at a time, besides one text.
SLICE = 1 << 20
# ----------------------------------------------------------------------------------

Splitter = Callable[[str], list[str]]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def window_splitter(
    size: int = 500, overlap: int = 50, measure: Callable[[str], int] = len
) -> Splitter:
    """Windows of ``size`` that end at a sentence, else at a space, and step back by ``overlap``.

    The first kind of sentence end found in the window wins, at its last place. A step back that
    would not move forward starts at the cut itself, so every text ends.
    """
    check_chunking(size, overlap)

    def last_cut(text: str, start: int, end: int) -> int:
        ends = ((text.rfind(mark, start, end), len(mark)) for mark in SENTENCE_ENDS)
        cut = next((at + width for at, width in ends if at >= 0), end)
        if cut < end:
            return cut
        space = text.rfind(" ", start, end)
        return space + 1 if space >= 0 else end

    def split(text: str) -> list[str]:
        if measure(text) <= size:
            return [text]
        pieces, start = [], 0
        while start + size < len(text):
            cut = last_cut(text, start, start + size)
            pieces.append(text[start:cut].strip())
            start = cut - overlap if cut - overlap > start else cut
        return [*pieces, text[start:]]

    return split


def recursive_splitter(
    size: int = 500,
    overlap: int = 50,
    separators: list[str] | None = None,
    measure: Callable[[str], int] = len,
) -> Splitter:
    """Chunks of at most ``size`` cut at the coarsest separator that makes them fit.

    A text is cut before every occurrence of the first separator it contains. Neighbouring pieces
    under ``size`` are joined up to ``size``; the next chunk starts with the last pieces of the one
    before, up to ``overlap``. Longer pieces are cut by the finer separators.
    """
    check_chunking(size, overlap)
    separators = SEPARATORS if separators is None else separators

    def cuts(text: str, start: int, end: int, separator: str) -> list[int]:
        """Bounds of the pieces of text[start:end], which are never empty."""
        if not separator:
            return list(range(start, end + 1))
        bounds, at = [start], text.find(separator, start, end)
        while at >= 0:
            if at > start:
                bounds.append(at)
            at = text.find(separator, at + len(separator), end)
        return [*bounds, end]

    def joined(text: str, bounds: list[int], sizes: list[int]) -> Iterator[str]:
        """Greedy windows over neighbouring pieces, stripped, blank ones dropped."""
        low, total = 0, 0
        for high, width in enumerate(sizes):
            if total + width > size and high > low:
                yield text[bounds[low] : bounds[high]].strip()
                while total > overlap or (total > 0 and total + width > size):
                    total -= sizes[low]
                    low += 1
            total += width
        yield text[bounds[low] : bounds[-1]].strip()

    def pieces(text: str, start: int, end: int, level: int) -> Iterator[str]:
        while level < len(separators) - 1 and text.find(separators[level], start, end) < 0:
            level += 1
        bounds = cuts(text, start, end, separators[level])
        finest = level == len(separators) - 1 or not separators[level]
        run, sizes = [start], []
        for low, high in zip(bounds, bounds[1:]):
            width = high - low if measure is len else measure(text[low:high])
            if width < size:
                run.append(high)
                sizes.append(width)
                continue
            if sizes:
                yield from joined(text, run, sizes)
            if finest:
                yield text[low:high]
            else:
                yield from pieces(text, low, high, level + 1)
            run, sizes = [high], []
        if sizes:
            yield from joined(text, run, sizes)

    def split(text: str) -> list[str]:
        return [p for p in pieces(text, 0, len(text), 0) if p] if text else []

    return split


def make_splitter(kind: str = "recursive", size: int = 500, overlap: int = 50) -> Splitter:
    kinds = {"recursive": recursive_splitter, "window": window_splitter}
    if kind not in kinds:
        raise ValueError(f"unknown splitter: {kind}")
    return kinds[kind](size, overlap)


def _given(text: Column, kind: str, given: Callable[[str], list]) -> Column:
    """What ``given`` makes of a text, an array of ``kind``. Empty for null and blank text.

    A batch is worked off in slices, and what a slice gives leaves the worker before the next one is begun.
    """
    arrow = pa.list_({"string": pa.string(), "int": pa.int32()}[kind])

    @F.arrow_udf(f"array<{kind}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for _, texts in slices(batch, SLICE):
                yield pa.array([given(t) for t in texts.to_pylist()], arrow)

    real = F.coalesce(~tx.is_blank(text), F.lit(False))
    return F.when(real, run(F.when(real, text).otherwise(""))).otherwise(F.array().cast(f"array<{kind}>"))


def chunks_of(text: Column, splitter: Splitter) -> Column:
    """Array of the chunks of a text. Empty for null and blank text."""
    return _given(text, "string", splitter)


def lengths_of(text: Column, splitter: Splitter) -> Column:
    """Array of the lengths of the chunks of a text; the chunks stay in the worker, those of one text at a time."""
    return _given(text, "int", lambda t: [len(piece) for piece in splitter(t)])


def chunk_table(
    df: DataFrame,
    text_col: str,
    key_col: str,
    splitter: Splitter,
    metadata: list[str] | None = None,
) -> DataFrame:
    """One row per chunk with its id, place, length, the chunk count and the metadata columns.

    ``key_col`` identifies the document and is the first part of the chunk id. Rows without text
    give no chunk.
    """
    require_columns(df, [text_col, key_col])
    if metadata is None:
        metadata = [c for c in df.columns if c != text_col]
    else:
        require_columns(df, metadata)
    kept = [c for c in metadata if c != key_col]
    with_text = df.filter(~tx.is_blank(_q(text_col)))
    chunked = with_text.select(
        _q(key_col).alias("original_index"),
        *map(_q, kept),
        *([_q(key_col).alias("_key")] if key_col in metadata else []),
        chunks_of(_q(text_col), splitter).alias("_chunks"),
    )
    # The outer form: for the inner one the optimizer adds a filter on the size of the array below
    # the projection, and the splitter would run a second time for it.
    rows = chunked.select(
        "*",
        F.size("_chunks").alias("num_chunks"),
        F.posexplode_outer("_chunks").alias("chunk_index", "chunk_text"),
    ).filter("chunk_text IS NOT NULL")
    return rows.select(
        F.concat_ws("_", "original_index", "chunk_index").alias("chunk_id"),
        "original_index",
        "chunk_index",
        "chunk_text",
        F.length("chunk_text").alias("chunk_length"),
        "num_chunks",
        *[F.col("_key").alias(c) if c == key_col else _q(c) for c in metadata],
    )


def chunk_function(splitter: Splitter):
    """The splitter as a table function of a text: (chunk_index, num_chunks, chunk_text).

    For a lateral join, or for SQL after ``spark.udtf.register(name, chunk_function(...))``. The
    splitter may bring its own measure and separators. Null and blank texts give no row.
    """

    @F.udtf(returnType="chunk_index int, num_chunks int, chunk_text string", useArrow=True)
    class Chunks:
        def eval(self, text: str):
            pieces = splitter(text) if text is not None and text.strip() else []
            for index, piece in enumerate(pieces):
                yield index, len(pieces), piece

    return Chunks


def chunk_rows(
    df: DataFrame, text_col: str, key_col: str, splitter: Splitter, metadata: list[str] | None = None
) -> DataFrame:
    """The rows of ``chunk_table`` by a lateral join with the table function.

    The chunks of a text come back as rows, not as one array in a row, which keeps the rows of very
    long texts small.
    """
    require_columns(df, [text_col, key_col, *(metadata or [])])
    kept = [c for c in df.columns if c != text_col] if metadata is None else metadata
    with_text = df.filter(~tx.is_blank(_q(text_col))).select(
        _q(key_col).alias("_key"), _q(text_col).alias("_text"), F.struct(F.lit(1).alias("_one"), *map(_q, kept)).alias("_kept")
    )
    rows = with_text.lateralJoin(chunk_function(splitter)(F.col("_text").outer()))
    return rows.select(
        F.concat_ws("_", "_key", "chunk_index").alias("chunk_id"),
        F.col("_key").alias("original_index"),
        "chunk_index",
        "chunk_text",
        F.length("chunk_text").alias("chunk_length"),
        "num_chunks",
        *[F.col("_kept")[c].alias(c) for c in kept],
    )


def _measured(df: DataFrame, text_col: str, splitter: Splitter) -> DataFrame:
    """Counts per (kind, value): rows, texts, chunks per document and chunk lengths.

    The splitter runs once over the table; all statistics below come from this small result.
    """
    base = df.select(
        _q(text_col).isNotNull().alias("given"), lengths_of(_q(text_col), splitter).alias("lengths")
    ).select("given", F.size("lengths").alias("pieces"), "lengths")

    def entry(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("int").alias("value"))

    entries = F.concat(
        F.array(
            entry("row", F.lit(1)),
            entry("text", F.col("given")),
            entry("document", F.col("pieces")),
        ),
        F.transform("lengths", lambda length: entry("length", length)),
    )
    return value_counts(base.select(F.inline_outer(entries)), "kind")


def _per(kind: str, measured: DataFrame) -> DataFrame:
    keep = F.col("kind") == kind
    return measured.filter(keep & (F.col("value") > 0) if kind != "length" else keep)


def _stats(measured: DataFrame) -> list[Column]:
    is_doc = (F.col("kind") == "document") & (F.col("value") > 0)
    is_length = F.col("kind") == "length"
    value, n = F.col("value"), F.col("n")

    def total(condition: Column, amount: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))

    lengths = {"q25": 0.25, "q75": 0.75, "q90": 0.90, "q95": 0.95}
    linear = F.sum(F.when(is_length, value.cast("double") * n))
    square = F.sum(F.when(is_length, value.cast("double") * value * n))
    pieces = F.sum(F.when(is_length, n))
    documents = F.sum(F.when(is_doc, n))
    rows = F.sum(F.when(F.col("kind") == "row", n))
    length_value, doc_value = F.when(is_length, value), F.when(is_doc, value)
    return [
        total((F.col("kind") == "text") & (value == 1), n).alias("total_documents"),
        total(is_length, n).alias("total_chunks"),
        (F.sum(F.when(is_doc, value * n)) / documents).alias("avg_chunks_per_doc"),
        F.percentile(doc_value, F.lit(0.5), n).alias("median_chunks_per_doc"),
        F.max(doc_value).alias("max_chunks_per_doc"),
        (F.coalesce(pieces, F.lit(0)) / rows).alias("avg_chunks_per_row"),
        (linear / pieces).alias("mean"),
        F.percentile(length_value, F.lit(0.5), n).alias("median"),
        F.sqrt(F.greatest(square / pieces - (linear / pieces) ** 2, F.lit(0.0))).alias("std"),
        F.min(length_value).alias("min"),
        F.max(length_value).alias("max"),
        *[F.percentile(length_value, F.lit(p), n).alias(k) for k, p in lengths.items()],
    ]


def _within(size: int) -> list[Column]:
    is_length = F.col("kind") == "length"
    out = []
    for percent in (10, 20):
        inside = is_length & F.col("value").between(F.lit(size * (100 - percent) / 100), F.lit(size * (100 + percent) / 100))
        out.append(F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias(f"within_{percent}_percent"))
    return out


def _with_percentages(counts: DataFrame) -> DataFrame:
    total = F.nullif("total_chunks", F.lit(0))
    return counts.select(
        "*",
        (F.col("within_10_percent") / total * 100).alias("percentage_within_10"),
        (F.col("within_20_percent") / total * 100).alias("percentage_within_20"),
    )


def chunk_stats(df: DataFrame, text_col: str, splitter: Splitter) -> DataFrame:
    """Documents, chunks, chunks per document and chunk-length statistics.

    ``total_documents`` counts every text that is not null, also blank ones. The standard
    deviation is that of the population.
    """
    measured = _measured(df, text_col, splitter)
    return measured.agg(*_stats(measured))


def chunk_targets(df: DataFrame, text_col: str, splitter: Splitter, size: int = 500) -> DataFrame:
    """Chunks whose length is within 10 and 20 percent of the target, count and percent."""
    lengths = _measured(df, text_col, splitter).filter("kind = 'length'")
    return _with_percentages(lengths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_chunks"), *_within(size)))


def chunk_report(df: DataFrame, text_col: str, splitter: Splitter, size: int = 500) -> DataFrame:
    """``chunk_stats`` and ``chunk_targets`` in one row, from one pass of the splitter."""
    measured = _measured(df, text_col, splitter)
    return _with_percentages(measured.agg(*_stats(measured), *_within(size)))


def chunk_count_histogram(
    df: DataFrame, text_col: str, splitter: Splitter, last: int | None = None
) -> DataFrame:
    """Documents per number of chunks, from 1 to the largest number found.

    With ``last`` the bins end there, and the last one takes all larger numbers.
    """
    documents = _per("document", _measured(df, text_col, splitter))
    number = F.col("value") if last is None else F.least("value", F.lit(last))
    filled = documents.groupBy(number.alias("bin")).agg(F.sum("n").alias("n"))
    end = F.coalesce(F.max("bin"), F.lit(0)) if last is None else F.lit(last)
    ends = filled.agg(end.cast("int").alias("end")).filter("end > 0")
    bins = ends.select(F.explode(F.sequence(F.lit(1), F.col("end"))).alias("bin"))
    return bins.join(filled, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def chunk_length_histogram(
    df: DataFrame, text_col: str, splitter: Splitter, bins: int = 40
) -> DataFrame:
    """Histogram of chunk lengths in equal bins."""
    return histogram(_per("length", _measured(df, text_col, splitter)).select("value", "n"), bins)
