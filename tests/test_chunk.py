import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.functions.batches import slices
from narrata.operators import chunk
from narrata.params import SEPARATORS

WORDS = st.sampled_from(["a", "bb", "ccc", "dddd. ", "e! ", "f? ", "g; ", "h, ", " ", "\n", "\n\n", ". ", "long" * 9, "é"])
TEXTS = st.lists(WORDS, max_size=120).map("".join)


def slow_recursive(text, size, overlap, separators):
    """Lists of strings instead of offsets: split before the separator, join, recurse."""
    here, *finer = separators
    while here and here not in text and finer:
        here, *finer = finer
    if here:
        parts = [p for p in re.split(f"(?={re.escape(here)})", text) if p] if here in text else [text]
        if here == "\n\n":  # lookahead also splits inside a run of three breaks
            parts, rest = [], text
            while here in rest[1:] if rest.startswith(here) else here in rest:
                at = rest.find(here, 2 if rest.startswith(here) else 0)
                if at < 0:
                    break
                if at:
                    parts.append(rest[:at])
                rest = rest[at:]
            parts.append(rest)
    else:
        parts = list(text)
    out, run = [], []

    def flush():
        window = []
        for part in run:
            if window and sum(map(len, window)) + len(part) > size:
                out.append("".join(window).strip())
                while window and (
                    sum(map(len, window)) > overlap or sum(map(len, window)) + len(part) > size
                ):
                    window.pop(0)
            window.append(part)
        if window:
            out.append("".join(window).strip())
        run.clear()

    for part in parts:
        if len(part) < size:
            run.append(part)
            continue
        flush()
        out.extend(slow_recursive(part, size, overlap, finer) if finer and here else [part])
    flush()
    return [c for c in out if c]


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.sampled_from([(10, 0), (12, 3), (30, 10), (50, 49), (2, 1)]))
def test_recursive_equals_slow_form(text, sizes):
    size, overlap = sizes
    got = chunk.recursive_splitter(size, overlap)(text)
    assert got == (slow_recursive(text, size, overlap, SEPARATORS) if text else [])
    assert all(len(c) <= size for c in got)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([(10, 0), (12, 3), (30, 10), (50, 49), (2, 1)]))
def test_window_splitter_ends_and_covers(text, sizes):
    size, overlap = sizes
    got = chunk.window_splitter(size, overlap)(text)
    assert all(len(c) <= size for c in got)
    covered = "".join(got)
    for symbol in set(text) - set(" \n"):
        assert covered.count(symbol) >= text.count(symbol)


EDGES = {
    "short": "x" * 500,
    "one over": "x" * 501,
    "no spaces": "y" * 1700,
    "early end": "Stop. " + "z" * 1000,
    "lines": "line\n" * 300,
    "blanks": " " * 1200 + "end",
}


@pytest.mark.parametrize("name", EDGES)
def test_window_edges(name):
    text = EDGES[name]
    got = chunk.window_splitter(500, 50)(text)
    assert "".join(got).replace(" ", "").replace("\n", "").startswith(text.strip()[:4].strip())
    if name == "short":
        assert got == [text]
    if name == "one over":
        assert [len(c) for c in got] == [500, 51]
    if name == "early end":
        assert got[0] == "Stop." and got[1].startswith("zzz")


def test_bad_sizes():
    for size, overlap in ((0, 0), (10, 10), (10, -1)):
        with pytest.raises(ValueError):
            chunk.window_splitter(size, overlap)
        with pytest.raises(ValueError):
            chunk.recursive_splitter(size, overlap)
    with pytest.raises(ValueError):
        chunk.make_splitter("other")


def test_own_measure_and_separators():
    by_words = chunk.recursive_splitter(3, 0, [" ", ""], measure=lambda t: len(t.split()))
    assert by_words("a b c d e f g") == ["a b c", "d e f", "g"]
    assert chunk.recursive_splitter(4, 0, ["|"])("ab|cdefgh|i") == ["ab", "|cdefgh", "|i"]


def test_chunk_table_and_statistics(spark):
    long_text = "Some words here. " * 100
    rows = [(7, long_text, "p"), (8, None, "q"), (9, "  ", "q"), (10, "brief", None)]
    df = spark.createDataFrame(rows, "id long, text string, kind string")
    for splitter in (chunk.window_splitter(100, 10), chunk.recursive_splitter(100, 10)):
        pieces = splitter(long_text)
        out = chunk.chunk_table(df, "text", "id", splitter).orderBy("original_index", "chunk_index").collect()
        assert [r.chunk_text for r in out] == [*pieces, "brief"]
        assert [r.chunk_id for r in out] == [*[f"7_{i}" for i in range(len(pieces))], "10_0"]
        assert out[0].num_chunks == len(pieces) and out[0].kind == "p" and out[0].id == 7
        sizes = np.array([len(p) for p in [*pieces, "brief"]])
        stats = chunk.chunk_stats(df, "text", splitter).first()
        assert (stats.total_documents, stats.total_chunks) == (3, len(sizes))
        assert stats.avg_chunks_per_doc == pytest.approx(len(sizes) / 2)
        assert stats.avg_chunks_per_row == pytest.approx(len(sizes) / 4)
        assert stats["std"] == pytest.approx(sizes.std())
        assert stats.q90 == pytest.approx(np.percentile(sizes, 90))
        target = chunk.chunk_targets(df, "text", splitter, 100).first()
        assert target.within_10_percent == int(((sizes >= 90) & (sizes <= 110)).sum())
    with pytest.raises(ValueError):
        chunk.chunk_table(df, "nowhere", "id", chunk.window_splitter())


def test_empty_table_has_no_chunks(spark):
    df = spark.createDataFrame([(1, None)], "id long, text string")
    assert chunk.chunk_table(df, "text", "id", chunk.window_splitter()).count() == 0
    assert chunk.chunk_stats(df, "text", chunk.window_splitter()).first().total_chunks == 0


def test_table_function(spark):
    """Own measure and separators: the lateral join gives the rows of the chunk table, in SQL too."""
    splitter = chunk.recursive_splitter(3, 1, ["\n", " "], measure=lambda text: len(text.split()))
    rows = [(1, "a b c d e f g", "x", 1), (2, None, "y", 2), (3, " \n ", "z", 3), (4, "one two", None, 4), (4, "one two", None, 4),
            (None, "no key", "k", 5), (6, "w " * 50_000, "long", 6)]
    df = spark.createDataFrame(rows, "id int, text string, chunk_kind string, `odd.name` int")
    lateral = chunk.chunk_rows(df, "text", "id", splitter)
    assert [r.chunk_text for r in lateral.filter("id = 1").orderBy("chunk_index").collect()] == ["a b c", "c d e", "e f g"]
    table = chunk.chunk_table(df, "text", "id", splitter)
    assert lateral.columns == table.columns and lateral.dtypes == table.dtypes
    assert sorted(map(str, lateral.collect())) == sorted(map(str, table.collect()))
    assert lateral.filter("id = 6").count() == 25_000 - 1 + 1
    assert chunk.chunk_rows(df.limit(0), "text", "id", splitter, []).count() == 0
    spark.udtf.register("chunks_of_text", chunk.chunk_function(splitter))
    found = spark.sql("SELECT t.id, c.* FROM {df} t, LATERAL chunks_of_text(t.text) c WHERE t.id = 4", df=df)
    assert [(r.chunk_index, r.num_chunks, r.chunk_text) for r in found.collect()] == [(0, 1, "one two")] * 2


def test_slices_hold_few_bytes():
    texts = [None, "", *["é" * 40] * 50, "x" * 1000, "y", None]
    found = list(slices(pa.array(texts), 256))
    assert [t for _, part in found for t in part.to_pylist()] == texts
    assert [at for at, _ in found] == np.cumsum([0, *[len(part) for _, part in found]])[:-1].tolist()
    for _, part in found:
        sizes = sorted(len((t or "").encode()) for t in part.to_pylist())
        assert sum(sizes[:-1]) <= 256
    assert list(slices(pa.array([], pa.string()), 256)) == []
    assert [len(part) for _, part in slices(pa.array([None, ""]), 256)] == [2]


def test_worker_holds_few_chunks(spark):
    """Of a large batch, a worker holds the chunks of one text for the statistics, and of one slice of texts for the chunks."""
    text = "Some words here. " * 60
    df = spark.range(3000, numPartitions=1).selectExpr("id", f"CASE WHEN id % 10 > 0 THEN '{text}' || id END AS text")
    plain = chunk.window_splitter(100, 10)

    def counted(most):
        class Pieces(list):
            alive = 0

            def __init__(self, pieces):
                super().__init__(pieces)
                Pieces.alive += 1
                if Pieces.alive > most:
                    raise MemoryError(f"the chunks of more than {most} texts at once")

            def __del__(self):
                Pieces.alive -= 1

        return lambda found: Pieces(plain(found))

    expected = {i: plain(f"{text}{i}") for i in range(3000) if i % 10}
    sizes = [len(p) for pieces in expected.values() for p in pieces]
    stats = chunk.chunk_stats(df, "text", counted(2)).first()
    assert (stats.total_documents, stats.total_chunks, stats["min"], stats["max"]) == (2700, len(sizes), min(sizes), max(sizes))
    table = chunk.chunk_table(df, "text", "id", counted(1500)).collect()
    assert [r.chunk_text for r in sorted(table, key=lambda r: (r.id, r.chunk_index))] == [p for pieces in expected.values() for p in pieces]
