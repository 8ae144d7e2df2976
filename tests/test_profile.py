import numpy as np
import pytest

from conftest import physical_plan
from narrata.operators import profile

TEXTS = ["one", "one two", "one two three", None, "", " ", "w " * 30, "w " * 30, "w " * 7]


@pytest.fixture
def table(spark):
    rows = [(i, t, "ab"[i % 2] if i else None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id int, text string, kind string")


def test_length_statistics_equal_numpy(table):
    counts = np.array([len(t.split()) for t in TEXTS if t])
    got = profile.length_stats(table, "text").first().asDict()
    assert got["mean"] == pytest.approx(counts.mean())
    assert got["std"] == pytest.approx(counts.std(ddof=1))
    assert (got["min"], got["max"]) == (counts.min(), counts.max())
    for name, p in {"median": 50, "q25": 25, "q75": 75, "q90": 90, "q95": 95, "q99": 99}.items():
        assert got[name] == pytest.approx(np.percentile(counts, p))
    short = profile.short_long_counts(table, "text").first()
    assert (short.very_short_count, short.very_long_count) == (5, int((counts > np.percentile(counts, 95)).sum()))


def test_empty_and_single(table, spark):
    assert set(profile.length_stats(table.filter("id < 0"), "text").first()) == {None}
    assert profile.length_stats(table.filter("id = 0"), "text").first()["std"] is None
    none = profile.short_long_counts(table.filter("id < 0"), "text").first()
    assert (none.very_short_count, none.very_long_count) == (0, 0)


def test_histogram_equals_numpy(table):
    counts = [len(t.split()) for t in TEXTS if t is not None]
    rows = profile.length_histogram(table, "text", 10).orderBy("bin").collect()
    expected, edges = np.histogram(counts, bins=10)
    assert [r.n for r in rows] == expected.tolist()
    assert [r.from_value for r in rows] == pytest.approx(edges[:-1].tolist())
    one = profile.length_histogram(table.filter("id = 1"), "text", 4).collect()
    assert sum(r.n for r in one) == 1 and len(one) == 4


def test_distribution(table):
    rows = {r.category: (r.n, r.percent) for r in profile.category_distribution(table, "kind").collect()}
    assert rows == {"a": (4, 50.0), "b": (4, 50.0)}
    head = profile.distribution_headline(table, "kind").first()
    assert (head.total_values, head.most_common, head.least_common, head.median_count) == (2, "a", "b", 4.0)
    assert [r.category for r in profile.category_bars(table, "kind").collect()] == ["a", "b"]


def test_boxplot(spark):
    words = [1, 2, 3, 4, 100]
    df = spark.createDataFrame([("k", "w " * n) for n in words], "kind string, text string")
    box = profile.length_boxplot(df, "text", "kind").first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.outliers) == (2, 3, 4, 1, 4, 1)


def test_presence_and_bundle(table):
    got = profile.presence(table, "text").first()
    assert (got.total, got.with_count, got.with_percent, got.without_percent) == (9, 7, 77.78, 22.22)
    assert tuple(profile.missing_blank(table, "text").first()) == (1, 2)
    parts = profile.profile(table, "kind", "nowhere")
    assert parts["length_stats"] is None and parts["category_distribution"].count() == 2
    whole = profile.profile(table, "kind", "text")
    for name in ("length_counts", "length_stats", "short_long_counts", "presence"):
        assert whole[name].collect() == getattr(profile, name)(table, "text").collect()
        assert "LocalTableScan" in physical_plan(whole[name])


def test_share_comparison(table, spark):
    other = spark.createDataFrame([("a",), ("c",)], "kind string")
    rows = {r.category: (r.original_n, r.sample_n, r.sample_percent) for r in
            profile.share_comparison(table, other, "kind").collect()}
    assert rows == {"a": (4, 1, 50.0), "b": (4, 0, 0.0), "c": (0, 1, 50.0)}
