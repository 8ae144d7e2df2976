import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from narrata.operators import sample


def plain_allocation(counts: dict, nulls: int, n: int, least: int) -> dict:
    """The allocation rules, followed step by step."""
    total = sum(counts.values()) + nulls
    given_rows = {k: max(int(c / total * n), least) for k, c in counts.items()}
    rest = n - sum(given_rows.values())
    if rest > 0:
        for k in sorted(given_rows, key=lambda k: (-given_rows[k], k))[:rest]:
            given_rows[k] += 1
    for k in sorted(given_rows, key=lambda k: (given_rows[k], k)):
        if rest < 0:
            back = min(-rest, given_rows[k] - least)
            given_rows[k] -= back
            rest += back
    return {k: (v, min(v, counts[k])) for k, v in given_rows.items()}


def order_of(key, seed=42):
    return hashlib.md5(f"{seed}-{key}".encode()).hexdigest(), key


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(1, 1000), min_size=1, max_size=8), st.sampled_from([0, 30]),
    st.integers(1, 400), st.integers(1, 9),
)
def test_allocation_equals_the_rules(spark, sizes, nulls, n, least):
    counts = {f"s{i}": c for i, c in enumerate(sizes)}
    rows = [*counts.items(), *([(None, nulls)] if nulls else [])]
    df = spark.createDataFrame(rows, "stratum string, available long")
    got = {r.stratum: (r.requested, r.sampled) for r in sample.allocation(df, n, least).collect()}
    assert got == plain_allocation(counts, nulls, n, least)


@pytest.fixture
def table(spark):
    """One stratum holds most rows, one has a single row, some rows have none."""
    kind = F.when(F.col("id") % 50 == 7, F.lit(None)).when(F.col("id") == 3, "rare").when(
        F.col("id") % 10 == 0, "tenth").otherwise("hot")
    return spark.range(5000).select("id", kind.alias("kind"), F.lit("payload").alias("text"))


def test_stratified_sample_equals_brute_force(table):
    groups: dict = {}
    for r in table.collect():
        groups.setdefault(r.kind, []).append(r.id)
    nulls = len(groups.pop(None))
    plan = plain_allocation({k: len(v) for k, v in groups.items()}, nulls, 500, 1)
    expected = {i for k, v in groups.items() for i in sorted(v, key=order_of)[: plan[k][1]]}
    drawn = sample.stratified_sample(table, 500, "kind", "id")
    assert drawn.columns == table.columns
    assert {r.id for r in drawn.collect()} == expected


def test_sample_of_everything_keeps_null_strata(table):
    assert sample.stratified_sample(table, 6000, "kind", "id").count() == 5000
    assert sample.simple_sample(table, 6000, "id").count() == 5000
    for bad in (0, -1):
        with pytest.raises(ValueError):
            sample.stratified_sample(table, bad, "kind", "id")
    with pytest.raises(ValueError):
        sample.stratified_sample(table, 10, "nowhere", "id")


def test_simple_and_prefix_samples(table):
    everyone = [r.id for r in table.collect()]
    simple = sample.simple_sample(table, 40, "id", seed=7)
    assert [r.id for r in simple.collect()] == sorted(everyone, key=lambda i: order_of(i, 7))[:40]
    prefix = sample.prefix_sample(table, 40, "id")
    assert [r.id for r in prefix.collect()] == sorted(sorted(everyone)[:120], key=order_of)[:40]
    one_key = table.filter("id = 9")
    assert [r.id for r in sample.prefix_sample(one_key, 5, "id").collect()] == [9]


def test_shuffle_and_partitioning_do_not_matter(table):
    a = sample.stratified_sample(table, 300, "kind", "id")
    b = sample.stratified_sample(table.repartition(17).orderBy(F.rand()), 300, "kind", "id")
    assert {r.id for r in a.collect()} == {r.id for r in b.collect()}
    shuffled = [r.id for r in sample.shuffled(a, "id").collect()]
    assert shuffled == sorted(shuffled, key=order_of)


def test_report(table):
    drawn = sample.stratified_sample(table, 500, "kind", "id")
    report = {r.stratum: r for r in sample.sampling_report(table, drawn, "kind").collect()}
    assert set(report) == {"hot", "tenth", "rare"} and report["rare"].sample_count == 1
    stats = sample.sampling_stats(table, drawn, "kind", 500).first()
    assert stats.original_size == 5000 and not stats.within_target_range
    assert stats.max_difference == pytest.approx(max(abs(r.difference_pct) for r in report.values()))
    summary = {r.stratum: (r.requested, r.sampled) for r in sample.request_summary(table, 500, "kind").collect()}
    counts = {r.stratum: r.original_count for r in report.values()}
    assert summary == plain_allocation(counts, 5000 - sum(counts.values()), 500, 1)
    assert summary["rare"] == (2, 1)  # raised by the rest, capped by what is there


def test_prefix_under_any_spread(spark, monkeypatch):
    """One far key, clustered keys, repeated and null keys: the cut lies in a cell of few rows."""
    monkeypatch.setattr(sample, "RANKED", 20)
    tables = {
        "far": [*range(2000), 10**15], "near": [10**12 + i for i in range(2000)] + [0, 10**18], "clustered": [i % 7 * 10**9 + i for i in range(2000)],
        "negative": [-(10**14)] + list(range(-500, 1500)),
    }
    for name, keys in tables.items():
        df = spark.createDataFrame([(k,) for k in keys], "id long")
        cell = sample._narrowed(df, 120, "id")
        counts = {r["cell"]: r["count"] for r in df.groupBy(cell.alias("cell")).count().collect()}
        at = next(c for c in sorted(counts) if sum(v for k, v in counts.items() if k <= c) >= 120)
        assert counts[at] <= 20, (name, counts[at])
        assert sorted(r.id for r in sample._first(df, 120, cell, [sample._q("id")]).collect()) == sorted(keys)[:120]
    same = spark.createDataFrame([(5,)] * 300 + [(None,)] * 3 + [(9,)], "id long")
    assert sample._first(same, 10, sample._narrowed(same, 10, "id"), [sample._q("id")]).count() == 10
    assert sample.prefix_sample(same.filter("false"), 5, "id").collect() == []
