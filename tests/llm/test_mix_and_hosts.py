import random

import duckdb
import pyarrow as pa
import pytest
from narrata.llm import fair_mix, host_rules
from narrata.llm.sql import HOST_RULES_SQL, MIX_SQL

SCHEMA = "doc_id long, text string, source string"


def by_sql(docs, sql):
    table = pa.table({
        "doc_id": pa.array([d[0] for d in docs], pa.int64()), "text": pa.array([d[1] for d in docs], pa.string()),
        "source": pa.array([d[2] for d in docs], pa.string()),
    })
    with duckdb.connect() as connection:
        connection.register("documents", table)
        result = connection.execute(sql)
        return [d[0] for d in result.description], sorted(result.fetchall(), key=str)


def same(df, docs, sql):
    names, rows = by_sql(docs, sql)
    found = sorted((tuple(r) for r in df.select(names).collect()), key=str)
    assert found == rows


def documents(seed, count, hot=0.0):
    draw = random.Random(seed)
    out = []
    for i in range(count):
        text = " ".join("w" * draw.randrange(1, 9) for _ in range(draw.randrange(1, 60)))
        source = "s1" if draw.random() < hot else draw.choice(["s0", "s1", "é", None, "s10"])
        out.append((i, text, source))
    return out


ODD = [(900, None, "s0"), (901, "", None), (902, " \n\t ", "empty"), (903, "word " * 20_000, "long"), (904, "a b c", "s0"), (None, "no id at all", "s1")]


@pytest.mark.parametrize("hot", [0.0, 0.7])
def test_mix_equals_sql(spark, hot):
    docs = documents(1, 300, hot) + ODD
    df = spark.createDataFrame(docs, SCHEMA).repartition(5).selectExpr("*", "1 AS size", "2 AS target", "3 AS part", "'x' AS src")
    same(fair_mix.mix(df), docs, MIX_SQL)


def test_mix_keeps_its_limits(spark):
    docs = documents(2, 800, 0.5)
    rows = fair_mix.mix(spark.createDataFrame(docs, SCHEMA)).collect()
    taken, target = {}, {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.target] = taken.get(r.target, 0) + r.taken
        target[r.target] = r.target
    assert all(abs(taken[t] - t) <= 2 * 60 for t in target)
    assert sum(taken.values()) <= 1.5 * sum(r.size for r in rows)


def test_mix_of_few_and_no_rows(spark):
    for docs in ([], [(1, None, None)], [(1, "a b", "x")], [(1, "a b", "x"), (1, "a b", "x"), (2, "c", None)]):
        df = spark.createDataFrame(docs, SCHEMA)
        rows = fair_mix.mix(df).collect()
        assert len(rows) == len(docs) and all(0 <= r.taken <= 2 * r.size for r in rows)
        out = fair_mix.mixed_documents(df)
        assert out.columns == df.columns and out.count() <= 2 * len(docs)


def test_host_rules_equal_sql(spark):
    draw = random.Random(3)
    docs = documents(4, 120, 0.5) + ODD
    docs += [(500 + i, " ".join(draw.choices(["re", "peat"], k=40)), "bad.host") for i in range(60)]
    docs += [(600 + i, "### $$$ " * 9 + f"x{i}\ny\ny\ny\ny", "symbols") for i in range(9)]
    docs += [(700, "a b c d e a b c d e f", "s0"), (701, "a a a a a a", "s0"), (702, "one\n\none\n one", "s0")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4).selectExpr("*", "1 AS host", "2 AS n_words", "3 AS kept")
    found = host_rules.judge(df)
    same(found, docs, HOST_RULES_SQL)
    assert {r.host_rejected for r in found.filter("doc_id >= 500 AND doc_id < 560").collect()} == {True}
    assert host_rules.judge(df.filter("false")).collect() == []


def test_one_host_and_repeated_rows(spark):
    docs = [(1, "x " * 30, "h"), (1, "x " * 30, "h"), (2, " ".join(f"w{i}" for i in range(30)), "h")]
    rows = sorted(host_rules.judge(spark.createDataFrame(docs, SCHEMA)).collect(), key=lambda r: r.doc_id)
    assert rows[0] == rows[1] and [r.host_docs for r in rows] == [3, 3, 3]
    assert [(r.n_words, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows] == [(30, 0, 30, True)] * 2 + [(30, 0, 0, False)]
