"""Search over parts of a table against brute force, and how much of the table it reads."""

import numpy as np
import pytest

from narrata.operators import nearest, pruned
from conftest import physical_plan
from test_nearest import QUESTION_SCHEMA, brute, make
from test_nearest import found as hits


def plain(df):
    return {(r.question_id, r["rank"], r.chunk_id, r.distance) for r in df.collect()}


@pytest.fixture
def by_product(spark, tmp_path):
    chunks, questions, rows, asked = make(spark)
    chunks.write.partitionBy("product").parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t")), questions, rows, asked


@pytest.mark.parametrize("max_sent", [4096, 5])
def test_own_value_only(by_product, max_sent):
    stored, questions, rows, asked = by_product
    found = pruned.nearest_by_value(stored, questions, "product", "wanted", 4, max_sent=max_sent)
    assert hits(found) == brute(rows, [a for a in asked if a[2]], 4, "l2", True)


def test_scan_reads_the_folders_asked_for(spark, by_product):
    stored, questions, _, _ = by_product
    found = pruned.nearest_by_value(stored, questions.filter("wanted = 'p2'"), "product", "wanted", 4)
    found.collect()
    assert "PartitionFilters: [" in physical_plan(found).replace("PartitionFilters: []", "")
    files = {r.f for r in stored.filter("product = 'p2'").selectExpr("input_file_name() f").distinct().collect()}
    assert 0 < len(files) < len(stored.inputFiles())
    assert _files_read(found) == len(files)


def _files_read(df):
    """Files that the scans of vectors have read, from the metrics of the executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    stack, read = [plan], 0
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
        elif "QueryStage" in node.getClass().getSimpleName():
            stack.append(node.plan())
        elif name.startswith("Scan parquet"):
            read += node.metrics().apply("numFiles").value()
        else:
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
    return read


def test_odd_values(spark):
    chunks = spark.createDataFrame([("a", [0.0], "x"), ("b", [1.0], None), ("c", [2.0], ""), ("d", None, "x"), ("e", [float("nan")], "x")], "chunk_id string, embedding array<float>, product string")
    questions = spark.createDataFrame([(1, [0.0], "x"), (2, [0.0], None), (3, [0.0], ""), (4, None, "x"), (5, [0.0], "y")], QUESTION_SCHEMA)
    assert plain(pruned.nearest_by_value(chunks, questions, "product", "wanted")) == {(1, 1, "a", 0.0)}
    assert pruned.nearest_by_value(chunks, questions.limit(0), "product", "wanted").collect() == []


@pytest.mark.parametrize(("hot", "pivots", "max_sent"), [(0.0, 16, 4096), (0.4, 16, 4096), (0.0, 1, 4096), (0.0, 400, 6)])
def test_pivots_are_exact(spark, tmp_path, hot, pivots, max_sent):
    chunks, questions, rows, asked = make(spark, hot=hot)
    pruned.write_pivot_table(chunks, str(tmp_path / "p"), pivots)
    found = pruned.nearest_by_pivots(spark, str(tmp_path / "p"), questions, 5, max_sent=max_sent)
    assert hits(found) == brute(rows, asked, 5, "l2")
    assert hits(found) == hits(nearest.nearest(chunks, questions, 5).select("question_id", "chunk_id", "distance", "rank"))


def test_pivots_skip_far_cells(spark, tmp_path, monkeypatch):
    """Clustered chunks: the second round asks for a few of the cells only."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8)) * 50
    rows = [(f"c{i}", (centres[i % 20] + rng.normal(size=8)).tolist()) for i in range(1000)]
    chunks = spark.createDataFrame(rows, "chunk_id string, embedding array<double>").repartition(4)
    questions = spark.createDataFrame([(i, (centres[i] + rng.normal(size=8)).tolist(), None) for i in range(3)], QUESTION_SCHEMA)
    pruned.write_pivot_table(chunks, str(tmp_path / "p"), 64)
    seen, plain_round = [], pruned._round
    monkeypatch.setattr(pruned, "_round", lambda cells, block, parts, k, schema: seen.append(len(parts)) or plain_round(cells, block, parts, k, schema))
    found = pruned.nearest_by_pivots(spark, str(tmp_path / "p"), questions, 5)
    expected = nearest.nearest(chunks, questions, 5).select("question_id", "chunk_id", "distance", "rank")
    assert hits(found) == hits(expected)
    assert seen[0] <= 3 and sum(seen[1:]) < 32


def test_pivots_of_odd_tables(spark, tmp_path):
    questions = spark.createDataFrame([(1, [0.0, 0.0], None), (2, None, None)], QUESTION_SCHEMA)
    rows = [("a", [1.0, 0.0]), ("b", None), ("c", [float("inf"), 0.0]), ("d", [None, 1.0]), ("e", [1.0, 0.0])]
    chunks = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    pruned.write_pivot_table(chunks, str(tmp_path / "p"), 3)
    assert plain(pruned.nearest_by_pivots(spark, str(tmp_path / "p"), questions, 5)) == {(1, 1, "a", 1.0), (1, 2, "e", 1.0)}
    pruned.write_pivot_table(chunks.limit(0), str(tmp_path / "empty"), 3)
    assert pruned.nearest_by_pivots(spark, str(tmp_path / "empty"), questions, 5).collect() == []
