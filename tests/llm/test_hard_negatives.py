import math
import random

import pytest
from narrata.llm import hard_negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, label int, embedding array<float>"


def expected(rows, is_anchor, positives=5, negatives=10):
    """(anchor, positive, rank, negative, scores) from the definition."""
    valid = []
    for vec_id, label, vector in rows:
        if vec_id is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            valid.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    out = []
    for anchor, label, a in valid:
        if not is_anchor(anchor):
            continue
        scored = [(-sum(x * y for x, y in zip(a, v, strict=False)), i, k) for i, k, v in valid if i != anchor]
        same, others = sorted(s for s in scored if s[2] == label), sorted(s for s in scored if s[2] != label)
        for p, positive, _ in same[:positives]:
            inside = [(s, i) for s, i, _ in others if 30 * -p <= 100 * -s <= 90 * -p]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    out = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0, **options)
    assert dict(out.dtypes) == {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint",
    }
    return sorted(tuple(r) for r in out.collect())


def anchor(vec_id):
    return vec_id % 5 == 0


def some_rows(seed, number, width, labels, digits):
    """Coarse components, so that many scores tie."""
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    rows = []
    for i in range(number):
        label = draw.randrange(labels)
        rows.append((i, label, [round(c * draw.choice([0, 0.5, 1]) + draw.gauss(0, 0.5), digits) for c in centres[label]]))
    return rows


@pytest.mark.parametrize(("seed", "width", "labels", "digits"), [(1, 64, 4, 3), (2, 20, 2, 1), (3, 3, 3, 0), (4, 9, 30, 1)])
def test_brute_force(spark, seed, width, labels, digits):
    rows = some_rows(seed, 400, width, labels, digits)
    found = mined(spark, rows)
    assert found and found == expected(rows, anchor)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    rows = some_rows(5, 300, 12, 3, 1)
    assert mined(spark, rows, anchors_at_once=7) == expected(rows, anchor)


def test_one_common_vector(spark):
    rows = [(i, i % 3, [0.5, 0.25, 1.0]) for i in range(200)] + [(i, i % 3, [0.5, 0.25, 0.5]) for i in range(200, 260)]
    found = mined(spark, rows)
    assert found == expected(rows, anchor)


def test_odd_rows(spark):
    rows = some_rows(6, 120, 6, 2, 1)
    rows += [
        (None, 1, [1.0] * 6), (500, None, [1.0] * 6), (505, 1, None), (510, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (515, 0, [math.nan] * 6),
        (520, 0, [math.inf] + [0.0] * 5), (525, 0, []), (530, 1, [2.0]), (535, 0, [1.0] * 9), (540, 1, [0.0] * 6), (-5, 0, [1.0] * 6), (541, 9, [1.0] * 6),
    ]
    assert mined(spark, rows) == expected(rows, anchor)


def test_repeated_rows(spark):
    rows = some_rows(7, 60, 4, 2, 0)
    rows += rows[:20]
    assert mined(spark, rows) == expected(rows, anchor)


def test_large_components(spark):
    rows = [(i, i % 2, [1.0e5 * ((i * 7) % 11 - 3), 1.0e4 * (i % 5)]) for i in range(40)]
    rows += [(100 + i, i % 2, [2.0e5 * (i + 1), 3.0]) for i in range(6)]
    assert mined(spark, rows) == expected(rows, anchor)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == []
    assert mined(spark, [(5, 1, [1.0])]) == []


def test_bound_drops_rows_early():
    """The scan reads later dimensions of few rows only."""
    import numpy as np
    import pyarrow as pa

    rows = [(i, label, [float(x) for x in v]) for i, label, v in some_rows(8, 3000, 64, 2, 3)]
    table = pa.table({"id": [r[0] for r in rows], "label": [r[1] for r in rows], "vector": pa.array([r[2] for r in rows], pa.list_(pa.float32()))})
    anchors = hard_negatives.Anchors(table.slice(0, 1), 256)
    block = hard_negatives.Block(table.to_batches()[0], anchors)
    left = []
    scores = block.columns.T @ anchors.values[0]
    best = np.sort(scores)[-5]
    kept, _ = block.scan(anchors, 0, np.arange(3000), lambda p, low, high: left.append(len(p)) or p + high >= best)
    assert len(kept) == 5 and left[0] == 3000 and left[-1] < 1500
