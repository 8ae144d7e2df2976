"""Search against brute force: ties, equal vectors, filters, both metrics, both ways to distribute."""

import numpy as np
import pytest

from narrata.operators import nearest

CHUNK_SCHEMA = "chunk_id string, embedding array<float>, product string, chunk_text string"
QUESTION_SCHEMA = "question_id long, question_embedding array<float>, wanted string"


def make(spark, seed=1, chunks=300, questions=23, dim=8, hot=0.0):
    """``hot`` is the share of chunks that have one and the same vector."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(chunks, dim)).astype(np.float32)
    vectors[: int(chunks * hot)] = vectors[0]
    asked = rng.normal(size=(questions, dim)).astype(np.float32)
    asked[0] = vectors[0]
    rows = [(f"c{i}", vectors[i].tolist(), f"p{i % 3}", f"text {i}") for i in range(chunks)]
    wanted = [None if i % 2 else f"p{i % 4}" for i in range(questions)]
    return (
        spark.createDataFrame(rows, CHUNK_SCHEMA).repartition(7),
        spark.createDataFrame([(i, asked[i].tolist(), wanted[i]) for i in range(questions)], QUESTION_SCHEMA),
        rows,
        [(i, asked[i], wanted[i]) for i in range(questions)],
    )


def brute(rows, asked, k, metric, own_filter=False):
    out = set()
    for number, vector, wanted in asked:
        v, scored = vector.astype(float), []
        for name, embedding, product, _ in rows:
            e = np.asarray(embedding, dtype=float)
            if own_filter and wanted is not None and product != wanted:
                continue
            d = ((v - e) ** 2).sum() if metric == "l2" else 1 - v @ e / np.linalg.norm(v) / np.linalg.norm(e)
            scored.append((round(float(d), 9), name))
        for rank, (d, name) in enumerate(sorted(scored)[:k], 1):
            out.add(Hit(number, rank, name, d))
    return out


class Hit(tuple):
    """Equal when question, rank and chunk are, and the distances agree to 1e-6."""

    def __new__(cls, question, rank, chunk, distance):
        hit = super().__new__(cls, (question, rank, chunk))
        hit.distance = distance
        return hit

    def __eq__(self, other):
        return tuple(self) == tuple(other) and abs(self.distance - other.distance) < 1e-6

    __hash__ = tuple.__hash__


def found(df):
    return {Hit(r.question_id, r["rank"], r.chunk_id, r.distance) for r in df.collect()}


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("blocks", [False, True])
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_equals_brute_force(spark, metric, blocks, hot):
    chunks, questions, rows, asked = make(spark, hot=hot)
    sizes = {"max_sent": 5, "chunks_per_block": 40} if blocks else {}
    assert found(nearest.nearest(chunks, questions, 5, metric, **sizes)) == brute(rows, asked, 5, metric)
    filtered = nearest.nearest(
        chunks, questions, 5, metric, filter_col="product", question_filter="wanted", **sizes
    )
    assert found(filtered) == brute(rows, asked, 5, metric, own_filter=True)


def test_small_steps_give_the_same(spark, monkeypatch):
    chunks, questions, rows, asked = make(spark, hot=0.5)
    monkeypatch.setattr(nearest, "CELLS_PER_STEP", 60)
    monkeypatch.setattr(nearest, "PAIRS_PER_STEP", 7)
    assert found(nearest.nearest(chunks, questions, 4)) == brute(rows, asked, 4, "l2")


def test_fewer_chunks_than_k(spark):
    chunks, questions, rows, asked = make(spark, chunks=3)
    assert found(nearest.nearest(chunks, questions, 10)) == brute(rows, asked, 10, "l2")
    assert nearest.nearest(chunks.filter("false"), questions, 10).count() == 0
    assert nearest.nearest(chunks, questions.filter("false"), 10).count() == 0


def test_payload_and_null_vectors(spark):
    chunks, questions, rows, asked = make(spark)
    extra = spark.createDataFrame([("z", None, "p0", "no vector")], CHUNK_SCHEMA)
    hits = nearest.nearest(chunks.unionByName(extra), questions, 3, payload=["chunk_text", "product"])
    assert hits.columns == ["question_id", "rank", "chunk_id", "distance", "chunk_text", "product"]
    assert found(hits) == brute(rows, asked, 3, "l2")
    assert all(r.chunk_text == "text " + r.chunk_id[1:] for r in hits.collect())


def test_one_vector_with_filters(spark):
    chunks, _, rows, asked = make(spark)
    vector = asked[1][1]
    for where, text in (({"product": "p1"}, None), ({}, "7"), ({"product": "p2"}, "1")):
        kept = [r for r in rows if all(r[2] == v for v in where.values()) and (text or "") in r[3]]
        got = nearest.nearest_to_vector(chunks, vector.tolist(), 4, where, text)
        expected = brute(kept, [(1, vector, None)], 4, "l2")
        assert {Hit(1, r["rank"], r.chunk_id, r.distance) for r in got.collect()} == expected


def test_arguments(spark):
    chunks, questions, _, _ = make(spark, chunks=3)
    for bad in ({"k": 0}, {"metric": "dot"}, {"filter_col": "product"}, {"id_col": "nowhere"}):
        with pytest.raises(ValueError):
            nearest.nearest(chunks, questions, **bad)


def test_odd_vectors(spark):
    rows = [("ok", [1.0, 2.0]), ("null", [1.0, None]), ("nan", [float("nan"), 1.0]), ("inf", [float("inf"), 0.0]), ("zero", [0.0, 0.0]), ("none", None)]
    chunks = spark.createDataFrame([(i, v, "p", "t") for i, v in rows], CHUNK_SCHEMA).coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 2.0], None)], QUESTION_SCHEMA)
    got = {r.chunk_id: r.distance for r in nearest.nearest(chunks, asked, 9).collect()}
    assert got == {"ok": 0.0, "zero": 5.0}
    got = {r.chunk_id: r.distance for r in nearest.nearest(chunks, asked, 9, "cosine").collect()}
    assert got["zero"] == 1.0 and abs(got["ok"]) < 1e-9 and len(got) == 2
    zero = spark.createDataFrame([(1, [0.0, 0.0], None)], QUESTION_SCHEMA)
    assert {r.distance for r in nearest.nearest(chunks, zero, 9, "cosine").collect()} == {1.0}
    wide = chunks.unionByName(spark.createDataFrame([("wide", [1.0, 2.0, 3.0], "p", "t")], CHUNK_SCHEMA))
    with pytest.raises(Exception, match="wide"):
        nearest.nearest(wide, asked, 2).collect()
    bad = spark.createDataFrame([(7, [1.0, None], None)], QUESTION_SCHEMA)
    with pytest.raises(Exception, match="null or infinite"):
        nearest.nearest(chunks, bad, 2).collect()


def test_other_key_types(spark):
    chunks = spark.sql("SELECT DATE'2024-01-02' AS chunk_id, array(1.0F) AS embedding")
    asked = spark.sql("SELECT CAST(1 AS SMALLINT) AS question_id, array(1.0F) AS question_embedding")
    assert str(nearest.nearest(chunks, asked, 1).first().chunk_id) == "2024-01-02"
