import math
import random
import re
from collections import Counter

import pytest
from narrata.llm import lexical_search

SEPARATORS = "[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")
    return [t for t in re.split(SEPARATORS, lowered) if t]


def expected(docs, items, top=20):
    """(item_id, rank, doc_id, score) from the definition."""
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = [(doc_id, tf) for doc_id, tf in held if tf]
    n_docs, n_terms = len(held), sum(sum(tf.values()) for _, tf in held)
    df = Counter(t for _, tf in held for t in tf)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, Counter()).update(terms(text))
    out = []
    for item_id, times in asked.items():
        scored = []
        for doc_id, tf in held:
            m = 75 + 25 * sum(tf.values()) * n_docs // n_terms
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t, n in times.items() if t in tf
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = lexical_search.search(docs, items, **options)
    assert rows.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, rows.collect()), key=str)


WORDS = ["a", "Ab", "ab", "abc", "c9", "9", "ñandú", "ÑANDÚ", "İ", "𝒳y", "é", "zeta", "THE", "the", "x\x00y"]


def some_text(draw):
    words = [draw.choice(WORDS) for _ in range(draw.randint(0, 30))]
    return "".join(w + draw.choice([" ", "\n", "-", "_", ". ", "\x00", "\x7f", "[", "\r\n"]) for w in words)


@pytest.mark.parametrize("postings", [400_000, 8])
def test_brute_force(spark, postings):
    draw = random.Random(3)
    docs = [(i, some_text(draw)) for i in range(150)]
    docs += [(1000, None), (1001, ""), (1002, " .-"), (None, "zeta abc"), (7, "zeta zeta"), (7, "zeta zeta"), (1003, "ab " * 60_000)]
    items = [(i, some_text(draw)) for i in range(12)]
    items += [(50, None), (51, ""), (52, "absent terms"), (None, "zeta the"), (3, "abc zeta"), (53, "the the the"), (54, "ab " * 3000)]
    assert found(spark, docs, items, postings=postings) == expected(docs, items)


def test_terms_stand_alone(spark):
    docs = [(1, "xabc abcx x-abc-x"), (2, "ABC"), (3, "ab c"), (4, "abcé"), (5, "abc_abc")]
    rows = found(spark, docs, [(1, "abc")])
    assert {r[2] for r in rows} == {1, 2, 5}
    assert rows == expected(docs, [(1, "abc")])


def test_ties_and_top(spark):
    docs = [(i, "word other") for i in range(40, 0, -1)] + [(99, "another text")] * 60
    rows = found(spark, docs, [(1, "word")], top=5)
    assert [r[2] for r in rows] == [1, 2, 3, 4, 5]
    assert rows == expected(docs, [(1, "word")], 5)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, "..."), (2, None)], [(1, "a")]) == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "one two", "x", 5, 6), (2, "two", "y", 7, 8)], "doc_id long, text string, term string, score int, rank int")
    items = spark.createDataFrame([(1, "two", 3, "z")], "item_id long, text string, times int, doc_id string")
    assert sorted(r.doc_id for r in lexical_search.search(docs, items).collect()) == [1, 2]
    docs = docs.unionByName(spark.createDataFrame([(3, "three", "x", 5, 6)], docs.schema))
    assert [r.doc_id for r in lexical_search.search(docs, items).orderBy("rank").collect()] == [2, 1]
