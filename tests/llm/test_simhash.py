import hashlib
import random
import re
from collections import Counter

import xxhash
from narrata.llm import simhash
from narrata.llm.queries import op2_simhash
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def term_hash(words):
    """Spark's xxhash64 of a row of strings: seeded with 42, then with each hash before."""
    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed


def fingerprint(text, width=5):
    words = WORD.findall(text)
    votes = [0] * 64
    terms = Counter(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))) if words else {}
    for term, weight in terms.items():
        h = term_hash(term)
        for bit in range(64):
            votes[bit] += weight if h >> bit & 1 else -weight
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


def expected(docs):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    prints = {t or "": fingerprint(t or "") for _, t in docs}
    out = []
    for i, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = prints[text], fingerprint(edited), prints[after]
        likeness = [1 - bin(a ^ x).count("1") / 64 for x in (b, c)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", *likeness))
    return sorted(out, key=str)


def actual(df):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = op2_simhash(spark, SF).cache()
    assert actual(found) == expected(docs)
    rows = {r.doc_id: r for r in found.collect()}
    prints = sorted({int(r.fingerprint, 16) for r in rows.values()})
    near = {p: sum(0 < bin(p ^ q).count("1") <= 3 for q in prints) for p in prints}
    assert all(r.n_near == near[int(r.fingerprint, 16)] for r in rows.values())
    assert all(rows[r.class_id].fingerprint == r.fingerprint and r.class_id <= r.doc_id for r in rows.values())


def test_neighbours_over_ranges(spark):
    draw = random.Random(4)
    docs = [(i * i - 50, " ".join(f"w{draw.randrange(50)}" for _ in range(draw.randrange(40)))) for i in range(60)]
    df = spark.createDataFrame(draw.sample(docs, 60), "doc_id long, text string").repartition(3)
    for rows in (1, 7, 1000):
        assert actual(simhash.edited_fingerprints(df, rows=rows)) == expected(docs)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n "), (4, "é"), (5, "one two"), (6, "x " * 20_000), (7, "ab\U0001f600c"), (None, "null id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS range", "2 AS guest", "'x' AS words")
    for rows in (2, 1000):
        assert actual(simhash.edited_fingerprints(df, rows=rows)) == expected(docs)
    assert simhash.with_near_counts(simhash.edited_fingerprints(df.filter("false"))).collect() == []
    assert actual(simhash.edited_fingerprints(df.filter("doc_id = 7"))) == expected([docs[6]])
    twice = simhash.edited_fingerprints(df.filter("doc_id = 5").unionAll(df.filter("doc_id = 5")))
    assert [r.near_next for r in twice.collect()] == [1.0, 1.0]


def test_all_pairs_within_radius(spark):
    draw = random.Random(9)
    values = [draw.getrandbits(64) for _ in range(60)]
    for base in values[:40]:
        for flips in (1, 2, 3, 4, 5):
            near = base
            for bit in draw.sample(range(64), flips):
                near ^= 1 << bit
            values.append(near)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed + signed[:9]], "fingerprint long")
    for radius, long_list in ((0, 256), (1, 1), (3, 256), (3, 1), (4, 3)):
        found = simhash.near_fingerprints(df, radius, long_list=long_list).collect()
        pairs = {(r.a, r.b): r.distance for r in found}
        assert len(pairs) == len(found)
        assert pairs == {
            (a, b): d for a in set(signed) for b in set(signed) if a < b and (d := bin((a ^ b) & (1 << 64) - 1).count("1")) <= radius
        }


def test_large_group_of_near_copies(spark):
    """One base with flips in any place: keys of more than LONG_LIST rows beside keys of few."""
    draw = random.Random(12)
    base, other = draw.getrandbits(64), draw.getrandbits(64)
    values = {base, other}
    while len(values) < 1500:
        near = base if len(values) % 3 else other
        for bit in draw.sample(range(64), draw.choice((1, 2, 2, 3))):
            near ^= 1 << bit
        values.add(near)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = simhash.near_fingerprints(df).collect()
    expected = {
        (a, b): d for i, a in enumerate(signed) for b in signed[i + 1:] if (d := ((a ^ b) & (1 << 64) - 1).bit_count()) <= 3
    }
    assert len(found) == len(expected) > 20_000
    assert {(r.a, r.b): r.distance for r in found} == expected
    assert simhash.near_fingerprints(df.filter("false")).collect() == []


def test_native_plan(spark):
    plan = op2_simhash(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|Cartesian|NestedLoop", plan)
    assert spark.range(1).select(simhash.as_text(F.lit(-1))).first()[0] == "f" * 16
