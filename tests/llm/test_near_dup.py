import random
import re

import pytest
from narrata.llm import near_dup
from narrata.llm.components import components

SF = "/root/testdata/sf0.01"


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def expected(docs, width, percent=80):
    sets = [shingle_set(t, width) for _, t in docs]
    holders, root = {}, list(range(len(docs)))
    for i, s in enumerate(sets):
        for item in s:
            holders.setdefault(item, []).append(i)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = {}
        for item in s:
            for j in holders[item]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if docs[i][0] is not None and docs[j][0] is not None and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(
        ((d, len(sets[i]), least[find(i)] if d is not None else None, d is None or least[find(i)] == d) for i, (d, _) in enumerate(docs)), key=str
    )


def actual(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("width", [2, 5])
def test_whole_table(spark, width):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert actual(near_dup.near_duplicates(df, width)) == expected(docs, width)


def cloud(seed, copies, words, edits):
    """Copies of one text with up to ``edits`` words replaced."""
    draw = random.Random(seed)
    base = [f"w{seed}x{draw.randrange(10**6)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(draw.randrange(edits + 1)):
            text[draw.randrange(words)] = f"e{draw.randrange(10**6)}"
        yield " ".join(text)


def test_group_of_copies_around_the_threshold(spark):
    texts = list(cloud(1, 150, 100, 24)) + list(cloud(2, 60, 40, 6)) + list(cloud(3, 30, 9, 2))
    common = " ".join(f"c{i}" for i in range(60))
    texts += [common + " " + t for t in cloud(4, 60, 30, 30)]
    texts += [f"hot pair {i} {i * 7} {i * 11}" for i in range(50)]
    random.Random(5).shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for width in (2, 5):
        assert actual(near_dup.near_duplicates(df, width)) == expected(docs, width)


def test_odd_rows(spark):
    texts = [None, "", " \n", "One", "one", "ONE two", "one two", "a b c", "a\tb\nc", "É x y", "é x y", "long " * 30_000, "x y", None]
    docs = list(enumerate(texts)) + [(None, "a b c"), (None, None), (3, "One"), (3, "One")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS node", "3 AS value")
    assert actual(near_dup.near_duplicates(df, 2)) == expected(docs, 2)
    assert near_dup.near_duplicates(df.filter("false")).collect() == []


def test_components_of_chains_and_stars(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 300)] + [(400 + i, 400 + draw.randrange(50)) for i in range(50)]
    draw.shuffle(links)
    root = {x: x for pair in links for x in pair}
    for _ in range(70):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in links)}
