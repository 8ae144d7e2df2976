import random
import re

from narrata.llm import line_dedup
from narrata.llm.queries import op9_line_dedup

SF = "/root/testdata/sf0.01"


def n_words(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def longest_rising(pairs):
    """Indices of a longest run rising on both sides, by the square way; the same choice as piles make is not needed
    where it is the only longest one."""
    return line_dedup.patience([(a, b) for a, b, _ in pairs])


def blocks_of(lines, follows, min_words):
    """Runs of lines that follow each other, with enough words."""
    out, block = [], []
    for line in [*lines, None]:
        if block and (line is None or not follows(block[-1], line)):
            out += block if sum(x[2] for x in block) >= min_words else []
            block = []
        block.append(line)
    return [x[0] for x in out]


def expected(docs, min_words=5):
    """Kept text, removed lines and partners, from the module's description: every pair that meets, one by one."""
    held, worded = {}, {}
    for doc_id, text in sorted({d for d in docs if d[0] is not None and d[1] is not None}):
        seen, lines = {}, []
        for at, line in enumerate(text.split("\n")):
            if n_words(line):
                key = line.strip(" \t\n\v\f\r")
                seen[key] = seen.get(key, -1) + 1
                lines.append((at, (key, seen[key]), n_words(line)))
        worded[doc_id, text] = lines
        for place, (_, key, _) in enumerate(lines):
            held.setdefault(key, []).append((doc_id, text, place))
    tags = {}
    out = []
    for doc_id, text in docs:
        if doc_id is None or text is None:
            out.append((doc_id, text, [], []))
            continue
        met = {}
        for place, (_, key, words) in enumerate(worded[doc_id, text]):
            holders = held[key]
            first = min(holders, key=lambda h: (h[0], tags.setdefault(h[1], tag_of(h[1]))))
            for other in [first] if len(holders) > line_dedup.RARE else holders:
                if other[0] < doc_id:
                    met.setdefault(other[:2], []).append((place, other[2], words))
        gone, partners = set(), set()
        for (partner, _), pairs in met.items():
            run = longest_rising(pairs)
            aligned = [pairs[i] for i in run]
            moved = sorted((p for i, p in enumerate(pairs) if i not in set(run)), key=lambda p: (p[1] - p[0], p[0]))
            removed = blocks_of(aligned, lambda a, b: b[0] == a[0] + 1, min_words)
            removed += blocks_of(moved, lambda a, b: b[0] == a[0] + 1 and b[1] == a[1] + 1, min_words)
            gone |= set(removed)
            partners |= {partner} if removed else set()
        lines = text.split("\n")
        at = [worded[doc_id, text][place][0] for place in sorted(gone)]
        dropped = set(at)
        for place in gone:
            if place + 1 in gone:
                dropped |= set(range(worded[doc_id, text][place][0], worded[doc_id, text][place + 1][0]))
        kept = "\n".join(line for i, line in enumerate(lines) if i not in dropped)
        out.append((doc_id, text if not gone else kept if n_words(kept) else "", at, sorted(partners)))
    return sorted(out, key=str)


def tag_of(text):
    """A stand-in for the order of texts under one id; tests do not depend on it."""
    return text


def actual(df):
    return sorted(((r.doc_id, r.text, r.removed_lines, r.removed_partners) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = actual(op9_line_dedup(spark, SF))
    assert found == expected(docs)
    assert sum(len(r[2]) for r in found) > 100


def test_blocks_copies_and_moved_parts(spark):
    draw = random.Random(2)
    pool = [" ".join(f"w{draw.randrange(10**4)}" for _ in range(draw.choice([1, 2, 4, 6, 60]))) for _ in range(40)]
    docs = [(i, "\n".join(draw.choices(pool + [f"own{i} {j} a b c d" for j in range(9)] + ["", "  "], k=draw.randrange(14)))) for i in range(80)]
    docs += [(100 + i, docs[3][1]) for i in range(5)] + [(200 + i, "a very common line of words\n" + f"own text {i} is here now") for i in range(60)]
    draw.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert actual(line_dedup.deduplicated(df)) == expected(docs)


def test_odd_rows(spark):
    docs = [
        (1, "one two three four five\r\nx"), (2, "  one two three four five \ny"), (3, None), (4, ""), (5, "\n\n"), (None, "one two three four five"),
        (6, "one two three four five\none two three four five"), (7, "one two three four five\none two three four five"),
        (8, "short\none"), (9, "short\none"), (10, "z " * 50_000), (11, "z " * 50_000), (11, "z " * 50_000),
    ]
    schema = "doc_id long, text string"
    df = spark.createDataFrame(docs, schema).selectExpr("*", "1 AS tag", "2 AS at", "3 AS removed", "4 AS holder")
    out = line_dedup.deduplicated(df)
    assert out.columns[:6] == df.columns
    assert actual(out) == expected(docs)
    assert line_dedup.deduplicated(df.filter("false")).collect() == []


def test_patience_is_longest():
    draw = random.Random(1)
    for _ in range(200):
        pairs = [(i, x) for i, x in enumerate(draw.sample(range(20), 8))]
        best = [1] * 8
        for i in range(8):
            best[i] = 1 + max((best[j] for j in range(i) if pairs[j][1] < pairs[i][1]), default=0)
        run = [pairs[i] for i in line_dedup.patience(pairs)]
        assert len(run) == max(best) and run == sorted(run) and [b for _, b in run] == sorted(b for _, b in run)


def test_blocks_of_one_pair():
    moved = [(0, 5, 3), (1, 6, 3), (2, 0, 9), (3, 1, 9), (4, 2, 9), (6, 9, 1)]
    assert sorted(line_dedup.common_blocks(moved, 5)) == [0, 1, 2, 3, 4]
    assert sorted(line_dedup.common_blocks(moved, 7)) == [2, 3, 4]


def test_short_lines_of_unrelated_documents_stay(spark):
    docs = [(i, f"short line {i}\n" + " ".join(f"w{i}x{j}" for j in range(20))) for i in range(1, 6)]
    docs.append((9, "\n".join(f"short line {i}" for i in range(1, 6))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = actual(line_dedup.deduplicated(df))
    assert found == expected(docs) and (9, docs[-1][1], [], []) in found


def test_double_spaced_copy_becomes_empty(spark):
    text = "\n\n".join(f"three word{i} line" for i in range(40))
    docs = [(1, text), (2, text), (3, "\n" + text + "\n\n"), (4, "own words of this one\n\n" + text + "\nthe end of it all")]
    found = actual(line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")))
    assert found == expected(docs)
    assert [r[1] for r in found] == [text, "", "", "own words of this one\n\nthe end of it all"]


def test_later_documents_meet_each_other(spark):
    """Two later documents share a passage whose lines have other first holders."""
    passage = [f"line {i} here" for i in range(6)]
    docs = [(i + 1, f"{line}\nother words of document {i}") for i, line in enumerate(passage)]
    docs += [(10, "\n".join(["start of ten", *passage])), (11, "\n".join([*passage, "end of eleven"]))]
    found = dict((r[0], r) for r in actual(line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert found[10][1] == docs[-2][1] and found[11][1:] == ("end of eleven", [0, 1, 2, 3, 4, 5], [10])


def test_reversed_lines_cost_no_square():
    import time

    n = 100_000
    start = time.perf_counter()
    assert len(line_dedup.common_blocks([(i, n - i, 5) for i in range(n)], 5)) == n
    assert line_dedup.common_blocks([(i, n - i, 3) for i in range(n)], 5) == []
    assert time.perf_counter() - start < 5


def test_clashing_columns_and_other_ids(spark):
    docs = [(1, "one two three four five\nx"), (2, "one two three four five\ny")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 AS removed_lines", "8 AS removed_partners", "9 AS places")
    out = line_dedup.deduplicated(df)
    assert out.columns == ["doc_id", "text", "places", "removed_lines", "removed_partners"] and actual(out) == expected(docs)
    for kind in ("decimal(20,0)", "double", "string", "int"):
        rows = line_dedup.deduplicated(df.withColumn("doc_id", line_dedup.F.col("doc_id").cast(kind))).orderBy("doc_id").collect()
        assert [r.text for r in rows] == [docs[0][1], "y"] and rows[1].removed_partners == [rows[0].doc_id]
