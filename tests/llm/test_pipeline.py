import re

import corpus_pipeline
import duckdb
import pyarrow as pa
from narrata.llm import language
from narrata.llm.sql import MIX_SQL

from . import test_line_dedup, test_near_dup, test_packing

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stages_over(spark, docs):
    """Rows of every stage, each over the rows of the one before."""
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append([tuple(r) for r in docs.collect()])
    return out


def plain_stages(start, accepted):
    """The same by plain means; ``accepted`` are the ids that the language stage keeps."""
    kept = [r for r in start if (r[0], r[1]) in accepted]
    found = {}
    for doc_id, text, removed, _ in test_line_dedup.expected([(r[0], r[1]) for r in kept]):
        found.setdefault(doc_id, []).append((text, removed))
    lines = []
    for r in kept:
        text, removed = next((t, g) for t, g in found[r[0]] if bool(g) == (t != r[1]))
        if not removed:
            lines.append(r)
        elif WORD.search(text):
            lines.append((r[0], text, r[2], r[3], len(text)))
    near = {(row[0], row[3]) for row in test_near_dup.expected([(r[0], r[1]) for r in lines], 5)}
    near = [r for r in lines if (r[0], True) in near]
    table = pa.table({"doc_id": pa.array([r[0] for r in near], pa.int64()), "text": pa.array([r[1] for r in near], pa.string()), "source": pa.array([r[3] for r in near], pa.string())})
    with duckdb.connect() as connection:
        connection.register("documents", table)
        times = {row[0]: row[4] // row[1] for row in connection.execute(MIX_SQL).fetchall() if row[1]}
    mixed = [r for r in near for _ in range(times.get(r[0], 0))]
    return kept, lines, near, mixed


def assert_stages(spark, df):
    start = [tuple(r) for r in df.select(corpus_pipeline.COLUMNS).collect()]
    model = language.fit(df)
    rows = language.predict(df, model, ["doc_id", "text"]).collect()
    accepted = {(r[0], r[1]) for r in rows if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_SCORE}
    found, plain = stages_over(spark, df), plain_stages(start, accepted)
    for got, wanted in zip(found, plain, strict=False):
        assert sorted(got, key=str) == sorted(wanted, key=str)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    packed = spark.createDataFrame(found[4], "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").collect() if found[4] else []
    assert all(r.__fields__ == columns for r in packed)
    test_packing.assert_packed(packed, [(r[0], r[1]) for r in plain[3]])
    return found


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = assert_stages(spark, df)
    assert len(found[0]) > 0.99 * df.count()
    assert len(found[2]) < len(found[1]) <= len(found[0])
    packed = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert packed == sorted(found[4])


def test_odd_rows(spark):
    words = {"en": "the and ing tion of", "de": "der und ung keit für"}
    docs = [(i, f"{w} w{i} " * (6 + i % 3) + f"\nown line {i} of this text", lang, ["a", None, "b"][i % 3], 10) for i, (lang, w) in enumerate(list(words.items()) * 12)]
    docs += [(100, None, "en", "a", 1), (101, "", None, None, 0), (102, "12 34", "de", "c", 5), (None, docs[0][1], "en", "a", 3), (103, docs[2][1], None, None, None)]
    docs += [(104, docs[4][1].replace("own", "owns"), "en", "b", 2), (105, "der und ung keit für " * 3000, "de", "a", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(docs, schema).selectExpr("*", "1 AS score", "'x' AS removed_lines", "2 AS node", "3 AS piece")
    assert_stages(spark, df)
    assert stages_over(spark, df.filter("false")) == [[], [], [], [], []]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_repeated_id_with_two_texts(spark):
    words = [f"w{i}" for i in range(60)]
    copied, near, own = " ".join(words), " ".join(words[:-1]), " ".join(f"own{i}" for i in range(60))
    rows = [(1, copied, "en", "a", 1), (2, near, "en", "a", 1), (2, own, "en", "a", 1), (3, near, "en", "a", 1), (4, None, "en", "a", 1), (None, near, "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, df, SF)
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted((rows[i] for i in (0, 2, 4, 5)), key=str)
