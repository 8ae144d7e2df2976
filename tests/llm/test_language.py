import zlib

import numpy as np
from narrata.llm import language
from narrata.llm.queries import op8_language_id

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op8_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id] is not None]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert len(held) > 1000 and right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    words = {"en": "the and ing tion", "de": "der und ung keit", "fr": "les que oire eau", "xx": "zq zw zqw zz"}
    docs = [(i, (w + " ") * (1 + i % 5), lang, "s") for i, (lang, w) in enumerate(list(words.items()) * 30)]
    odd = [(1000, None, "en", "s"), (1001, "", "de", "s"), (1002, "12 34 !!", None, "s"), (1003, "der und ung", None, None), (None, "the and ing", None, None)]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(docs + odd, schema).selectExpr("*", "1 AS score", "2 AS lang_pred", "3 AS draw")
    rows = {r.doc_id: r for r in language.identify(df).collect()}
    assert [rows[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "de", "en"]
    assert all(rows[d].lang_pred == lang for d, _, lang, _ in docs)
    unlabelled = df.withColumn("lang", language.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    one = language.identify(df.filter("lang = 'en' or lang is null")).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}
    assert language.identify(df.filter("false")).collect() == []


def test_labels_are_no_input(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = language.fit(df)
    plain = {r.doc_id: r.lang_pred for r in language.predict(df, model).collect()}
    changed = df.withColumn("lang", language.F.lit("en")).withColumn("source", language.F.lit("x"))
    assert plain == {r.doc_id: r.lang_pred for r in language.predict(changed, model).collect()}


def test_rare_language_beside_copies(spark):
    """A repeated text counts once, and no language is crowded out."""
    for shift in range(3):
        docs = [(10 * i + shift, "the and ing tion of which was", "en") for i in range(20_000)]
        docs += [(10 * i + shift, f"los que muchos años cosas de la casa {i}", "es") for i in range(60)]
        docs += [(10 * i + shift, f"der und die ung keit nicht {chr(97 + i % 26)}{i}", "de") for i in range(400)]
        df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
        rows = language.drawn(df, 300).collect()
        learned = {lang: [r.text for r in rows if r.lang == lang] for lang in ("en", "es", "de")}
        assert len(learned["en"]) == 1 and 30 <= len(learned["es"]) <= 60 and 60 <= len(learned["de"]) <= 100
        assert len(rows) <= 300 and all(len(set(t)) == len(t) for t in learned.values())
        model = language.fit(df, 300)
        assert model.langs == ["de", "en", "es"]
        assert model.predict(language.features(["los que muchos años", "der und die", "the and which was"]))[0] == ["es", "de", "en"]


def test_many_languages_are_bounded(spark):
    docs = [(i, f"text {i} of", f"l{i % 50}") for i in range(2000)] + [(5000 + i, f"word {i}", "l1") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = language.drawn(df, 40).collect()
    assert len(rows) <= 40 and len({r.lang for r in rows}) == 20 and "l1" in {r.lang for r in rows}


def test_fit_is_the_least_loss():
    """The machines reach the loss that plain gradient descent reaches, and beat every small change."""
    draw = np.random.default_rng(1)
    x = draw.normal(size=(60, 5)).astype(np.float32)
    targets = np.sign(x @ draw.normal(size=(5, 2)) + 0.3 + 0.5 * draw.normal(size=(60, 2))).astype(np.float32)
    w = language.fit_machines(x, targets, 1e-2, 2000)

    def loss(w):
        out = 0.0
        for j in range(2):
            for side in (1, -1):
                rows = targets[:, j] == side
                out += 0.5 * np.mean(np.maximum(0, 1 - side * (x[rows] @ w[:-1, j] + w[-1, j])) ** 2)
        return out + 0.005 * float((w**2).sum())

    plain = np.zeros_like(w, dtype=np.float64)
    for _ in range(20_000):
        step = np.zeros_like(plain)
        for j in range(2):
            for side in (1, -1):
                rows = targets[:, j] == side
                slack = np.maximum(0, 1 - side * (x[rows] @ plain[:-1, j] + plain[-1, j]))
                step[:-1, j] -= side * (x[rows].T @ slack) / rows.sum()
                step[-1, j] -= side * slack.sum() / rows.sum()
        plain -= 0.05 * (step + 1e-2 * plain)
    assert loss(w) <= loss(plain) + 1e-4
    assert all(loss(w) <= loss(w + 0.01 * draw.normal(size=w.shape)) + 1e-5 for _ in range(50))
