"""Text expressions against plain Python on whole strings, Unicode cases included."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import values
from narrata.functions import text as tx
from narrata.functions.dates import parse_date

SAMPLES = [
    None, "", "  ", "\t\n", "nan", "None", "NaN", " nan ", " padded text ", "123456789",
    "1234567890", "a\x0bb\x1cc d　e", "See http://ex.org/a?b=1&c=%20x) end", "HTTP://UP.ORG http://",
    "https://x.y/~tail été", "mail a.b+c@ex-am.org, now", "é.x@y.zz and @nobody and a@b", "x@y.c|om",
    "call (555) 123-4567 or +1-555-123-4567 or 5551234567", "٠١٢-٣٤٥-٦٧٨٩",
    "I AM WRITING TO FILE A COMPLAINT. Please NOTE fyi: notify", "pleaſe note, KINDLY note", "fyfyii",
    "for your information: THIS IS A COMPLAINT", "please be advised that i want to file a complaint",
    "it's \"fine\", isn't it? yes! no; a-b: c.", "Ünïcode ÀÉ straße 漢字", "one two  three\nfour\tfive ",
]
PHONE = r"(\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"


def phrases_cut(text):
    for phrase in tx.BOILERPLATE:
        text = re.sub(phrase, "", text, flags=re.I)
    return text


def narrative(text):
    if text in ("nan", "None", ""):
        return None
    text = re.sub(r"\s+", " ", text.strip())
    return text if len(text) >= 10 else None


def full_clean(text):
    if text in ("nan", "None", "NaN"):
        return None
    text = re.sub(r"http[s]?://[!$-_a-z]+", "", text.lower())
    text = phrases_cut(re.sub(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "", text))
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", "", text)).strip() or None


CASES = {
    "strip": (tx.strip, str.strip),
    "collapse": (tx.collapse_spaces, lambda t: re.sub(r"\s+", " ", t)),
    "normalize": (tx.normalize_whitespace, lambda t: re.sub(r"\s+", " ", t).strip()),
    "urls": (tx.remove_urls, lambda t: re.sub(r"http[s]?://[!$-_a-z]+", "", t)),
    "emails": (
        tx.remove_emails,
        lambda t: re.sub(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "", t),
    ),
    "phones": (tx.remove_phones, lambda t: re.sub(PHONE, "", t)),
    "boilerplate": (tx.remove_boilerplate, phrases_cut),
    "special": (tx.remove_special, lambda t: re.sub(r"[^a-z0-9\s]", "", t)),
    "special_punctuation": (
        lambda c: tx.remove_special(c, True),
        lambda t: re.sub(r"[^a-z0-9\s.,!?;:'\"-]", "", t),
    ),
    "clean_narrative": (tx.clean_narrative, narrative),
    "clean_text": (tx.clean_text, full_clean),
}


@pytest.mark.parametrize("name", CASES)
def test_expression_equals_python(texts, name):
    expression, plain = CASES[name]
    got = values(texts(SAMPLES).select("id", expression(F.col("text")).alias("t")), "t")
    assert got == [None if t is None else plain(t) for t in SAMPLES]


def test_counts_and_presence(texts):
    df = texts(SAMPLES).select(
        "id",
        tx.word_count(F.col("text")).alias("words"),
        tx.char_count(F.col("text")).alias("chars"),
        tx.has_text(F.col("text")).alias("wide"),
        tx.has_real_text(F.col("text")).alias("strict"),
    )
    rows = df.orderBy("id").collect()
    for row, text in zip(rows, SAMPLES):
        assert row.words == (len(text.split()) if text else 0)
        assert row.chars == (len(text) if text else 0)
        assert row.wide == bool(text)
        assert row.strict == (text is not None and text.strip() != "" and text not in ("nan", "None"))


def test_long_texts_stay_linear(texts):
    long_url = "go http://" + "a%20" * 5000 + " end"
    blanks = "x" + " " * 50_000 + "y"
    df = texts([long_url, blanks])
    assert values(df.select("id", tx.remove_urls(F.col("text")).alias("t")), "t")[0] == "go  end"
    assert values(df.select("id", tx.strip(F.col("text")).alias("t")), "t")[1] == blanks
    assert values(df.select("id", tx.clean_text(F.col("text")).alias("t")), "t")[1] == "x y"


def test_cleaning_options(texts):
    df = texts(["  A b  ", "short", None])
    keep = tx.clean_narrative(F.col("text"), remove_whitespace=False, remove_extra_spaces=False, min_length=0)
    assert values(df.select("id", keep.alias("t")), "t") == ["  A b  ", "short", None]
    upper = tx.clean_text(F.col("text"), lowercase=False, special_chars=False, whitespace=False)
    assert values(df.select("id", upper.alias("t")), "t") == ["  A b  ", "short", None]


def test_round_even(spark):
    df = spark.createDataFrame([(0, 0.125), (1, 0.375), (2, 12.345)], "id int, x double")
    assert values(df.select("id", tx.round_even(F.col("x"), 2).alias("r")), "r") == [0.12, 0.38, 12.34]


def test_dates(texts):
    df = texts(["2024-02-29", "02/29/2024", "2023-02-29", "soon", None, "2024-01-02 03:04:05"])
    got = values(df.select("id", parse_date(F.col("text")).cast("string").alias("d")), "d")
    assert got == ["2024-02-29 00:00:00", "2024-02-29 00:00:00", None, None, None, "2024-01-02 03:04:05"]
