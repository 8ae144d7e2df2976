import random

import pytest
from narrata.llm import token_counts
from narrata.llm.queries import op12_token_counts, tokenizer_path
from tokenizers import Tokenizer

WORD = "word_bpe_49k.json"
LATIN = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028))] + list("    aaeett''..,,ssrevmd012") * 8
OTHERS = ["́", "̈", "　", "Σ", "σς", "中文", "ру", "\U0001f600", " ", "ﬁ", "İ", "<|endoftext|>", "<|startoftext|>", "<|", "|>"] * 6


def library(name):
    return Tokenizer.from_file(tokenizer_path(name))


@pytest.mark.parametrize(("name", "pool", "number"), [
    (WORD, LATIN, 50_000), (WORD, LATIN + OTHERS, 30_000), ("byte_bpe_50k.json", LATIN + OTHERS, 10_000),
])
def test_random_strings(name, pool, number):
    draw = random.Random(5)
    texts = ["".join(draw.choices(pool, k=draw.randint(1, 24))) for _ in range(number)]
    counted = token_counts.counter(tokenizer_path(name)).counts(texts)
    expected = [len(e) for e in library(name).encode_batch(texts, add_special_tokens=False)]
    assert [(t, c, e) for t, c, e in zip(texts, counted, expected, strict=True) if c != e][:3] == []


def test_every_proven_string_is_one_token():
    tokens, model = token_counts.counter(tokenizer_path(WORD)), library(WORD)
    proven = sorted(tokens.by_text.proven)
    single = [len(e) for e in model.encode_batch(proven, add_special_tokens=False)]
    # What the splitter cuts is never looked up; all else is one token.
    wrong = [p for p, n in zip(proven, single, strict=True) if n != 1 and tokens.pattern.findall(p) == [p]]
    assert wrong == [] and len(proven) > 30_000


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    tokens = token_counts.WordCounter(tokenizer_path(WORD))
    texts = [f"wxq{i}vv zkr{i}q" + "y" * 100 for i in range(50)]
    assert tokens.counts(texts) == [len(e) for e in library(WORD).encode_batch(texts, add_special_tokens=False)]
    assert len(tokens.by_text) <= len(tokens.by_text.proven) + 10


def test_pieces():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    texts = ["one two  three", "", "naïve\ncafé 中"]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert token_counts.counter(path).counts(texts) == [len(model.encode(t)) for t in texts]


def test_table(spark):
    long_text = "some words, and more of them " * 50_000
    rows = [(1, None, 3), (2, "", 4), (None, "a b", 5), (4, "a b", 6), (4, "a b", 6), (5, long_text, 7), (6, "Ünïcode 中文 <|endoftext|>", 8), (7, "w " * 2048, 9), (8, "w " * 2049, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = token_counts.token_counts(docs, tokenizer_path(WORD))
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    model = library(WORD)
    expected = []
    for doc_id, text, _ in rows:
        n = len(model.encode(text or "", add_special_tokens=False))
        expected.append((doc_id, len((text or "").encode()), n, n > 2048))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
    assert {(d, o) for d, _, _, o in expected if d in (7, 8)} == {(7, False), (8, True)}
    assert token_counts.token_counts(docs.limit(0), tokenizer_path(WORD)).count() == 0


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    model = library(WORD)
    expected = dict(zip(texts, (len(e) for e in model.encode_batch(list(texts.values()), add_special_tokens=False)), strict=True))
    rows = op12_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == expected and len(rows) == len(texts)
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)
