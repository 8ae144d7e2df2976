import random
import zlib

import numpy as np
import pytest
from narrata.llm import packing
from narrata.llm.queries import op6_best_fit_packing, tokenizer_path
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"


def expected_pieces(docs):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    out = []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            out.append((doc_id, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def assert_packed(rows, docs):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == expected_pieces(docs)
    used = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values(), default=0) <= 2048
    return len(used)


def test_whole_table(spark):
    rows = op6_best_fit_packing(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    sequences = assert_packed(rows, docs)
    assert sequences <= packing.lower_bound(np.array([r.length for r in rows]), 2048) + 1


def test_odd_texts(spark):
    texts = [
        None, "", " ", "\n\t\x0b\x1c  x", "a" * 5000, "word " * 4000, "Étude e ́x", "<|endoftext|> and<|startoftext|>",
        "İstanbul ΣΣ ﬁ", "it's we'll 'S", "\U0001f600 中文 123", "same", "same",
    ]
    docs = [(i if i else None, t) for i, t in enumerate(texts)]
    docs += [(12, "same")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS piece", "2 AS length")
    assert_packed(packing.pack(df, tokenizer_path()).collect(), docs)
    assert packing.pack(df.filter("false"), tokenizer_path()).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_random_strings(name):
    """Every control character, marks behind them, combining marks: the ids are the library's."""
    draw = random.Random(4)
    pool = [chr(c) for c in range(256)] + ["\u0301", "\u0308", "\u0327", "\u0130", "\u2028", "<|endoftext|>"] * 3 + list(".,.,.,  aAeE1'\x1c\x1d\x1e\x1f\x85\xa0") * 6
    texts = ["".join(draw.choices(pool, k=draw.randint(1, 16))) for _ in range(50_000 if name.startswith("word") else 5000)]
    ids, ends = packing.PartTokenizer(tokenizer_path(name)).encode(texts)
    found = [part.tolist() for part in np.split(ids, ends[:-1])]
    expected = [e.ids for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch(texts, add_special_tokens=False)]
    assert [(t, f, e) for t, f, e in zip(texts, found, expected, strict=True) if f != e][:3] == []


class Counted:
    """A tokenizer that counts what is asked of it."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, 0

    def __getattr__(self, name):
        self.asked += 1
        return getattr(self.tokenizer, name)


def test_new_parts_are_merged_together():
    """Thousands of different words, also with digits and signs, cost no call of the library each."""
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnoé", k=draw.randint(2, 12))) for _ in range(20_000)]
    texts = [" ".join(w + draw.choice(["", "", "!!", "###", "(2)", "."]) for w in words[at:at + 500]) for at in range(0, 20_000, 500)]
    library = Tokenizer.from_file(tokenizer_path())
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for end_found in (True, False):
        tokenizer = packing.PartTokenizer(tokenizer_path())
        tokenizer.ends_word &= end_found  # without it every word is merged alone
        tokenizer.tokenizer = Counted(tokenizer.tokenizer)
        ids, ends = tokenizer.encode(texts)
        assert [part.tolist() for part in np.split(ids, ends[:-1])] == expected
        assert (tokenizer.tokenizer.asked < 100) == end_found


def test_certificate_and_end(spark):
    """Rounds end with no gap or no gain, and the certificate says what remains."""
    draw = random.Random(9)
    for choices, gap in (([1024, 512], 0), ([700, 690, 1300, 650], None)):
        rows = [(i, 0, 0, draw.choice(choices), i) for i in range(3000)]
        cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
        placed = packing.packed(cut, group=300).cache()
        found = packing.certificate(placed)
        assert found["sequences"] == placed.select("sequence_id").distinct().count() and found["gap"] >= 0
        assert found["bound"] == packing.lower_bound(np.array([r[3] for r in rows]), 2048)
        assert found["gap"] == gap if gap is not None else found["gap"] <= 0.1 * found["bound"]
    assert packing.certificate(placed.limit(0)) == {"sequences": 0, "bound": 0, "gap": 0}


def test_exchange_between_groups(spark):
    texts = [(i, "the " * (1 + (i * 37) % 1500)) for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack(df, tokenizer_path(), group=100).collect()
    sequences = assert_packed(rows, texts)
    assert sequences <= 1.02 * packing.lower_bound(np.array([r.length for r in rows]), 2048) + 1


@pytest.mark.parametrize("seed", range(5))
def test_bound_never_above_packing(seed):
    draw = np.random.default_rng(seed)
    lengths = np.sort(draw.choice([30, 33, 40, 51, 60, 100], 200))[::-1]
    number, offset = packing.best_fit_decreasing(lengths, 100)
    assert packing.lower_bound(lengths, 100) <= number.max() + 1
    assert np.bincount(number, weights=lengths).max() <= 100
    assert packing.lower_bound(np.array([51] * 7 + [60] * 3), 100) == 10
    assert packing.lower_bound(np.array([34] * 9), 100) == 5
