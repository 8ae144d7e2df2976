"""Token counts of whole texts, as the library of a public vocabulary gives them.

Whole-token shortcut. A vocabulary's model merges inside one pre-token only (a word, a number, a run of
signs). So a vocabulary string that the model, given it alone, encodes as one token is one token wherever
it is a pre-token. ``proven_whole`` proves that once for every string of the vocabulary; its table is as
large as the vocabulary, whatever the input. A text is then split into pre-tokens, the proven ones count as
one each, and only the rest is merged by the model. Merged ones are remembered up to ``REMEMBERED``.

Texts of Latin letters and common punctuation are split by an expression of our own, whose classes are
those of the vocabulary's splitter. Texts with other characters are split by the library's normaliser and
splitter, texts that hold an added token (such as ``<|endoftext|>``) go through the library whole, and so do
vocabularies with another splitter, or with a model whose merges are not bound to pre-tokens (``.model``).

One pass, no shuffle, no state between batches but the table of words.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows each give their row; a null id
is kept; an empty table gives an empty result. Only doc_id and text are read, other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
#: Merged pre-tokens a worker remembers, and the longest that it does; beyond that it starts anew.
REMEMBERED = 600_000
LONGEST = 64
#: Texts of more characters are split as a stream.
STREAMED = 1 << 20

#: Fixed value: the splitter of the lower-case word vocabulary, whose classes ``_word_pattern`` states for Latin text.
WORD_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that composition leaves as they are and whose classes are the same in all versions of Unicode.
_unusual = re.compile("[^\x00-ɏ‐-‧]")


def _word_pattern() -> re.Pattern:
    """The word splitter for lower-cased text of the usual characters."""
    usual = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028))]
    letters, numbers = ("".join(c for c in usual if unicodedata.category(c)[0] == kind) for kind in "LN")
    space = "\t\n\v\f\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}{space}]+")


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, others from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


def proven_whole(tokenizer, end: str) -> set[str]:
    """The pre-tokens (in the symbols of the model) that the model encodes as one token.

    ``end`` is what the model puts after the last symbol of a pre-token; the strings without it are proven
    as well as those that carry it, since only what the model answers counts.
    """
    strings = {s.removesuffix(end) if end else s for s in tokenizer.get_vocab(with_added_tokens=False)} - {""}
    return {s for s in strings if len(tokenizer.model.tokenize(s)) == 1}


class _Merged(dict):
    """Number of tokens by pre-token; what is not known is merged, and remembered within bounds."""

    def __init__(self, proven: dict[str, int], merge: Callable[[str], int]):
        super().__init__(proven)
        self.proven, self.merge = proven, merge

    def __missing__(self, part: str) -> int:
        number = self.merge(part)
        if len(part) <= LONGEST:
            if len(self) >= len(self.proven) + REMEMBERED:
                self.clear()
                self.update(self.proven)
            self[part] = number
        return number


def is_word_vocabulary(tokenizer) -> bool:
    """Whether texts are composed, lower-cased and split by ``WORD_SPLITTER``."""
    form = json.loads(tokenizer.to_str())
    splitter = form["pre_tokenizer"] or {}
    first = splitter.get("pretokenizers", [splitter])[0]
    steps = [s["type"] for s in (form["normalizer"] or {}).get("normalizers", [])]
    return first.get("pattern", {}).get("Regex") == WORD_SPLITTER and steps == ["NFC", "Replace", "Lowercase"]


class WordCounter:
    """Token counts under a byte-level pair vocabulary with a splitter."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        form = json.loads(self.tokenizer.to_str())
        model, splitter = form["model"], form["pre_tokenizer"] or {}
        steps = splitter.get("pretokenizers", [splitter])
        #: The model must see pre-tokens in byte symbols and always answer alike.
        self.shortcut = model["type"] == "BPE" and not model["dropout"] and steps[-1].get("type") == "ByteLevel"
        self.words = is_word_vocabulary(self.tokenizer)
        added = [re.escape(t["content"]) for t in form["added_tokens"]]
        self.added = re.compile("|".join(added)) if added else None
        if not self.shortcut:
            return
        whole = proven_whole(self.tokenizer, model.get("end_of_word_suffix") or "")
        self.by_symbols = _Merged(dict.fromkeys(whole, 1), lambda part: len(self.tokenizer.model.tokenize(part)))
        symbols = byte_symbols()
        self.to_symbols = {b: s for b, s in symbols.items() if ord(s) != b}
        back = {ord(s): b for b, s in symbols.items()}
        plain = {}
        for part in whole:
            try:
                plain[part.translate(back).encode("latin-1").decode()] = 1
            except UnicodeDecodeError:  # part of a character: never a pre-token of plain text
                continue
        self.by_text = _Merged(plain, lambda part: self.by_symbols[part.encode().decode("latin-1").translate(self.to_symbols)])
        self.pattern = _word_pattern()

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.shortcut or (self.added and self.added.search(text)):
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        lowered = text.lower()
        if not self.words or _unusual.search(text) or _unusual.search(lowered):
            if self.tokenizer.normalizer:
                text = self.tokenizer.normalizer.normalize_str(text)
            known = self.by_symbols
            return sum(known[part] for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))
        if len(lowered) > STREAMED:
            known = self.by_text
            return sum(known[found.group()] for found in self.pattern.finditer(lowered))
        return sum(map(self.by_text.__getitem__, self.pattern.findall(lowered)))

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(self.count, texts))


class PieceCounter:
    """Token counts under a piece model, whose merges run over the whole text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]


@cache
def counter(path: str) -> WordCounter | PieceCounter:
    """One for each worker process: the proof is made once."""
    return PieceCounter(path) if path.endswith(".model") else WordCounter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(tokenizer_path)
        for batch in batches:
            texts = batch.column("text")
            numbers: list[int] = []
            for at in range(0, batch.num_rows, 256):
                numbers += tokens.counts([t or "" for t in texts.slice(at, 256).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(numbers, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    docs = docs.select("doc_id", n_bytes.alias("n_bytes"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
