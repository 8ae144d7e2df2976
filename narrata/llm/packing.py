"""Best-fit packing of tokenised documents, certified by lower bounds.

Documents are tokenised whole, an end id is put after each, and only documents longer than a sequence
are cut. The pieces are dealt by hash to groups of a few thousand; each group is packed by best-fit
decreasing. Dual feasible functions give a lower bound on the sequences any packing of the group
needs. A group that meets its bound is done, its packing is the best there is, but for its emptiest sequence. A group with a
gap gives up several of its emptiest sequences; the pieces of these are exchanged (dealt anew, over fewer
groups) and packed again by best-fit decreasing, until no gap is left or a round wins no sequence.
``certificate`` gives what then remains between the sequences used and the bound over all pieces.

Groups are bounded and hold only (id, piece, length), never text or ids of tokens. Every round starts
from a written table, so a lost executor costs one round at most, and all choices are made by hash
and sort, so a rerun gives the same sequences.

Defined cases: a null or empty text is the end id alone, a piece of length 1; rows that repeat an id
are packed as documents of their own; an empty table gives an empty result. Only doc_id and text are
read of the input.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.functions.batches import slices
from narrata.llm.common import staged
from narrata.llm.token_counts import is_word_vocabulary

SEQUENCE = 2048
GROUP = 4096
#: Parts of texts whose ids a task remembers; beyond that it starts anew.
REMEMBERED = 600_000
#: Bytes of text that are encoded at a time, besides one text.
SLICE = 1 << 22
#: Parts merged in one call of the library.
MERGED = 8192


#: Letters of blocks without combining marks; lower-casing these is the same before and after composition.
_beyond_latin = re.compile("[^\x00-\u02ff]")
#: Full stops and commas that may stand in one part with the sign in front; the blanks are those of the vocabulary.
_joined_marks = re.compile("[^a-z\u00df-\u00f6\u00f8-\u00ff0-9\t-\r \u0085\u00a0][.,]")


#: Byte-level vocabularies write bytes that are no printable Latin-1 character as U+0100 and up, in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_SYMBOLS = {b: b for b in range(256)} | dict(zip((b for b in range(256) if b not in _PRINTABLE), range(0x100, 0x200), strict=False))


#: Parts of small Latin letters, digits and signs without an apostrophe, and how the vocabulary splits them.
_simple = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff0-9!-&(-/:-@\[-`{-~]+")
_simple_words = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


class _Numbers(dict):
    """A number for each part, in order of arrival; ``new`` holds the parts that came last."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number


class PartTokenizer:
    """Ids of whole texts, from the ids of their parts; of vocabularies with another splitter, whole texts are encoded.

    The word vocabulary is lower case, drops white space and never joins over it, nor over the border of a
    letter or digit and a full stop or comma. So a text's ids are the ids of its parts in a row. Most
    parts repeat: each different part of a slice of texts is looked up once, which gives a number into one
    array of ids.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        self.remembered = remembered

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.parted = is_word_vocabulary(self.tokenizer)
        #: The same merges for words in the symbols of the model, which hold no white space.
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        end = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.ends_word[[number for token, number in vocabulary.items() if end and token.endswith(end)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    @staticmethod
    def _words(part: str) -> list[str] | None:
        """The words, digits and runs of signs of a part in their final form; None where the library must split it."""
        if part.isalpha() and part.islower() and (part.isascii() or not _beyond_latin.search(part)):
            return [part]
        return _simple_words.findall(part) if _simple.fullmatch(part) and "<|" not in part else None

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        # The characters that stand for the bytes of a word.
        symbols = [w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_SYMBOLS) for w in words]
        # Only the last token of a word carries the end of a word.
        ids = np.array(self.merger.encode_batch_fast([" ".join(symbols)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends_word[ids])
        if len(last) == len(words) and last[-1] == len(ids) - 1:
            return ids, np.diff(last, prepend=-1)
        every = [[token.id for token in self.tokenizer.model.tokenize(s)] for s in symbols]
        return np.fromiter(chain.from_iterable(every), np.uint32), np.fromiter(map(len, every), np.int64, len(every))

    def _learned(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in a row, and how many each has."""
        split = [self._words(part) for part in parts]
        numbers = np.fromiter((0 if words is None else len(words) for words in split), np.int64, len(parts))
        words = [word for found in split if found for word in found]
        sizes = np.zeros(len(parts), np.int64)
        ids = np.zeros(0, np.uint32)
        if words:
            ids, size = self._merge(words)
            np.add.at(sizes, np.repeat(np.arange(len(parts)), numbers), size)
        others = [place for place, found in enumerate(split) if found is None]
        if not others:
            return ids, sizes
        every = [self.tokenizer.encode(parts[place], add_special_tokens=False).ids for place in others]
        at = np.cumsum(sizes)[others]
        sizes[others] = [len(found) for found in every]
        return np.insert(ids, np.repeat(at, sizes[others]), np.fromiter(chain.from_iterable(every), np.uint32)), sizes

    def _learn(self) -> None:
        parts, self.known.new = self.known.new, []
        found = [self._learned(parts[at:at + MERGED]) for at in range(0, len(parts), MERGED)]
        sizes = np.concatenate([size for _, size in found])
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.concatenate([self.ids, *[ids for ids, _ in found]])

    @staticmethod
    def _spaced(text: str | None) -> str:
        """The text with a blank between all its parts."""
        text = text or ""
        if (text.isascii() or not _beyond_latin.search(text)) and "<|" not in text:
            text = text.lower()
            if not _joined_marks.search(text):
                text = text.replace(".", " .").replace(",", " ,")
        return text.replace("\n", " ")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text ends."""
        if not self.parted:
            every = [self.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
            return np.fromiter(chain.from_iterable(every), np.uint32), np.cumsum([len(ids) for ids in every])
        if len(self.known) > self.remembered:
            self._forget()
        spaced = pa.array([self._spaced(text) for text in texts], pa.large_string())
        split = pc.split_pattern(spaced, " ")
        parts = split.flatten().dictionary_encode()
        different = parts.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))
        if self.known.new:
            self._learn()
        number = number[parts.indices.to_numpy()]
        first, size = self.starts[number], self.sizes[number]
        ends = np.cumsum(size)
        ids = self.ids[np.arange(ends[-1]) + np.repeat(first - ends + size, size)]
        return ids, ends[np.cumsum(pc.list_value_length(split).to_numpy()) - 1]


@cache
def _tokenizer(path: str, remembered: int) -> PartTokenizer:
    """One for each worker process, so that its tasks share what has been looked up."""
    return PartTokenizer(path, remembered)


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = 0, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path, remembered)
        for batch in batches:
            for at, texts in slices(batch.column("text"), SLICE):
                every, ends = tokenizer.encode(texts.to_pylist())
                taken, out = [], []
                for row, ids in enumerate(np.split(every, ends[:-1])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for number, start in enumerate(range(0, len(ids), sequence)):
                        part = ids[start:start + sequence]
                        taken.append(at + row)
                        out.append((number, start, len(part), zlib.crc32(part.tobytes())))
                arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                arrays[0] = arrays[0].cast(pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(taken)), *arrays], columns)

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` must not increase."""
    numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(sequence + 1)]
    open_rooms: list[int] = []  # the sizes of room that some sequence has, in order
    used = 0
    for i, length in enumerate(lengths.tolist()):
        at = bisect_left(open_rooms, length)
        if at < len(open_rooms):
            room = open_rooms[at]
            number = rooms[room].pop()
            if not rooms[room]:
                del open_rooms[at]
        else:
            room, number = sequence, used
            used += 1
        numbers[i], offsets[i] = number, sequence - room
        left = room - length
        if left:
            if not rooms[left]:
                open_rooms.insert(bisect_left(open_rooms, left), left)
            rooms[left].append(number)
    return numbers, offsets


def lower_bound(lengths: np.ndarray, sequence: int, times: np.ndarray | None = None) -> int:
    """The sequences that any packing needs, by two families of dual feasible functions.

    ``times`` tells how many pieces there are of each of ``lengths`` (default: one).

    For a threshold e up to half a sequence, pieces over (sequence - e) count as whole sequences and
    those under e as nothing. For k >= 1, a piece counts as floor((k+1) x) / k sequences, or x where
    (k+1) x is whole. Both keep every set that fits into a sequence at one sequence or less.
    """
    if not len(lengths):
        return 0
    count = np.zeros(sequence + 1, np.int64)
    np.add.at(count, lengths, 1 if times is None else times)
    size = np.arange(sequence + 1, dtype=np.int64)
    below = np.concatenate([[0], np.cumsum(count * size)])  # words in pieces shorter than i
    number = np.concatenate([[0], np.cumsum(count)])
    e = np.arange(0, sequence // 2 + 1)
    whole = number[-1] - number[sequence - e + 1]
    middle = below[sequence - e + 1] - below[e]
    best = int(np.max(-(-(whole * sequence + middle) // sequence)))
    for k in range(1, 101):
        scaled = (k + 1) * size
        exact = scaled % sequence == 0
        value = np.where(exact, k * size, (scaled // sequence) * sequence)  # in units of 1 / (k * sequence)
        best = max(best, -(-int((count * value).sum()) // (k * sequence)))
    return best


ORDER = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]


def _packed(dealt: DataFrame, turn: int, sequence: int, alone: bool) -> DataFrame:
    """Pack every group (``part``); ``open`` marks the pieces that go into the next exchange.

    Where the group is not ``alone``, also one that meets its bound gives its emptiest sequence: the bounds of
    many groups are each rounded up.
    """

    def pack_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(ORDER)
        lengths = rows["length"].to_numpy()
        number, offset = best_fit_decreasing(lengths, sequence)
        count = int(number.max()) + 1
        gap = count - lower_bound(lengths, sequence)
        opened = np.zeros(count, bool)
        # The emptiest sequences: enough of them to win the gap back and leave best fit a choice.
        fill = np.bincount(number, weights=lengths, minlength=count)
        opened[np.argsort(fill, kind="stable")[: max(4 * gap, 8) if gap else 0 if alone else 1]] = True
        ids = (turn << 56) + (rows["part"].to_numpy() << 24) + number
        return (
            rows.drop(["part"]).append_column("sequence_id", pa.array(ids, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64())).append_column("open", pa.array(opened[number]))
        )

    kind = dealt.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"
    return dealt.groupBy("part").applyInArrow(pack_group, schema)


def packed(cut: DataFrame, sequence: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to a table of pieces (doc_id, piece, start, length, ids_crc32).

    Rounds go on while each needs fewer sequences for the exchanged pieces than they had; ``turn`` is part
    of the number of a sequence, so that there are 128 rounds at most.
    """
    waiting, placed, had = staged(cut, "pack-pieces"), None, math.inf
    for turn in range(128):
        parts = max(1, -(-waiting.count() // group))
        hashed = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn))
        dealt = waiting.withColumn("part", F.pmod(hashed, F.lit(parts)))
        done = staged(_packed(dealt, turn, sequence, parts == 1), f"pack-{turn}")
        # Every sequence has one piece at its start.
        used, opened = done.filter("offset = 0").agg(F.count("*"), F.count_if("open")).first()
        last = not opened or used >= had
        kept = done.drop("open") if last else done.filter("not open").drop("open")
        placed = kept if placed is None else placed.unionByName(kept)
        if last:
            break
        waiting, had = done.filter("open").drop("sequence_id", "offset", "open"), opened
    return placed


def certificate(placed: DataFrame, sequence: int = SEQUENCE) -> dict[str, int]:
    """Sequences used, the lower bound over all pieces, and the gap between them; from the counts by length."""
    counts = placed.groupBy("length").agg(F.count("*").alias("n"), F.count_if(F.col("offset") == 0).alias("first")).collect()  # a row for each length
    lengths = np.array([r["length"] for r in counts], np.int64)
    bound = lower_bound(lengths, sequence, np.array([r["n"] for r in counts], np.int64))
    used = sum(r["first"] for r in counts)
    return {"sequences": used, "bound": bound, "gap": used - bound}


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, remembered: int = REMEMBERED, **options) -> DataFrame:
    """Return doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    ``remembered`` bounds the parts of texts whose ids a worker keeps; it costs memory and saves time only.
    """
    return packed(pieces(docs, tokenizer_path, sequence, remembered=remembered), sequence, **options)
