"""Line deduplication by pairwise alignment.

Lines are compared by hash, without blanks around them; the second occurrence of a line in a document is
a line of its own, so lines are unique in their document. Lines without a word are no lines here.

1. A rare line, held by at most ``RARE`` documents, makes every later holder meet every earlier one. A more
   frequent line is boilerplate of its first holder (smallest id), whom each later holder meets. So no line is
   left out, and a list of n documents gives n - 1 pairs, or at most 28 where it is rare.
2. Each pair of documents is aligned by patience diff: the longest run of common lines that rises on both sides.
   Aligned lines that follow each other in the later document form a common block. What the run leaves over may
   have moved: of it, lines that follow each other in both documents form a block.
3. Blocks of one pair with at least ``min_words`` words are deleted from the later document, with the lines
   without a word between them. Shorter blocks stay, also where blocks of several pairs lie side by side.

Shuffled are line hashes, then the common lines of pairs, and once the texts that get their lines removed. The
hashes are a written table, so texts are read once for them. Rows of a frequent line are split by Spark where
they fill a partition. Aligning n common lines costs n log n.

Defined cases: a null text stays null, an empty one empty; rows with a null id are left alone; rows of one id
are the same document and do not delete from each other; of exact copies the first stays whole and the others
become empty, as does every document whose last line with a word goes; an empty table gives an empty result.
Only doc_id (any type that sorts) and text are read by ``line_removals``; ``deduplicated`` keeps all columns,
but for input columns named removed_lines or removed_partners, which its own replace.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import WORD, staged

MIN_WORDS = 5
#: Lines held by so many documents are rare.
RARE = 8
BLANKS = " \t\n\v\f\r"
_words = re.compile(WORD).findall


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            rows, out = [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                seen: dict[str, int] = {}
                place = -1
                for at, line in enumerate(text.split("\n")):
                    if not (words := len(_words(line))):
                        continue
                    place += 1
                    line = line.strip(BLANKS)
                    again = seen[line] = seen.get(line, -1) + 1
                    hashed = xxhash.xxh3_128_intdigest(line, seed=again)
                    rows.append(row)
                    out.append((at, place, words, (hashed >> 64) - (1 << 63), (hashed & 0xFFFFFFFF) - (1 << 31)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(take), part.column("tag").take(take), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "tag", "at", "place", "words", "hash", "check"],
            )


def line_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, tag (hash of the text), at (line number from 0), place (among lines with a word), words, hash and check of every line with a word."""
    docs = docs.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("tag"), "text")
    return docs.mapInArrow(_lines, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tag long, at int, place int, words int, hash long, check int")


def patience(pairs: list[tuple[int, int]]) -> list[int]:
    """Indices of the longest run of ``pairs`` that rises on both sides; ``pairs`` are sorted by the first."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(pairs)
    for i, (_, other) in enumerate(pairs):
        at = bisect_left(tops, other)
        below[i] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(other)
            piles.append(i)
        else:
            tops[at], piles[at] = other, i
    run, i = [], piles[-1] if piles else -1
    while i >= 0:
        run.append(i)
        i = below[i]
    return run[::-1]


def _counted(block: list[tuple[int, int, int]], min_words: int) -> list[int]:
    return [place for place, _, _ in block] if sum(words for _, _, words in block) >= min_words else []


def common_blocks(pairs: list[tuple[int, int, int]], min_words: int) -> list[int]:
    """Places of the later document that go, from (place, place in the earlier one, words), sorted by place."""
    run = patience([(place, held) for place, held, _ in pairs])
    out: list[int] = []
    block: list[tuple[int, int, int]] = []
    for i in run:
        if block and pairs[i][0] != block[-1][0] + 1:
            out += _counted(block, min_words)
            block = []
        block.append(pairs[i])
    out += _counted(block, min_words)
    chosen, block = set(run), []
    moved = [p for i, p in enumerate(pairs) if i not in chosen]
    for pair in sorted(moved, key=lambda p: (p[1] - p[0], p[0])):
        if block and (pair[0] != block[-1][0] + 1 or pair[1] != block[-1][1] + 1):
            out += _counted(block, min_words)
            block = []
        block.append(pair)
    return out + _counted(block, min_words)


def common_lines(lines: DataFrame) -> DataFrame:
    """doc_id, tag, at, place, words of a line, partner and partner_tag of an earlier document, held: its place there."""
    holders = (
        lines.groupBy("hash", "check")
        .agg(F.count("*").alias("holders"), F.min(F.struct("doc_id", "tag", "place")).alias("first"), F.max("doc_id").alias("last"))
        .filter("first.doc_id < last").drop("last")
    )
    shared = staged(lines.join(holders, ["hash", "check"]), "shared-lines")
    mine = ["doc_id", "tag", "at", "place", "words"]
    frequent = shared.filter(f"holders > {RARE} AND doc_id > first.doc_id").select(
        *mine, F.col("first.doc_id").alias("partner"), F.col("first.tag").alias("partner_tag"), F.col("first.place").alias("held")
    )
    rare = shared.filter(f"holders <= {RARE}").select("hash", "check", *mine)
    earlier = rare.select("hash", "check", F.col("doc_id").alias("partner"), F.col("tag").alias("partner_tag"), F.col("place").alias("held"))
    met = rare.join(earlier, ["hash", "check"]).filter("doc_id > partner")
    return met.select(*mine, "partner", "partner_tag", "held").unionByName(frequent)


def line_removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, tag, removed (line numbers), partners (ids aligned with) of the documents that lose lines.

    Of lines without a word none is listed; ``deduplicated`` takes those inside of a block.
    """
    common = common_lines(staged(line_hashes(docs), "lines"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "tag", "removed", "partners", "places"]
    order = ["doc_id", "tag", "partner", "partner_tag", "place"]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in [*order, "held", "words", "at"]), strict=True)

        def result():
            parts = list(zip(*found, strict=True)) or [[]] * 5
            kinds = [id_kind, pa.int64(), pa.list_(pa.int32()), pa.list_(id_kind), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds, strict=True)], columns)

        found: list[tuple] = []
        first = next(batches, None)
        if first is None:
            return
        id_kind, batches = first.schema.field("doc_id").type, chain([first], batches)
        for doc, of_doc in groupby(rows(), key=lambda r: r[:2]):
            gone: dict[int, int] = {}
            partners = []
            for partner, of_pair in groupby(of_doc, key=lambda r: r[2:4]):
                pairs = list(of_pair)
                removed = common_blocks([(r[4], r[5], r[6]) for r in pairs], min_words)
                if removed:
                    at = {r[4]: r[7] for r in pairs}
                    gone |= {place: at[place] for place in removed}
                    if partner[0] not in partners[-1:]:
                        partners.append(partner[0])
            if gone:
                places = sorted(gone)
                found.append((*doc, [gone[place] for place in places], partners, places))
            if len(found) >= 2000:
                yield result()
                found = []
        yield result()

    schema = f"doc_id {kind}, tag long, removed array<int>, partners array<{kind}>, places array<int>"
    return common.repartition("doc_id").sortWithinPartitions(*order).mapInArrow(decide, schema)


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the removed lines, with two more columns: removed_lines and removed_partners."""
    docs = docs.drop("removed_lines", "removed_partners")
    found = line_removals(docs, min_words).select(
        F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), F.struct("removed", "partners", "places").alias("__gone")
    ).dropDuplicates(["__id", "__tag"])
    joined = docs.join(found, (docs["doc_id"] == found["__id"]) & (F.xxhash64(docs["text"]) == found["__tag"]), "left")
    lines = F.split(docs["text"], "\n")
    removed, places = found["__gone"]["removed"], found["__gone"]["places"]
    # A line without a word goes where the removed lines around it follow each other.
    follows = F.zip_with(F.slice(removed, 1, F.size(removed) - 1), F.slice(removed, 2, F.size(removed) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    between = F.flatten(F.transform(
        F.filter(follows, lambda s, i: (F.get(places, i + 1) == F.get(places, i) + 1) & (s["b"] > s["a"] + 1)),
        lambda s: F.sequence(s["a"] + 1, s["b"] - 1),
    ))
    out = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.concat(removed, between))
    kept = F.array_join(F.transform(out, lambda i: F.get(lines, i)), "\n")
    text = F.when(found["__gone"].isNull(), docs["text"]).when(kept.rlike(WORD), kept).otherwise("")
    columns = [docs[c] if c != "text" else text.alias("text") for c in docs.columns]
    return joined.select(
        *columns, F.coalesce(removed, F.array().cast("array<int>")).alias("removed_lines"),
        F.coalesce(found["__gone"]["partners"], F.array().cast(found.schema["__gone"].dataType["partners"].dataType)).alias("removed_partners"),
    )
