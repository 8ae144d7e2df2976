"""MinHash near-duplicates from bottom-k sketches of one hash function.

1. A document's distinct word shingles are hashed with one function; the k smallest values are its
   sketch. Documents with equal sets form a class, and only classes are compared.
2. Inverted lists of the retained values generate overlaps. A list is kept for every three values that
   follow each other in a sketch: of two sets at a similarity of 0.8, in the order of the hash, four in
   five values are common, and but for a chance under 1e-7 three of them follow each other. Sets that fit
   into a sketch share three in a row always, those of four and five values two, which are listed too.
   Unlike single values, three in a row are seldom shared by chance, however common the words.
3. Short lists are compared directly. In a long list every class is compared with the list's leader, the
   class that shares most of its lists: in a group of copies the one nearest to all.
4. A pair goes on if 128 signed bits of the sets differ in no more than ``MOST_BITS`` and if its similarity,
   estimated from the k smallest values of the union of the two sketches, is not far below the threshold;
   exact Jaccard on the full sets decides. Links make components.
5. Classes in long lists that hold more than one component go through an exact prefix search on their full
   sets: rarest shingles first, with the bounds on overlap that size and position give. Rows of a list's
   main component are compared with the others only.

So no list of retained values is paired off beyond ``SHORT`` rows, and no link is lost in a long one; step 5 compares rows outside a
list's main component with all its rows. Thresholds are 0.8 or more.

Defined cases: a text of fewer words than a shingle is one shingle of all its words; an empty or null
text, or one without words, has an empty set, is linked with nothing and is kept; rows with a null id
are kept and have no component; rows that repeat id and text are alike; an empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import WORD, staged
from narrata.llm.components import components

SKETCH = 48
#: Lists up to this length are compared directly.
SHORT = 8
#: How far an estimate may lie below the threshold: five standard deviations.
SLACK = 5 * (0.8 * 0.2 / SKETCH) ** 0.5
#: Linked sets differ in more than this many of 128 signed bits but for a chance under 1e-7.
MOST_BITS = 48
#: Bits of the filter that picks texts to be read again; its size does not depend on the data.
FILTER_BITS = 1 << 23

_words = re.compile(WORD).findall
#: Only A to Z are lower-cased.
_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_remembered: dict[str, int] = {}


def _word_hashes(words: list[str]) -> np.ndarray:
    if len(_remembered) > 500_000:
        _remembered.clear()
    out = []
    for word in words:
        value = _remembered.get(word)
        if value is None:
            value = _remembered[word] = xxhash.xxh64_intdigest(word)
        out.append(value)
    return np.array(out, np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct hashes (signed 64-bit) of the word shingles of a text."""
    words = _words((text or "").translate(_lower))
    if not words:
        return np.zeros(0, np.int64)
    hashes, width = _word_hashes(words), min(width, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(words) - width + 1 + i]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def set_key(values: np.ndarray) -> int:
    """A 64-bit digest of a set."""
    return int.from_bytes(hashlib.md5(values.tobytes()).digest()[:8], "little", signed=True)


def signed_bits(values: np.ndarray) -> tuple[int, int]:
    """128 bits, each the majority of one bit over the set: sets at 0.8 differ in about 20 of them, others in 64."""
    other = (values.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (values.view(np.uint64) >> np.uint64(32))
    both = np.stack([values.view(np.uint64), other], axis=1)
    ones = np.unpackbits(both.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    low, high = np.packbits(2 * ones > len(values)).view("<i8").tolist()
    return low, high


def sketches(docs: DataFrame, width: int, tagged: bool = False) -> DataFrame:
    """doc_id, node (digest of the set; null for an empty one), n, low and high (signed bits) and sketch; ``tagged`` adds tag (hash of the text)."""
    tag = ["tag"] if tagged else []

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingles(text.as_py(), width) for text in part.column("text")]
                bits = [signed_bits(values) for values in sets]
                columns = [
                    pa.array([set_key(values) if len(values) else None for values in sets], pa.int64()), pa.array(map(len, sets), pa.int64()),
                    pa.array([low for low, _ in bits], pa.int64()), pa.array([high for _, high in bits], pa.int64()),
                    pa.array([values[:SKETCH] for values in sets], pa.list_(pa.int64())),
                ]
                names = ["doc_id", "node", "n", "low", "high", "sketch", *tag]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns, *map(part.column, tag)], names)

    docs = docs.select("doc_id", "text", *[F.xxhash64("text").alias(c) for c in tag])
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, n long, low long, high long, sketch array<long>"
    return docs.mapInArrow(sketched, kinds + "".join(f", {c} long" for c in tag))


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """One bit for every hash value, set where an id has it: an array of fixed size."""
    place = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS)) + 1
    rows = ids.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros((FILTER_BITS >> 15, 1 << 12), np.uint8)
    for r in rows:
        out[r["part"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node and the full set (``items``) of the wanted classes (node, rep), from the text of one document each.

    A filter of fixed size picks the texts in the tasks that read them, so only sets are shuffled.
    """
    wanted = wanted.select("node", "rep").filter("rep is not null").distinct()
    bits = _filter_bits(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1, pa.uint8()).cast(pa.bool_()))
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingles(t.as_py(), width) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(set_key, sets), pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["rep", "node", "items"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.filter("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("place"))
    sets = texts.mapInArrow(read, f"rep {kind}, node long, items array<long>")
    return sets.join(wanted.withColumnRenamed("rep", "first"), "node").filter("rep = first").select("node", "items").dropDuplicates(["node"])


def _side(df: DataFrame, side: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_{side}") for c in columns])


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (node_a, node_b) whose union sketch does not rule the threshold out."""
    for side in "ab":
        pairs = pairs.join(_side(classes, side, "node", "sketch"), f"node_{side}")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    shared = F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union)
    return pairs.filter(F.size(shared) >= (threshold - SLACK) * F.size(union)).select("node_a", "node_b")


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full sets reach the threshold, as links (u, v)."""
    for side in "ab":
        pairs = pairs.join(_side(sets, side, "node", "items"), f"node_{side}")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    every = F.size("items_a") + F.size("items_b") - shared
    return pairs.filter(100 * shared >= round(100 * threshold) * every).select(F.col("node_a").alias("u"), F.col("node_b").alias("v"))


def _listed(classes: DataFrame) -> DataFrame:
    """The lists with more than one row: key, rows (length of the list), node, shared (such lists of the node), n, low, high."""
    runs = []
    for length, wanted in ((3, F.size("sketch") > 0), (2, F.size("sketch").between(4, 5))):
        placed = classes.filter(wanted).select("node", "sketch", F.explode(F.sequence(F.lit(0), F.greatest(F.size("sketch") - length, F.lit(0)))).alias("at"))
        runs.append(placed.select("node", F.xxhash64(F.lit(length), *[F.get("sketch", F.col("at") + i) for i in range(length)]).alias("key")))
    rows = runs[0].unionByName(runs[1])
    lists = rows.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    listed = staged(rows.join(lists, "key"), "near-rows")
    shared = listed.groupBy("node").agg(F.count("*").alias("shared"))
    return listed.join(shared.join(classes.select("node", "n", "low", "high"), "node"), "node")


def _alike(threshold: float) -> Column:
    """Sizes of a pair that can be linked at all."""
    return F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")


def _close() -> Column:
    bits = F.bit_count(F.col("low_a").bitwiseXOR(F.col("low_b"))) + F.bit_count(F.col("high_a").bitwiseXOR(F.col("high_b")))
    return bits <= MOST_BITS


def _first_pairs(listed: DataFrame, threshold: float) -> DataFrame:
    """Pairs of the short lists, and of leaders with the others of the long ones, whose sizes and signed bits are alike."""
    about = ["node", "n", "low", "high"]
    short, long = listed.filter(f"rows <= {SHORT}"), listed.filter(f"rows > {SHORT}")
    sides = [short.select("key", *[F.col(c).alias(f"{c}_{side}") for c in about]) for side in "ab"]
    near = sides[0].join(sides[1], "key").filter((F.col("node_a") < F.col("node_b")) & _alike(threshold) & _close())
    leaders = long.groupBy("key").agg(F.min(F.struct(-F.col("shared"), *about)).alias("first"))
    led = long.select("key", *[F.col(c).alias(f"{c}_a") for c in about]).join(
        leaders.select("key", *[F.col("first")[c].alias(f"{c}_b") for c in about]), "key"
    ).filter((F.col("node_a") != F.col("node_b")) & _alike(threshold) & _close())
    ends = [F.least("node_a", "node_b").alias("node_a"), F.greatest("node_a", "node_b").alias("node_b")]
    return near.select(*ends).unionByName(led.select(*ends)).distinct()


def _open_nodes(listed: DataFrame, groups: DataFrame) -> DataFrame:
    """Classes in long lists that hold more than one component."""
    rows = listed.filter(f"rows > {SHORT}").join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("group"))
    mixed = rows.groupBy("key").agg(F.min("group").alias("one"), F.max("group").alias("other")).filter("one != other")
    return rows.join(mixed.select("key"), "key").select("node").distinct()


def _apart(rows: DataFrame) -> DataFrame:
    """Rows (value, group, ...) of the lists that hold more than one group, with the largest group as ``main``."""
    groups = rows.groupBy("value", "group").agg(F.count("*").alias("rows"))
    lists = groups.groupBy("value").agg(F.max(F.struct("rows", "group"))["group"].alias("main"), F.count("*").alias("groups"))
    return rows.join(lists.filter("groups > 1").drop("groups"), "value")


def _exact_pairs(sets: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different groups that the exact prefix search can't rule out."""
    rows = sets.select("node", F.explode("items").alias("value"))
    lists = rows.groupBy("value").agg(F.count("*").alias("rows")).filter("rows > 1")
    found = rows.join(lists, "value").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("rows", "value"))).alias("found"))
    percent = round(100 * threshold)
    n = F.size("items").cast("long")
    most = n - F.ceil(n * percent / 100) + 1  # the last place of a first common value
    placed = (
        sets.join(found, "node").join(groups, "node", "left")
        .select("node", F.coalesce("component", "node").alias("group"), n.alias("n"), most.alias("most"), (n - F.size("found")).alias("own"), "found")
        .filter("own < most")
        .select("node", "group", "n", "own", F.posexplode(F.slice("found", F.lit(1), (F.col("most") - F.col("own")).cast("int"))).alias("at", "f"))
        .select("node", "group", "n", (F.col("own") + F.col("at")).alias("at"), "f.value")
    )
    placed = _apart(placed)
    left = _side(placed.filter("group != main"), "a", "value", "node", "group", "n", "at").withColumnRenamed("value_a", "value")
    right = _side(placed, "b", "value", "node", "group", "n", "at", "main").withColumnRenamed("value_b", "value")
    least = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = least * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))
    once = (F.col("group_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b"))
    pairs = left.join(right, (left["value"] == right["value"]) & (F.col("group_a") != F.col("group_b")) & once & _alike(threshold) & enough)
    return pairs.select(F.least("node_a", "node_b").alias("node_a"), F.greatest("node_a", "node_b").alias("node_b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, tagged: bool = False) -> DataFrame:
    """Return doc_id, n_shingles, component_id (smallest id reached over links) and kept for every document.

    ``tagged`` adds tag (xxhash64 of the text), which tells rows with the same id apart.
    """
    sketched = staged(sketches(docs, width, tagged), "near-sketches")
    classes = staged(
        sketched.filter("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "low", "high", "sketch")]
        ),
        "near-classes",
    )
    listed = staged(_listed(classes), "near-listed")
    pairs = staged(_estimated(_first_pairs(listed, threshold), classes, threshold), "near-pairs")
    ends = pairs.select(F.explode(F.array("node_a", "node_b")).alias("node")).distinct()
    links = staged(_linked(pairs, full_sets(docs, _with_rep(ends, classes), width), threshold), "near-links")
    groups = components(links)
    open_nodes = _with_rep(_open_nodes(listed, groups), classes)
    open_sets = staged(full_sets(docs, open_nodes, width), "near-open")
    more = staged(_linked(_exact_pairs(open_sets, groups, threshold), open_sets, threshold), "near-more")
    if more.head(1):
        groups = components(links.unionByName(more))
    return _result(sketched, classes, groups)


def _with_rep(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    return staged(classes.select("node", "rep").join(nodes, "node", "left_semi"), "near-wanted")


def _result(sketched: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Give every document the smallest id of its component."""
    named = classes.select("node", "rep").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_node = named.join(least, "component").select("node", "component_id")
    component_id = F.when(F.col("node").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return sketched.join(by_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"), *[c for c in sketched.columns if c == "tag"],
    )
