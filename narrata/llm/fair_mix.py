"""Mixing sources to target weights by weighted fair queueing.

Every source is shuffled by a seeded hash of the document id. The n-th document of a source gets the
virtual finish time (words of the source up to and with it) / (target words of the source); a second
pass over the source goes on where the first ended. All documents, sorted by this time, are taken
until the budget is used up. A source then gets words in proportion to its target at every moment.

Running sums and the cut never pass one task over a source: sums are taken for short ranges of the
hash first (4,096 for a source), then inside each range; the cut is narrowed twice by 4,096 time
slices before the few documents left are ranked.

Defined cases: a null text and a text without words have size 0 and are never taken; a null source
is a source of its own, after all others; rows with the same id and size are interchangeable; an
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.llm.common import staged, word_count

SLICES = 4096


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """Targets of a small table (src, source_size): ``share`` of all words by weight, at most ``repeats`` times a source.

    Weights are dealt to the sources in the order of ``src``, again and again. Sources sorted by
    limit / weight fill up first; the level of the others follows from what is left.
    """
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget = share * total
    by_name = Window.orderBy("src")
    by_level = Window.orderBy("full_at", "src")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    place = (F.row_number().over(by_name) - 1) % len(weights)
    levels = (
        sources.withColumn("weight", F.get(F.array(*[F.lit(int(w)) for w in weights]), place).cast("double"))
        .withColumn("most", (F.col("source_size") * repeats).cast("double"))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("level", (F.lit(budget) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    )
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "src", "level"))).over(Window.partitionBy())["level"]
    return levels.withColumn("common", F.coalesce(level, F.max("full_at").over(Window.partitionBy()))).select(
        "src", "source_size", F.least("most", F.col("common") * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: str = "mix",
    size: Column | None = None,
) -> DataFrame:
    """Return doc_id, size, source_size, target, taken (words the mix takes, repeats counted) for every document."""
    return queued_turns(docs, weights, share, repeats, seed, size).drop("text_hash")


def queued_turns(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: str = "mix",
    size: Column | None = None,
) -> DataFrame:
    """``mix`` with the hash of the text, by which the rows find their documents again."""
    src = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("~"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    sized = staged(
        docs.select(
            "doc_id", src.alias("src"), (word_count(F.col("text")) if size is None else size).alias("size"),
            F.conv(F.substring(key, 1, 3), 16, 10).cast("int").alias("part"),
            key.alias("key"), F.xxhash64("text").alias("text_hash"),
        ),
        "mix-sizes",
    )
    parts = sized.groupBy("src", "part").agg(F.sum("size").alias("part_size"))
    sources = parts.groupBy("src").agg(F.sum("part_size").alias("source_size"))
    running = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.withColumn("start", F.coalesce(F.sum("part_size").over(running), F.lit(0)))
        .join(source_targets(sources, weights, share, repeats), "src")
        .drop("part_size")
    )
    inside = Window.partitionBy("src", "part").orderBy("key", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    queued = staged(
        sized.join(starts, ["src", "part"])
        .withColumn("until", F.col("start") + F.sum("size").over(inside))
        .select("doc_id", "src", "key", "text_hash", "size", "source_size", "target", "until"),
        "mix-queue",
    )
    finishes = [
        (F.col("until") + turn * F.col("source_size")).cast("double") / F.col("target") for turn in range(repeats)
    ]
    turns = queued.filter("size > 0").withColumn("finish", F.explode(F.array(*finishes)))
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cut = _cut(turns, budget)
    order = [F.struct(f.alias("finish"), "src", "key") for f in finishes]
    taken_turns = [F.lit(1) if cut is None else (o <= _literal(cut)).cast("int") for o in order]
    times = F.when(F.col("size") > 0, sum(taken_turns[1:], taken_turns[0])).otherwise(F.lit(0))
    return queued.select("doc_id", "text_hash", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def _literal(cut) -> Column:
    return F.struct(F.lit(cut[0]).alias("finish"), F.lit(cut[1]).alias("src"), F.lit(cut[2]).alias("key"))


def _cut(turns: DataFrame, budget: float):
    """(finish, src, key) of the last turn the budget has room for; None when all turns fit.

    Only single rows come to the driver: the slice of time in which the budget runs out, the finer
    slice inside it, and the last turn taken.
    """
    coarse = F.least(F.floor(F.col("finish") * SLICES), F.lit(4 * SLICES))
    fine = F.least(F.floor((F.col("finish") * SLICES - coarse) * SLICES), F.lit(SLICES))
    turns = turns.withColumn("coarse", coarse).withColumn("fine", fine)
    room, within = budget, turns
    for name in ("coarse", "fine"):
        running = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
        full = (
            within.groupBy(name).agg(F.sum("size").alias("words"))
            .withColumn("until", F.sum("words").over(running))
            .filter(F.col("until") > room)
            .agg(F.min(F.struct(name, "until", "words")).alias("first"))
            .first()["first"]
        )
        if full is None:
            return None
        within = within.filter(F.col(name) == full[name])
        room -= full["until"] - full["words"]
    running = Window.orderBy("finish", "src", "key").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        within.withColumn("until", F.sum("size").over(running))
        .agg(
            F.max(F.when(F.col("until") <= room, F.struct("finish", "src", "key"))).alias("last"),
            F.min("finish").alias("low"),
        )
        .first()
    )
    return tuple(last["last"]) if last["last"] is not None else (last["low"], "", "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it; all columns are kept.

    Rows that repeat both id and text are each written as often as the most taken of them.
    """
    names = ["__id", "__text", "__times"]
    taken = (
        queued_turns(docs, **options)
        .filter("taken > 0")
        .groupBy(F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1]))
        .agg(F.max((F.col("taken") / F.col("size")).cast("int")).alias(names[2]))
    )
    on = docs["doc_id"].eqNullSafe(taken[names[0]]) & (F.xxhash64(docs["text"]) == taken[names[1]])
    return (
        docs.join(taken, on)
        .withColumn(names[2], F.explode(F.array_repeat(F.lit(0), F.col(names[2]))))
        .select(*[docs[c] for c in docs.columns])
    )
