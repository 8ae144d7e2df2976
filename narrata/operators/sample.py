"""Exact seeded samples.

The order of the sample is the MD5 of seed and key: repeatable, independent of partitioning, and
the same in every engine. The smallest hashes are found without sorting the data. Rows are counted
per leading digits of the hash, the counts tell in which cell the last wanted row lies, rows of the
cells before it are kept, and only those of this one cell are ranked. One stratum may hold any share
of the table: its rows are counted with map-side partial sums, and one in 65,536 reaches a ranking task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from narrata.functions.text import round_even
from narrata.params import TARGET_SAMPLE_RANGE, require_columns
from narrata.session import pinned_if_small

RANKED = 100_000  # rows of a cell that one task ranks without a finer cut
CELL_DIGITS = 4  # leading hex digits of the hash: 65,536 cells


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def sample_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), _q(key).cast("string")))


def _cell(hash_col: Column) -> Column:
    return F.substring(hash_col, 1, CELL_DIGITS)


def _check_size(n: int) -> None:
    if n <= 0:
        raise ValueError(f"sample size must be positive, got {n}")


def _first(df: DataFrame, n: int, cell: Column, order: list[Column]) -> DataFrame:
    """The first n rows by ``order``. Rows of cells before the last one wanted are kept unranked.

    ``cell`` grows with the order and has a bounded number of values, so the running count below is
    over that many rows at most, and one of them comes to the driver; only the rows of one cell are
    ranked, and no limit is global.
    """
    counts = df.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"))
    running = counts.select("cell", F.sum("n").over(Window.orderBy("cell")).alias("upto"), "n")
    last = running.filter(F.col("upto") >= n).orderBy("cell").select("cell", n - F.col("upto") + F.col("n")).first()
    if last is None:  # the table has no more than n rows
        return df
    marked, kept = df.withColumn("_cell", cell), [_q(c) for c in df.columns]
    ranked = marked.filter(F.col("_cell") == last[0]).withColumn("_rank", F.row_number().over(Window.partitionBy("_cell").orderBy(*order)))
    return marked.filter(F.col("_cell") < last[0]).select(*kept).unionByName(ranked.filter(F.col("_rank") <= last[1]).select(*kept))


def simple_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n random rows without replacement; all rows when the table has no more than n."""
    _check_size(n)
    order = sample_hash(key, seed)
    return _first(df, n, _cell(order), [order, _q(key)]).orderBy(order, _q(key))


def prefix_sample(df: DataFrame, n: int, key: str, seed: int = 42, factor: int = 3) -> DataFrame:
    """n random rows out of the first ``factor * n`` in the order of the numeric column ``key``."""
    _check_size(n)
    return simple_sample(_first(df, factor * n, _narrowed(df, factor * n, key), [_q(key)]), n, key, seed)


def _narrowed(df: DataFrame, n: int, key: str) -> Column:
    """Cells of the key, fine where the n-th smallest lies: that cell holds few rows whatever the spread of the keys.

    The range of the keys is cut into cells of equal width and the rows of each are counted. While the cell with
    the n-th row holds more than ``RANKED`` rows, its own range is cut in the same way: each round reads the key
    column and divides the width by 65,536, so four rounds reach the precision of a double. Cells below and above
    the range are one each.
    """
    value, cells = _q(key).cast("double"), 16**CELL_DIGITS
    low, high = df.agg(F.min(value), F.max(value)).first()
    cell = F.lit(0)
    while low is not None and low < high:
        place = F.floor((value - low) / (high - low) * cells)
        cell = F.when(value < low, -1).when(value > high, cells).otherwise(F.least(place, F.lit(cells - 1))).cast("long")
        counts = df.filter(value.isNotNull()).groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        running = counts.select("*", F.sum("n").over(Window.orderBy("cell")).alias("upto"))
        last = running.filter(F.col("upto") >= n).orderBy("cell").first()
        if last is None or last["n"] <= RANKED or (last["low"], last["high"]) == (low, high):
            break
        low, high = last["low"], last["high"]
    return F.coalesce(cell, F.lit(-2))  # a null key comes first, as in a sort


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in random order: a range-partitioned sort by hash."""
    return df.orderBy(sample_hash(key, seed), _q(key))


def shuffled_positions(df: DataFrame, key: str, seed: int = 42, digits: int = 4) -> DataFrame:
    """All rows with their ``position`` (from 1) in the random order, for an order that is written or cut by position.

    Rows are counted per leading digits of the hash; the running sum over these cells, 65,536 with four digits,
    says where each cell begins. Within a cell rows are ranked, so no task sorts more than a cell.
    """
    marked = df.withColumn("_hash", sample_hash(key, seed)).withColumn("_cell", F.left("_hash", F.lit(digits)))
    begins = marked.groupBy("_cell").agg(F.count("*").alias("_n")).select(
        "_cell", (F.sum("_n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_begin")
    )
    place = F.row_number().over(Window.partitionBy("_cell").orderBy("_hash", _q(key)))
    return marked.join(begins, "_cell").withColumn("position", F.col("_begin") + place).select("position", *map(_q, df.columns))


def allocation(counts: DataFrame, n: int, min_per_stratum: int = 1) -> DataFrame:
    """Proportional allocation over a table of (stratum, available).

    Truncated shares, raised to the minimum. Rows still missing go one each to the largest
    allocations. Rows too many are taken from the smallest allocations upward, never below the
    minimum. The null stratum counts in the total and gets nothing. Ties go by name.
    """
    return _allocate(counts, n, min_per_stratum).filter("stratum IS NOT NULL")


def _allocate(counts: DataFrame, n: int, min_per_stratum: int) -> DataFrame:
    """The allocation with the null stratum still there, at zero.

    The windows order the strata table, one row per stratum, and never the data.
    """
    _check_size(n)
    share = (F.col("available") / F.col("total") * n).cast("long")
    base = counts.select(
        "stratum", "available", F.sum("available").over(Window.partitionBy()).alias("total")
    ).withColumn(
        "base",
        F.when(F.col("stratum").isNotNull(), F.greatest(share, F.lit(min_per_stratum))),
    )
    spare = F.col("base") - min_per_stratum
    descending = Window.orderBy(F.desc("base"), "stratum")
    before = Window.orderBy("base", "stratum").rowsBetween(Window.unboundedPreceding, -1)
    ranked = base.select(
        "*",
        (n - F.sum("base").over(Window.partitionBy())).alias("rest"),
        F.row_number().over(descending).alias("place"),
        F.coalesce(F.sum(spare).over(before), F.lit(0)).alias("taken_before"),
    )
    rest = F.col("rest")
    taken = F.greatest(F.lit(0), F.least(spare, -rest - F.col("taken_before")))
    requested = (
        F.when(F.col("stratum").isNull(), F.lit(0))
        .when((rest > 0) & (F.col("place") <= rest), F.col("base") + 1)
        .when(rest < 0, F.col("base") - taken)
        .otherwise(F.col("base"))
    )
    return ranked.select(
        "stratum", "available", "total", requested.cast("long").alias("requested")
    ).withColumn("sampled", F.least("requested", "available"))


def strata_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per stratum, the null stratum included."""
    return df.groupBy(_q(column).alias("stratum")).agg(F.count("*").alias("available"))


def stratified_sample(
    df: DataFrame,
    n: int,
    column: str,
    key: str,
    seed: int = 42,
    min_per_stratum: int = 1,
) -> DataFrame:
    """Exactly the allocated number of random rows per stratum.

    A table of fewer than n rows is returned whole. Two passes: the first reads the stratum and
    the key only and counts rows per (stratum, hash cell); its result, one row per stratum, is
    joined to the data in the second.
    """
    _check_size(n)
    require_columns(df, [column, key])
    hashed = df.withColumn("_hash", sample_hash(key, seed))
    cells = hashed.groupBy(_q(column).alias("stratum"), _cell(F.col("_hash")).alias("cell")).agg(
        F.count("*").alias("n")
    )
    counts = cells.groupBy("stratum").agg(F.sum("n").alias("available"))
    plan = _allocate(counts, n, min_per_stratum).select(
        F.col("stratum").alias("_stratum"),
        F.col("sampled").alias("_sampled"),
        (F.col("total") < n).alias("_whole"),
    )
    upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("cell"))
    last = F.struct("cell", (F.col("_sampled") - F.col("upto") + F.col("n")).alias("left"))
    cuts = (
        cells.select("stratum", "cell", "n", upto.alias("upto"))
        .join(plan, F.col("stratum").eqNullSafe(F.col("_stratum")))
        .groupBy("_stratum", "_sampled", "_whole")
        .agg(F.min(F.when(F.col("upto") >= F.col("_sampled"), last)).alias("_last"))
        .filter("_whole OR _sampled > 0")
    )
    # Whole cells below the last one are kept as they are; only rows of the last cell are ranked.
    marked = hashed.withColumn("_cell", _cell(F.col("_hash"))).join(pinned_if_small(cuts), _q(column).eqNullSafe(F.col("_stratum")))
    kept = [_q(c) for c in df.columns]
    below = marked.filter("_whole OR _cell < _last.cell").select(*kept)
    in_cell = Window.partitionBy(_q(column)).orderBy("_hash", _q(key))
    ranked = marked.filter("NOT _whole AND _cell = _last.cell").withColumn("_rank", F.row_number().over(in_cell))
    return below.unionByName(ranked.filter("_rank <= _last.left").select(*kept))


def sampling_report(original: DataFrame, sample: DataFrame, column: str) -> DataFrame:
    """Per stratum: counts, percent of all rows in both tables, and the difference."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = strata_counts(df, column)
        total = counts.agg(F.sum("available").alias("total")).scalar()
        percent = round_even(F.col("available") / total * 100, 2)
        return counts.filter("stratum IS NOT NULL").select(
            "stratum", F.col("available").alias(f"{name}_count"), percent.alias(f"{name}_pct")
        )

    joined = shares(original, "original").join(shares(sample, "sample"), "stratum", "left")
    filled = joined.na.fill(0, ["sample_count"]).na.fill(0.0, ["sample_pct"])
    return filled.withColumn("difference_pct", F.col("sample_pct") - F.col("original_pct"))


def sampling_stats(
    original: DataFrame, sample: DataFrame, column: str, target: int
) -> DataFrame:
    """Sizes, ratio, whether the size is in the target range, and share differences."""
    report = sampling_report(original, sample, column).agg(
        F.max(F.abs("difference_pct")).alias("max_difference"),
        F.avg(F.abs("difference_pct")).alias("mean_difference"),
    )
    # The sizes come from the same grouped counts as the report, whose shuffle is then used again.
    rows, drawn = (
        strata_counts(df, column).agg(F.coalesce(F.sum("available"), F.lit(0)).alias("n")).scalar()
        for df in (original, sample)
    )
    low, high = TARGET_SAMPLE_RANGE
    return report.select(
        rows.alias("original_size"),
        drawn.alias("sample_size"),
        F.lit(target).cast("long").alias("target_size"),
        (drawn / F.nullif(rows, F.lit(0)) * 100).alias("sampling_ratio"),
        drawn.between(low, high).alias("within_target_range"),
        "max_difference",
        "mean_difference",
    )


def request_summary(
    df: DataFrame, n: int, column: str, min_per_stratum: int = 1
) -> DataFrame:
    """Per stratum: rows requested, sampled and available, and the share of the table."""
    plan = allocation(strata_counts(df, column), n, min_per_stratum).filter("sampled > 0")
    share = round_even(F.col("available") / F.col("total") * 100, 2)
    return plan.select("stratum", "requested", "sampled", "available", share.alias("percent"))
