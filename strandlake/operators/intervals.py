"""Interval operators: overlap joins, merging, coverage and windows around starts.

Overlap is closed at both ends. The join is an equi-join on (contig, bin): each
interval is listed in every bin that it touches, a pair is kept only in the bin
where the later of the two starts, so no pair comes twice and no distinct is
needed. Long features use a coarser level of bins, so that one of them isn't
listed thousands of times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import stored
from .counting import ranked

BIN, COARSE, LONGEST = 5_000, 1_000_000, 20


def overlap_join(
    reads: DataFrame, features: DataFrame, *, start: str = "pos", end: str = "end_pos", f_start: str = "f_start", f_end: str = "f_end",
    contig: str = "contig", width: int = BIN,
) -> DataFrame:
    """Pairs of a read and a feature on the same contig that share a position.

    Columns of both sides but the features' contig; their names must differ
    otherwise. A side with a null position joins nothing.
    """
    level = F.when(F.col(f_end) - F.col(f_start) > LONGEST * width, COARSE).otherwise(width)
    at = lambda c, size: F.floor(F.col(c) / size)
    f = features.withColumnRenamed(contig, "_contig").withColumn("_level", level)
    f = f.withColumn("_f_bin", F.explode(F.sequence(at(f_start, F.col("_level")), at(f_end, F.col("_level")))))
    # reads are listed in the bins of both levels, so they are scanned and shuffled once
    bins = lambda size: F.transform(F.sequence(at(start, size), at(end, size)), lambda b: F.struct(F.lit(size).alias("level"), b.alias("bin")))
    r = reads.withColumn("_at", F.explode(F.concat(bins(width), bins(COARSE))))
    on = (r[contig] == F.col("_contig")) & (F.col("_at.level") == F.col("_level")) & (F.col("_at.bin") == F.col("_f_bin"))
    home = F.floor(F.greatest(F.col(start), F.col(f_start)) / F.col("_level"))
    pairs = r.join(f, on).where((F.col(end) >= F.col(f_start)) & (F.col(start) <= F.col(f_end)) & (F.col("_f_bin") == home))
    return pairs.drop("_at", "_level", "_f_bin", "_contig")


def overlaps_any(reads: DataFrame, features: DataFrame, key: str = "read_id", **options) -> DataFrame:
    """Keys of the reads that overlap at least one feature, each once."""
    return overlap_join(reads, features.select("contig", "f_start", "f_end"), **options).select(key).distinct()


def annotate(reads: DataFrame, features: DataFrame, key: str = "read_id", **options) -> DataFrame:
    """``(key, features)``: the sorted distinct names of the features that a read overlaps; only reads with any."""
    pairs = overlap_join(reads, features.select("contig", "f_start", "f_end", F.col("name").alias("_name")), **options)
    return pairs.groupBy(key).agg(F.array_sort(F.collect_set("_name")).alias("features"))


def annotate_tracks(reads: DataFrame, features: DataFrame, tracks: list[str], key: str = "read_id", **options) -> DataFrame:
    """One list of names for each track of ``features(track)``, null where a read has none: one overlap join for all."""
    pairs = overlap_join(reads, features.select("contig", "f_start", "f_end", F.col("name").alias("_name"), F.col("track").alias("_track")), **options)
    lists = [F.array_sort(F.collect_set(F.when(F.col("_track") == t, F.col("_name")))).alias(t) for t in tracks]
    found = pairs.groupBy(key).agg(*lists)
    return found.select(key, *[F.when(F.size(t) > 0, F.col(t)).alias(t) for t in tracks])


def merge_intervals(intervals: DataFrame, group: list[str], start: str = "f_start", end: str = "f_end", *, any_of: str | None = None) -> DataFrame:
    """Overlapping or touching intervals of a group as one: ``group, start, end, n``, and whether ``any_of`` holds for one of them.

    A segmented scan over range partitions: how far the intervals before a block of a group
    reach comes from the blocks' own ends, a row for each block, and so does
    the number of merged intervals before it. No task sees a whole group.
    """
    block = ["_part", *group]
    flag = [any_of] if any_of else []
    x = intervals.select(*group, start, end, *flag).repartitionByRange(*group, start, end).withColumn("_part", F.spark_partition_id())
    x = stored(x, "blocks")  # range bounds are sampled: planned again, the blocks might differ
    over = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    reach = x.groupBy(*block).agg(F.max(end).alias("_top")).select(*block, F.max("_top").over(over).alias("_before"))
    by = Window.partitionBy(*block).orderBy(start, end)
    so_far = F.greatest(F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1)), "_before")
    x = x.join(reach, block).withColumn("_reach", so_far).withColumn("_new", F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0))
    run = F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    # a block's own runs; its first may go on from the block before
    runs = x.withColumn("_run", run).groupBy(*block, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"), *[F.max(c).alias(c) for c in flag])
    runs = stored(runs, "runs")
    before = runs.groupBy(*block).agg(F.max("_run").alias("_new")).select(*block, F.coalesce(F.sum("_new").over(over), F.lit(0)).alias("_runs"))
    runs = runs.join(before, block).withColumn("_run", F.col("_run") + F.col("_runs"))
    return runs.groupBy(*group, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n").alias("n"), *[F.max(c).alias(c) for c in flag]).drop("_run")


def number_peaks(merged: DataFrame, group: str, start: str = "f_start", end: str = "f_end") -> DataFrame:
    """Merged intervals of a group with names ``group_Peak.n@contig:start:end`` in coordinate order."""
    placed = ranked(merged, ["contig", start, end], "_n", [group])
    n = (F.col("_n") + 1).cast("string")
    name = F.concat(F.col(group), F.lit("_Peak."), n, F.lit("@"), F.concat_ws(":", "contig", F.col(start).cast("string"), F.col(end).cast("string")))
    return placed.withColumn("name", name).drop("_n")


def coverage_runs(reads: DataFrame, *, start: str = "pos", end: str = "end_pos", block: int = 1_000_000) -> DataFrame:
    """Runs of equal depth over half-open intervals: ``contig, start, end, depth``, depth over 0.

    A sweep in two levels: blocks of the contig add up their deltas, their
    running sums (a row for each block) give every block its depth at the
    start, and the sweep within a block needs only the block's own events.
    """
    steps = reads.select("contig", F.col(start).alias("at"), F.lit(1).alias("d")).union(reads.select("contig", F.col(end), F.lit(-1)))
    steps = steps.groupBy("contig", "at").agg(F.sum("d").alias("d")).where("d <> 0").withColumn("block", F.floor(F.col("at") / block))
    over_blocks = Window.partitionBy("contig").orderBy("block")
    blocks = steps.groupBy("contig", "block").agg(F.sum("d").alias("sum"), F.min("at").alias("first"))
    blocks = blocks.select(
        "contig", "block", (F.sum("sum").over(over_blocks) - F.col("sum")).alias("before"), F.lead("first").over(over_blocks).alias("next_first")
    )
    within = Window.partitionBy("contig", "block").orderBy("at")
    runs = steps.join(blocks, ["contig", "block"]).select(
        "contig", F.col("at").alias("start"),
        F.coalesce(F.lead("at").over(within), "next_first").alias("end"),
        (F.sum("d").over(within) + F.col("before")).alias("depth"),
    )
    return runs.where("depth > 0")


def start_windows(features: DataFrame, reach: int = 1000) -> DataFrame:
    """Windows of ``reach`` around the strand-aware start of each feature, ``tss`` its position."""
    tss = F.when(F.col("strand") == "-", F.col("f_end")).otherwise(F.col("f_start"))
    return features.withColumn("tss", tss).withColumn("f_start", F.col("tss") - reach).withColumn("f_end", F.col("tss") + reach - 1)


def start_enrichment(reads: DataFrame, features: DataFrame, molecule: list[str], *, group: list[str] | None = None, reach: int = 1000, bin: int = 100, start: str = "pos", end: str = "end_pos") -> DataFrame:
    """Enrichment of each feature's start: ``name, score``, for each value of the columns ``group`` if there are any.

    Depth over the window's 2 * reach positions from molecules counted once;
    sums over sliding bins; score = highest bin over the mean of the first and
    the last, or where that is 0 over the smallest positive one, else 1.
    """
    group = group or []
    key = [*group, "_name"]
    windows = start_windows(features, reach).select("contig", "f_start", "f_end", F.col("name").alias("_name"))
    once = reads.groupBy(*dict.fromkeys([*group, *molecule])).agg(F.max(end).alias(end))
    pairs = overlap_join(once, windows, start=start, end=end)
    lo = F.greatest(F.col(start) - F.col("f_start"), F.lit(0))
    hi = F.least(F.col(end) - F.col("f_start"), F.lit(2 * reach))
    spans = pairs.select(*key, lo.alias("lo"), hi.alias("hi")).where("lo < hi")
    # the bin that begins at i covers a length of the span that is linear between four places where its slope changes
    hit = spans.groupBy(*key, "lo", "hi").agg(F.count("*").alias("n"))
    turns = [(F.col("lo") - bin, F.col("n")), (F.col("lo"), -F.col("n")), (F.col("hi") - bin, -F.col("n")), (F.col("hi"), F.col("n"))]
    turns = hit.select(*key, F.inline(F.array(*[F.struct(p.cast("long").alias("p"), c.alias("c")) for p, c in turns])))
    turns = turns.groupBy(*key, "p").agg(F.sum("c").alias("c"))  # at most a row for each place of the window
    by = Window.partitionBy(*key).orderBy("p")
    turns = turns.select(*key, "p", F.lead("p").over(by).alias("next"), F.sum("c").over(by).alias("slope"), F.sum(F.col("c") * F.col("p")).over(by).alias("base"))
    last = F.lit(2 * reach - bin - 1).cast("long")
    first, end_ = F.greatest("p", F.lit(0)), F.least(F.col("next") - 1, last)
    at = lambda i: F.when((i >= first) & (i <= end_), i * F.col("slope") - F.col("base"))
    # between two turns the largest value, and the smallest above 0, stands at an end or next to one
    values = F.array(at(first), at(first + 1), at(end_ - 1), at(end_))
    edge = F.coalesce(at(F.lit(0)), F.lit(0)) + F.coalesce(at(last), F.lit(0))
    bins = turns.select(*key, F.array_max(values).alias("top"), F.array_min(F.filter(values, lambda v: v > 0)).alias("least"), edge.alias("edge"))
    out = bins.groupBy(*key).agg(F.max("top").alias("top"), F.min("least").alias("least"), (F.sum("edge") / 2).alias("edge")).where("top > 0")
    return out.select(*group, F.col("_name").alias("name"), (F.col("top") / F.when(F.col("edge") > 0, F.col("edge")).otherwise(F.coalesce("least", F.lit(1)))).alias("score"))
