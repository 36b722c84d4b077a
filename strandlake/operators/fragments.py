"""Fragments, gap sessions and the cells chosen by their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import quantiles

GAP = 300


def gap_sessions(df: DataFrame, group: list[str], at: str, *, gap: int = GAP, into: str = "session") -> DataFrame:
    """Number the runs of a group between whose neighbours there is no more than ``gap``."""
    by = Window.partitionBy(*group).orderBy(at)
    new = F.when(F.col(at) - F.lag(at).over(by) > gap, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn(into, F.sum("_new").over(by.rangeBetween(Window.unboundedPreceding, 0))).drop("_new")


def fragments(reads: DataFrame, group: list[str], *, at: str = "pos", length: str = "tlen", gap: int = GAP, default: int = 300) -> DataFrame:
    """Reads of a molecule within ``gap`` as one fragment: mean start, mean positive length, reads."""
    s = gap_sessions(reads, group, at, gap=gap)
    mean = F.avg(F.when(F.col(length) > 0, F.col(length)))
    out = s.groupBy(*group, "session").agg(F.floor(F.avg(at)).alias("start"), F.coalesce(F.floor(mean), F.lit(default)).cast("long").alias("length"), F.count("*").alias("n"))
    return out.withColumn("end", F.col("start") + F.col("length")).drop("session")


def size_histogram(frags: DataFrame, group: list[str]) -> DataFrame:
    return frags.groupBy(*group, "length").agg(F.count("*").alias("fragments"), F.sum("n").alias("reads"))


def mean_insert_histogram(frags: DataFrame, group: list[str], cell: str = "cell") -> DataFrame:
    """Cells by the whole part of their mean fragment length."""
    mean = frags.groupBy(*group, cell).agg(F.floor(F.avg("length")).alias("length"))
    return mean.groupBy(*group, "length").agg(F.count("*").alias("cells"))


def cell_filter(frags: DataFrame, *, cell: str = "cell", min_count: int = 0, min_frac: float = 0.0) -> DataFrame:
    """Umis and reads of each cell, and whether it reaches the least count and share of all."""
    t = frags.groupBy(cell).agg(F.count("*").alias("umis"), F.sum("n").alias("reads"))
    total = F.sum("umis").over(Window.partitionBy())
    t = t.withColumn("efficiency", F.col("umis") / F.col("reads"))
    return t.withColumn("kept", (F.col("umis") >= min_count) & (F.col("umis") >= F.lit(min_frac) * total))


def first_of_molecule(reads: DataFrame, group: list[str], *, at: str = "pos", tie: str = "read_id", gap: int = GAP) -> DataFrame:
    """The first read of each molecule's run of neighbours within ``gap``."""
    s = gap_sessions(reads, group, at, gap=gap)
    first = F.row_number().over(Window.partitionBy(*group, "session").orderBy(at, tie))
    return s.withColumn("_i", first).where("_i = 1").drop("_i", "session")


def split_cells(molecules: DataFrame, *, cell: str = "cell", key: tuple[str, ...] = ("contig", "pos", "umi"), files: int = 12, per_plate: int = 4000, quantile: float = 0.99) -> DataFrame:
    """Foreground and background cells: ``cell, n, class``.

    Of the ``files * per_plate / 12`` largest cells T is the quantile of the
    counts; foreground has at least T / 10, background at most a fifth of that,
    what lies between is in neither.
    """
    n = molecules.groupBy(cell).agg(F.count_distinct(*key).alias("n"))
    top = n.orderBy(F.desc("n"), cell).limit(files * per_plate // 12)
    cut = quantiles(top, [], "n", [quantile]).select((F.col("q")[0] * 0.1).alias("_cut"))
    both = n.crossJoin(F.broadcast(cut))  # one row
    kind = F.when(F.col("n") >= F.col("_cut"), "foreground").when(F.col("n") <= 0.2 * F.col("_cut"), "background")
    return both.withColumn("class", kind).where("class IS NOT NULL").drop("_cut")


def top_cells(cells: DataFrame, k: int, *, by: Column, within: list[str], tie: str = "cell", seed: int | None = None) -> DataFrame:
    """The ``k`` cells of each group with the largest value; ties by name, or with a ``seed`` at random, the same on every run."""
    chance = [] if seed is None else [F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(tie)))]
    i = F.row_number().over(Window.partitionBy(*within).orderBy(by.desc(), *chance, tie))
    return cells.withColumn("_i", i).where(F.col("_i") <= k).drop("_i")
