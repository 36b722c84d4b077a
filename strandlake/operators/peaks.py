"""Enriched regions of the genome: counts in bins against what is expected there, in two levels."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import stored
from .intervals import merge_intervals

#: Bins of a contig that one task sums at once.
BLOCK = 4096


def bin_rates(reads: DataFrame, group: str, *, width: int = 200, around: int = 10, control: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """``group, contig, bin, n, bins, rate``: the reads that start in each bin that has any, and how many would be expected.

    The rate is the largest of the group's mean over the ``bins`` of its contigs (up to each one's
    last), of the mean of the bins around, and of the control's count scaled to the group. Sums over
    neighbours are made in blocks of bins; a block gets its neighbours' bins within reach of its edges.
    """
    at = F.floor(F.col("pos") / width).alias("bin")
    n = stored(reads.groupBy(group, "contig", at).agg(F.count("*").alias("n")), "bins")
    size = n.groupBy(group, "contig").agg((F.max("bin") + 1).alias("b"), F.sum("n").alias("s")).groupBy(group).agg((F.sum("s") / F.sum("b")).alias("mean"), F.sum("b").alias("bins"), F.sum("s").alias("reads"))
    own = F.floor(F.col("bin") / block)
    blocks = F.sequence(F.floor((F.col("bin") - around) / block), F.floor((F.col("bin") + around) / block))
    x = n.withColumn("own", own).withColumn("block", F.explode(blocks))
    near = Window.partitionBy(group, "contig", "block").orderBy("bin").rangeBetween(-around, around)
    x = x.withColumn("local", F.sum("n").over(near) / F.lit(2 * around + 1)).where("own = block").drop("own", "block").join(size, group)
    rate = F.greatest("mean", "local")
    if control is not None:
        c = control.groupBy("contig", at).agg(F.count("*").alias("c"))
        all_c = control.agg(F.count("*").alias("all_c"))
        x = x.join(c, ["contig", "bin"], "left").crossJoin(F.broadcast(all_c))  # one row
        scaled = F.coalesce(F.col("c"), F.lit(0)) * F.col("reads") / F.when(F.col("all_c") > 0, F.col("all_c"))
        rate = F.greatest(rate, scaled)
    return x.select(group, "contig", "bin", "n", "bins", rate.alias("rate"))


def poisson_tail(k: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """``P(X >= k)`` by the series from ``k`` on, which falls where ``k`` is over the rate; 1 elsewhere."""
    out = np.ones(len(k))
    at = np.flatnonzero(k > rate)
    n, lam = k[at].astype(float), rate[at]
    log_factorial = np.array([math.lgamma(x + 1) for x in n])
    term = np.exp(-lam + n * np.log(lam) - log_factorial)
    total = term.copy()
    live = np.ones(len(at), bool)
    while live.any():
        n = n + 1
        term = term * lam / n
        total += term
        live = term > total * 1e-16
    out[at] = np.minimum(1.0, total)
    return out


def with_tails(rates: DataFrame) -> DataFrame:
    """:func:`bin_rates` with ``p``, the chance of as many reads or more."""

    def run(batches):
        for batch in batches:
            yield batch.assign(p=poisson_tail(batch["n"].to_numpy(), batch["rate"].to_numpy()))

    kind = ", ".join(f"{c} {t}" for c, t in rates.dtypes)
    return rates.mapInPandas(run, f"{kind}, p double")


def false_discovery_cut(p: DataFrame, group: str, q: float) -> DataFrame:
    """``group, cut``: the largest ``p`` with ``p * bins <= q * rank`` (Benjamini and Hochberg); groups without one are left out.

    Ranks come from range partitions and their sizes, so no task sees all of a group.
    """
    x = p.groupBy(group, "bins", "p").agg(F.count("*").alias("m"))
    x = stored(x.repartitionByRange(group, "p").withColumn("_part", F.spark_partition_id()), "tails")
    before = F.sum("_m").over(Window.partitionBy(group).orderBy("_part")) - F.col("_m")
    sizes = x.groupBy("_part", group).agg(F.sum("m").alias("_m")).select("_part", group, before.alias("_before"))  # a row for each partition
    rank = F.sum("m").over(Window.partitionBy("_part", group).orderBy("p")) + F.col("_before")
    x = x.join(sizes, ["_part", group]).withColumn("rank", rank)
    return x.where(F.col("p") * F.col("bins") <= F.lit(q) * F.col("rank")).groupBy(group).agg(F.max("p").alias("cut"))


def call_peaks(
    reads: DataFrame, *, group: str = "antibody", width: int = 200, around: int = 10, q: float = 0.1, weak: float = 0.1, control: DataFrame | None = None, block: int = BLOCK
) -> DataFrame:
    """``group, kind, contig, f_start, f_end, n``: narrow and broad peaks and the bins in them.

    Narrow peaks are runs of strong bins, whose false discovery rate is at most ``q``. Broad
    peaks are runs of bins of which each is at least weak, by a chance of at most ``weak``, and one is strong.
    """
    p = stored(with_tails(bin_rates(reads, group, width=width, around=around, control=control, block=block)), "tails")
    x = p.join(false_discovery_cut(p, group, q), group).withColumn("strong", F.col("p") <= F.col("cut")).where(F.col("strong") | (F.col("p") <= weak))
    x = x.select(group, "contig", (F.col("bin") * width).alias("f_start"), ((F.col("bin") + 1) * width).alias("f_end"), "strong")
    narrow = merge_intervals(x.where("strong"), [group, "contig"]).withColumn("kind", F.lit("narrow"))
    broad = merge_intervals(x, [group, "contig"], any_of="strong").where("strong").withColumn("kind", F.lit("broad"))
    columns = [group, "kind", "contig", "f_start", "f_end", "n"]
    return narrow.select(columns).union(broad.select(columns))


def peak_set(peaks: DataFrame, group: str = "antibody") -> DataFrame:
    """Narrow and broad peaks of a group as one set of intervals."""
    return merge_intervals(peaks.select(group, "contig", "f_start", "f_end"), [group, "contig"])
