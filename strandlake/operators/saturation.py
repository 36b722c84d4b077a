"""Saturation: what a library would show at fewer reads, and how far it could go."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import uniform

STEPS = 76


def fraction_step(p: Column, steps: int = STEPS) -> Column:
    """The first of the fractions 1/steps … 1 at which a read with draw ``p`` is in the sample."""
    return F.least(F.floor(p * steps) + 1, F.lit(steps)).cast("int")


def saturation_curve(reads: DataFrame, group: list[str], molecule: list[str], *, key: str = "read_id", decoded: Column | None = None, aligned: Column | None = None, steps: int = STEPS) -> DataFrame:
    """``group, step, reads, decoded_reads, aligned_reads, umi``, cumulative over nested samples.

    A molecule is in the sample of fraction f if its lowest draw is below f, so
    one aggregation of minima, bucketed by first step and summed up, gives all
    fractions without repeating a read.
    """
    decoded = F.lit(True) if decoded is None else decoded
    aligned = F.lit(True) if aligned is None else aligned
    x = reads.withColumns({"_step": fraction_step(uniform(F.col(key)), steps), "_d": decoded, "_a": aligned})
    by_read = x.groupBy(*group, F.col("_step").alias("step")).agg(
        F.count("*").alias("reads"), F.count_if("_d").alias("decoded_reads"), F.count_if(F.col("_d") & F.col("_a")).alias("aligned_reads")
    )
    first = x.where(F.col("_d") & F.col("_a")).groupBy(*group, *molecule).agg(F.min("_step").alias("step"))
    by_molecule = first.groupBy(*group, "step").agg(F.count("*").alias("umi"))
    grid = reads.select(*group).distinct().withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    both = grid.join(by_read, [*group, "step"], "left").join(by_molecule, [*group, "step"], "left")
    upto = Window.partitionBy(*group).orderBy("step")
    return both.select(*group, "step", *[F.sum(F.coalesce(c, F.lit(0))).over(upto).cast("long").alias(c) for c in ("reads", "decoded_reads", "aligned_reads", "umi")])


def background_molecules(reads: DataFrame, group: list[str], cell: str, molecule: list[str], *, key: str = "read_id", share: float = 5e-5, steps: int = STEPS) -> DataFrame:
    """Molecules in cells of at most ``1 + int(share * total)`` of them, at each fraction."""
    first = reads.withColumn("_s", fraction_step(uniform(F.col(key)), steps)).groupBy(*group, cell, *molecule).agg(F.min("_s").alias("step"))
    new = first.groupBy(*group, cell, "step").agg(F.count("*").alias("new"))
    upto = Window.partitionBy(*group, cell).orderBy("step")
    # a cell's count holds from one of its steps to the next
    spans = new.select(*group, cell, "step", F.sum("new").over(upto).alias("n"), F.lead("step", 1, steps + 1).over(upto).alias("next"))
    spans = spans.groupBy(*group, "n", "step", "next").agg(F.count("*").alias("cells"))
    at = spans.select(*group, "n", "cells", F.explode(F.sequence(F.col("step"), F.col("next") - 1)).alias("step"))
    by = at.groupBy(*group, "step", "n").agg(F.sum("cells").alias("cells"))
    total = F.sum(F.col("n") * F.col("cells")).over(Window.partitionBy(*group, "step"))
    limit = 1 + F.floor(F.lit(share) * F.col("total"))
    out = by.withColumn("total", total)
    return out.groupBy(*group, "step").agg(F.max("total").alias("umi"), F.coalesce(F.sum(F.when(F.col("n") <= limit, F.col("n") * F.col("cells"))), F.lit(0)).alias("background_umi"))


def _logistic(x, top, rate, mid):
    return top / (1 + np.exp(-rate * (x - mid)))


def fit_saturation(curve: DataFrame, group: list[str], *, reads: str = "reads", umi: str = "umi", rounds: int = 200) -> DataFrame:
    """A logistic of the umi count in ln(reads) for each group: ``group, top, rate, mid, rmse``.

    A group has one row for each fraction, so it is a few dozen rows.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in curve.select(*group).schema)

    def fit(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[(rows[reads] > 0) & (rows[umi] > 0)]
        x, y = np.log(rows[reads].to_numpy(float)), rows[umi].to_numpy(float)
        if len(x) < 4:
            return pd.DataFrame([[*key, None, None, None, None]])
        scale = y.max()
        y = y / scale
        p = np.array([1.5, 1.0, float(np.median(x))])
        damp = 1e-2
        loss = lambda q: float(np.square(_logistic(x, *q) - y).sum())
        for _ in range(rounds):
            f = _logistic(x, *p)
            e = f / p[0]
            jac = np.column_stack([e, f * (1 - e) * (x - p[2]), -f * (1 - e) * p[1]])
            a = jac.T @ jac
            q = p - np.linalg.solve(a + damp * np.diag(np.diag(a) + 1e-12), jac.T @ (f - y))
            if q[0] > 0 and loss(q) < loss(p):
                p, damp = q, max(damp / 3, 1e-9)
            else:
                damp = min(damp * 4, 1e9)
        return pd.DataFrame([[*key, p[0] * scale, p[1], p[2], scale * (loss(p) / len(x)) ** 0.5]])

    return curve.groupBy(*group).applyInPandas(fit, f"{kinds}, top double, rate double, mid double, rmse double")


def library_size(curve: DataFrame, group: list[str], *, least: float = 0.05, reads: str = "reads", umi: str = "umi") -> DataFrame:
    """The first point at which a further read brings less than ``least`` molecules, else the last."""
    by = Window.partitionBy(*group).orderBy("step")
    slope = (F.col(umi) - F.lag(umi).over(by)) / (F.col(reads) - F.lag(reads).over(by))
    x = curve.withColumn("_slope", slope)
    at = x.groupBy(*group).agg(F.coalesce(F.min(F.when(F.col("_slope") < least, F.col("step"))), F.max("step")).alias("step"))
    return at.join(curve.select(*group, "step", reads, umi), [*group, "step"])


def library_efficiency(curve: DataFrame, group: list[str]) -> DataFrame:
    """Efficiencies of each group in per cent at all its reads, and the highest umi for a read along the curve.

    Barcode efficiency: decoded of all reads; molecular: umis of the decoded;
    efficiency: umis of the aligned. A share of no reads is 0.
    """
    top = curve.where("reads > 0").groupBy(*group).agg(F.max(F.col("umi") / F.col("reads")).alias("efficiency_factor"), F.max("step").alias("step"))
    share = lambda a, b: F.when(F.col(b) > 0, 100.0 * F.col(a) / F.col(b)).otherwise(0.0)
    return curve.join(top, [*group, "step"]).select(
        *group, F.col("reads").alias("sequenced_reads"), "decoded_reads", "aligned_reads", "umi", share("decoded_reads", "reads").alias("barcode_efficiency"),
        share("umi", "decoded_reads").alias("molecular_efficiency"), share("umi", "aligned_reads").alias("efficiency"), "efficiency_factor",
    )


def extrapolate(fit: DataFrame, group: list[str], *, points: int = 60, low: float = 1e5, high: float = 3.5e9) -> DataFrame:
    """The fitted curve from ``low`` to ``high`` reads, evenly in ln(reads)."""
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    x = F.lit(float(np.log(low))) + F.col("i") * F.lit(float(np.log(high / low) / (points - 1)))
    y = F.col("top") / (1 + F.exp(-F.col("rate") * (F.col("x") - F.col("mid"))))
    return fit.withColumn("i", i).withColumn("x", x).select(*group, F.col("i").alias("step"), F.exp("x").alias("reads"), y.alias("umi"))
