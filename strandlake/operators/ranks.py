"""Exact order statistics of large groups, by refining histograms.

Equal values are counted first, which combines before the shuffle. The element of a
rank lies in one bin of a histogram of its group; that bin is cut into bins again,
until it holds few enough different values to be sorted in one task. So no task ever holds
or sorts a whole group, whatever the group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import drop_stored, stored

#: Bins of a histogram; different values that one task sorts.
BINS, FEW = 4096, 1 << 16


def at_ranks(weights: DataFrame, wanted: DataFrame, group: list[str], *, few: int = FEW, bins: int = BINS) -> DataFrame:
    """``group, k, x``: the ``k``-th smallest value of each group, from 0, for the rows of ``wanted(group, k)``.

    ``weights(group, x, n)``: the different finite values of each group and how often they stand there.
    ``few`` and ``bins`` bound what one task sorts; ranks beyond a group's size have no row.
    """
    whole = weights.groupBy(*group).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("d"))
    open_ = wanted.select(*group, "k").distinct().join(whole, group).withColumn("before", F.lit(0).cast("long"))
    cell = [*group, "lo", "hi", "before"]
    inside = lambda cells: weights.join(cells.select(*cell).distinct(), group).where(F.col("x").between(F.col("lo"), F.col("hi")))
    open_ = stored(open_, "ranks")
    while not open_.where(F.col("d") > few).isEmpty():
        large = open_.where(F.col("d") > few)
        at = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
        h = inside(large).groupBy(*cell, at.alias("bin")).agg(F.sum("n").alias("n"), F.count("*").alias("d"), F.min("x").alias("x0"), F.max("x").alias("x1"))
        start = F.col("before") + F.sum("n").over(Window.partitionBy(*cell).orderBy("bin")) - F.col("n")  # as many rows as bins
        h = h.select(*cell, start.alias("start"), "n", F.col("d").alias("_d"), "x0", "x1")
        hit = large.drop("d").join(h, cell).where((F.col("k") >= F.col("start")) & (F.col("k") < F.col("start") + F.col("n")))
        hit = hit.select(*group, "k", F.col("x0").alias("lo"), F.col("x1").alias("hi"), F.col("_d").alias("d"), F.col("start").alias("before"))
        before, open_ = open_, stored(open_.where(F.col("d") <= few).unionByName(hit), "ranks")
        drop_stored(before)
    start = F.col("before") + F.sum("n").over(Window.partitionBy(*cell).orderBy("x")) - F.col("n")  # few rows
    x = inside(open_).withColumn("start", start).select(*cell, "start", "n", "x")
    return open_.select(*cell, "k").join(x, cell).where((F.col("k") >= F.col("start")) & (F.col("k") < F.col("start") + F.col("n"))).select(*group, "k", "x")


def quantiles(df: DataFrame, group: list[str], value: str | Column, shares: list[float], *, element: bool = False, few: int = FEW, bins: int = BINS) -> DataFrame:
    """``group, n, q``: an array of each group's quantiles, in the order of ``shares``.

    Between the two elements around ``share * (n - 1)``, or with ``element`` the
    element ``int(share * n)``. Null values don't count; a group of nothing else has no row.
    """
    group = group or ["_all"]
    if group == ["_all"]:
        df = df.withColumn("_all", F.lit(0))
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    weights = stored(df.select(*group, x.alias("x")).where("x IS NOT NULL").groupBy(*group, "x").agg(F.count("*").alias("n")), "weights")
    size = weights.groupBy(*group).agg(F.sum("n").alias("n"))
    place = lambda s: F.least(F.floor(F.lit(s) * F.col("n")), F.col("n") - 1).cast("double") if element else F.lit(s) * (F.col("n") - 1)
    at = F.posexplode(F.array(*[place(s) for s in shares])).alias("i", "at")
    targets = size.select(*group, "n", at).withColumns({"low": F.floor("at"), "high": F.ceil("at")})
    wanted = targets.select(*group, F.col("low").alias("k")).union(targets.select(*group, "high"))
    found = at_ranks(weights, wanted, group, few=few, bins=bins)
    side = lambda c: found.select(*group, F.col("k").alias(c), F.col("x").alias(f"x_{c}"))
    both = targets.join(side("low"), [*group, "low"]).join(side("high"), [*group, "high"])
    q = F.col("x_low") + (F.col("x_high") - F.col("x_low")) * (F.col("at") - F.col("low"))
    out = both.groupBy(*group, "n").agg(F.sort_array(F.collect_list(F.struct("i", q.alias("q")))).alias("q"))  # as many as shares
    return out.select(*[c for c in group if c != "_all"], "n", F.col("q.q").alias("q"))
