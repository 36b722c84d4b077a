"""Counts of molecules and reads for each feature and cell, and their matrix form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import UNKNOWN
from ..functions.shared import stored


def distinct_counts(annotated: DataFrame, counted: str, *, feature: str | Column = "feature", cell: str | Column = "cell") -> DataFrame:
    """Distinct values of ``counted`` for each feature and cell: ``feature, cell, n``.

    Two aggregations, both with map-side combining: the distinct triples, then
    their number. A cell's name ends at an at sign.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    rows = annotated.select(col(feature).alias("feature"), F.substring_index(col(cell), "@", 1).alias("cell"), F.col(counted).alias("_x"))
    rows = rows.where("feature IS NOT NULL AND _x IS NOT NULL").distinct()
    return rows.groupBy("feature", "cell").agg(F.count("*").alias("n"))


def feature_counts(pairs: DataFrame, name: str = "name") -> DataFrame:
    """Reads for each feature, a read counting for every feature that it overlaps."""
    return pairs.groupBy(F.col(name).alias("feature")).agg(F.count("*").alias("n"))


def cell_totals(counts: DataFrame) -> DataFrame:
    """``cell, molecule_count, feature_count`` over the rows of known cells."""
    known = counts.where(F.col("cell") != UNKNOWN)
    return known.groupBy("cell").agg(F.sum("n").alias("molecule_count"), F.count("*").alias("feature_count"))


def split_features(counts: DataFrame) -> DataFrame:
    """Rows of feature lists as rows of features: ``n`` counts in full, ``part`` by equal shares."""
    names = F.split("feature", ",")
    one = counts.select(F.explode(names).alias("feature"), "cell", "n", F.size(names).alias("k"))
    return one.groupBy("feature", "cell").agg(F.sum("n").alias("n"), F.sum(F.col("n") / F.col("k")).alias("part"))


def cell_metadata(totals: DataFrame, digest: DataFrame, *, on: str = "sample", missing: str = "NA") -> DataFrame:
    """Cells with the columns of their sample; ``NA`` where the digest lacks it."""
    out = totals.join(digest, on, "left")
    return out.fillna(missing, [c for c in digest.columns if c != on])


def ranked(df: DataFrame, order: list[str], into: str, within: list[str] | None = None) -> DataFrame:
    """``df`` with each row's place from 0 in the order of the columns, within its group.

    Rows are range partitioned by group and order; a partition's first place is
    the number of the group's rows in the partitions before it (a row for each
    partition and group), so no task sees all rows of a group. The partitioned
    rows are written once with their partition's number: range bounds are
    sampled and small partitions merged at run time, so a partition planned a
    second time for the sizes would not hold the same rows.
    """
    within = within or []
    x = stored(df.repartitionByRange(*within, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = x.groupBy("_part", *within).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*within).orderBy("_part")) - F.col("_n")
    sizes = sizes.select("_part", *within, before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part", *within).orderBy(*order)) - 1 + F.col("_before")
    joined = x.join(sizes, ["_part", *within])
    return joined.withColumn(into, place.cast("long")).select(*df.columns, into)


def dense_ids(counts: DataFrame, column: str) -> DataFrame:
    """``(column, id)`` with ids from 0 in the order of the names."""
    return ranked(counts.select(column).distinct(), [column], "id")


def matrix(counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(x, obs, var)``: entries ``(i, j, n)`` by cell and feature ids, and the names of both."""
    counts = stored(counts, "counts")  # three plans read them
    obs = dense_ids(counts, "cell").select(F.col("id").alias("i"), "cell")
    var = dense_ids(counts, "feature").select(F.col("id").alias("j"), "feature")
    return counts.join(obs, "cell").join(var, "feature").select("i", "j", "n"), obs, var


def prevalence(counts: DataFrame, *, min_cells: int = 1) -> DataFrame:
    """Cells for each feature and the feature's rank percentile by that, ties by name."""
    cells = counts.where("n >= 1").groupBy("feature").agg(F.count_distinct("cell").alias("cells"))
    total = cells.agg(F.count("*").alias("_total"))
    placed = ranked(cells, ["cells", "feature"], "_place").crossJoin(F.broadcast(total))  # one row
    return placed.withColumn("percentile", F.col("_place") / F.col("_total")).drop("_total", "_place").where(F.col("cells") >= min_cells)


def gene_share(counts: DataFrame, genes: list[str]) -> DataFrame:
    """Share of a cell's molecules that stand on the listed genes: ``cell, total, listed, share``."""
    listed = F.sum(F.when(F.col("feature").isin(genes), F.col("n")).otherwise(0))
    out = counts.groupBy("cell").agg(F.sum("n").alias("total"), listed.alias("listed"))
    return out.withColumn("share", F.col("listed") / F.col("total"))
