"""Quality tables: tags, alignments, duplicates, antibodies, libraries and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import percentage, safe_div
from ..functions.shared import stored
from .ranks import quantiles


def as_metrics(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Wide to long: ``group, metric, value`` with values as doubles."""
    return df.select(*group, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(group, columns, "metric", "value")


def tag_coverage(reads: DataFrame, tag: str, pattern: str, *, min_mapq: int = 30) -> DataFrame:
    """Reads that pass, carry the tag and match the pattern from the start, with their share of the passing ones."""
    ok = F.col("is_mapped") & (F.col("mapq") >= min_mapq)
    has = F.col(tag).isNotNull()
    hit = has & F.col(tag).rlike(f"^(?:{pattern})")
    counts = reads.agg(
        F.count("*").alias("total"), F.count_if(ok).alias("passing"), F.count_if(ok & ~has).alias("untagged"), F.count_if(ok & has).alias("tagged"),
        F.count_if(ok & hit).alias("matching"), F.count_if(ok & has & ~hit).alias("not_matching"),
    )
    names = ["total", "passing", "untagged", "tagged", "matching", "not_matching"]
    long = counts.select(*[F.col(c).cast("long").alias(c) for c in names], F.col("passing").alias("_q")).unpivot(["_q"], names, "metric", "reads")
    return long.select("metric", "reads", safe_div(F.col("reads"), F.col("_q")).alias("share"))


def alignment_qc(reads: DataFrame, group: list[str], barcode: str, *, cells_at: tuple[int, ...] = (5000, 20000)) -> DataFrame:
    """``group, metric, value``: reads and barcodes by mapping, cells with enough reads, mean reads of a barcode."""
    m, q = F.col("is_mapped"), F.col("is_mapped") & (F.col("mapq") >= 20)
    per = reads.groupBy(*group, barcode).agg(
        F.count("*").alias("n"), F.count_if(m).alias("mapped"), F.count_if(q).alias("q20"), F.count_if(m & (F.col("mapq") == 0)).alias("mq0")
    )
    t = per.groupBy(*group).agg(
        F.sum("mapped").alias("mapped"), F.sum(F.col("n") - F.col("mapped")).alias("unmapped"), F.sum("mq0").alias("mapq0"), F.sum("q20").alias("mapped_q20"),
        F.count("*").alias("barcodes"), F.count_if(F.col("mapped") > 0).alias("barcodes_aligned"), F.count_if(F.col("q20") > 0).alias("barcodes_q20"),
        *[F.count_if(F.col("q20") >= k).alias(f"cells_{k}") for k in cells_at], F.avg("n").alias("mean_reads"),
    )
    return as_metrics(t, group, [c for c in t.columns if c not in group])


def duplication(reads: DataFrame, group: list[str], molecule: list[str]) -> DataFrame:
    """``group, aligned, duplicate, dup_pct`` over molecules, wherever their reads stand."""
    per = reads.groupBy(*group, *molecule).agg(F.count("*").alias("n"))
    t = per.groupBy(*group).agg(F.sum("n").alias("aligned"), F.sum(F.col("n") - 1).alias("duplicate"))
    return t.withColumn("dup_pct", 100 * F.col("duplicate") / F.col("aligned"))


def top_by_group(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The most frequent value of each group, ties by value: ``group, value, n``."""
    n = df.groupBy(*group, value).agg(F.count("*").alias("n"))
    first = Window.partitionBy(*group).orderBy(F.desc("n"), value)
    return n.withColumn("_i", F.row_number().over(first)).where("_i = 1").drop("_i")


def shares(df: DataFrame, group: list[str], column: str) -> DataFrame:
    n = df.groupBy(*group, column).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*group)))


def normalised_sizes(histogram: DataFrame, group: list[str], size: str, n: str = "n") -> DataFrame:
    t = histogram.groupBy(*group, size).agg(F.sum(n).alias("n"))
    return t.withColumn("density", F.col("n") / F.sum("n").over(Window.partitionBy(*group)))


PLACES = ("in_peak", "off_target", "in_enhancer", "in_promoter", "in_genebody")


def cell_qc(reads: DataFrame, group: list[str], *, molecule: tuple[str, ...] = ("contig", "pos", "umi"), min_mapq: int = 30) -> DataFrame:
    """``group, filter, target, type, count`` for each cell.

    ``reads`` has flags ``in_peak, enhancer, promoter, genebody``. Reads and
    molecules are counted apart for mapping qualities that are retained and
    those that are filtered out; a molecule counts once in each. A promoter hit
    is no enhancer hit.
    """
    mapped = reads.where("is_mapped")
    flags = {
        "in_peak": F.col("in_peak"), "off_target": ~F.col("in_peak"), "in_enhancer": F.col("enhancer") & ~F.col("promoter"),
        "in_promoter": F.col("promoter"), "in_genebody": F.col("genebody"),
    }
    x = mapped.select(*group, *molecule, F.when(F.col("mapq") >= min_mapq, "retained").otherwise("filtered").alias("filter"), *[c.alias(n) for n, c in flags.items()])
    per = x.groupBy(*group, *molecule, "filter").agg(F.count("*").alias("n"), *[F.max(n).alias(n) for n in flags], *[F.count_if(n).alias(f"r_{n}") for n in flags])
    t = per.groupBy(*group, "filter").agg(
        *[F.sum(f"r_{n}").alias(f"{n}__reads") for n in flags], *[F.count_if(F.col(n) & F.col("umi").isNotNull()).alias(f"{n}__umi") for n in flags]
    )
    names = [f"{n}__{k}" for n in flags for k in ("reads", "umi")]
    long = t.unpivot([*group, "filter"], names, "_name", "count").where("count > 0")
    long = long.select(*group, "filter", F.split_part("_name", F.lit("__"), F.lit(1)).alias("target"), F.split_part("_name", F.lit("__"), F.lit(2)).alias("type"), "count")
    other = reads.groupBy(*group).agg(F.count_if(~F.col("is_mapped")).alias("unmapped"), F.count_if(F.col("is_mapped") & F.col("umi").isNull()).alias("no_umi"))
    other = other.unpivot(group, ["unmapped", "no_umi"], "target", "count").where("count > 0")
    return long.unionByName(other.select(*group, F.lit("all").alias("filter"), "target", F.lit("reads").alias("type"), "count"))


def widen(long: DataFrame, group: list[str], names: list[str], value: str = "count", values: list[str] | None = None) -> DataFrame:
    """Long to wide: a column for each combination of ``names``, 0 where a row lacks it."""
    name = F.concat_ws("_", *names)
    wide = long.withColumn("_name", name).groupBy(*group).pivot("_name", values).agg(F.sum(value))
    return wide.fillna(0)


#: The fifteen measures of a cell over the columns of a widened :func:`cell_qc` table, as SQL.
_GOOD = {k: f"(retained_in_peak_{k} + retained_off_target_{k})" for k in ("reads", "umi")}
_POOR = {k: f"(filtered_in_peak_{k} + filtered_off_target_{k})" for k in ("reads", "umi")}
MEASURES = {
    "total_reads": f"{_GOOD['reads']} + {_POOR['reads']} + all_unmapped_reads", "total_umi": f"{_GOOD['umi']} + {_POOR['umi']}",
    "HQ_reads": _GOOD["reads"], "HQ_umi": _GOOD["umi"], "reads_in_peak": "retained_in_peak_reads", "umi_in_peak": "retained_in_peak_umi",
    "estimated_unmapped_umi": f"CASE WHEN {_GOOD['reads']} > 0 THEN {_GOOD['umi']} * 1.0 / {_GOOD['reads']} * all_unmapped_reads ELSE -1.0 END",
    **{f"{k}_in_{t}": f"retained_in_{t}_{k}" for t in ("enhancer", "promoter", "genebody") for k in ("reads", "umi")},
    **{f"{k}_in_CRE": f"retained_in_enhancer_{k} + retained_in_promoter_{k}" for k in ("reads", "umi")},
}
#: The eleven ratios of measures; a ratio over 0 is 0.
RATIOS = {
    "read_peak_rate": ("reads_in_peak", "HQ_reads"), "umi_peak_rate": ("umi_in_peak", "HQ_umi"),
    "read_enhancer_rate": ("reads_in_enhancer", "HQ_reads"), "umi_enhancer_rate": ("umi_in_enhancer", "HQ_umi"),
    "read_promoter_rate": ("reads_in_promoter", "HQ_reads"), "umi_promoter_rate": ("umi_in_promoter", "HQ_umi"),
    "read_CRE_rate": ("reads_in_CRE", "HQ_reads"), "umi_CRE_rate": ("umi_in_CRE", "HQ_umi"),
    "read_genic_rate": ("reads_in_genebody", "HQ_reads"), "umi_genic_rate": ("umi_in_genebody", "HQ_umi"),
    "enhancer_promoter_ratio": ("umi_in_enhancer", "umi_in_promoter"),
}


def sample_qc(cells: DataFrame, group: list[str], *, least: int = 750) -> DataFrame:
    """Distribution of the 15 measures and 11 ratios over the cells of a sample: a row for each group and measure.

    ``cells`` is a widened :func:`cell_qc` table. ``total`` and ``n_cell`` are
    over all cells (a ratio's total is the ratio of totals); all else is over
    the well covered ones, of ``least`` molecules or more. Quantiles are the
    element ``int(q * n)`` of the sorted values, found without sorting a sample's
    cells in one task. ``std2`` is the variance.
    """
    x = cells.select(*group, *[F.expr(e).cast("double").alias(n) for n, e in MEASURES.items()])
    row = lambda name, value, a, b: F.struct(F.lit(name).alias("measure"), value.alias("value"), a.alias("_a"), b.cast("double").alias("_b"))
    rows = [row(n, F.col(n), F.col(n), F.lit(None)) for n in MEASURES] + [row(n, safe_div(F.col(a), F.col(b)), F.col(a), F.col(b)) for n, (a, b) in RATIOS.items()]
    x = stored(x.select(*group, (F.col("total_umi") >= least).alias("_covered"), F.inline(F.array(*rows))), "measures")
    v = F.when(F.col("_covered"), F.col("value"))
    total = F.when(F.count("_b") == 0, F.sum("_a")).otherwise(safe_div(F.sum("_a"), F.sum("_b")))
    out = x.groupBy(*group, "measure").agg(
        total.alias("total"), F.count("*").alias("n_cell"), F.count_if("_covered").alias("n_well_covered"), F.coalesce(F.sum(v), F.lit(0.0)).alias("well_covered_total"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.var_pop(v).alias("std2"), F.stddev_pop(v).alias("std"),
    )
    q = quantiles(x.where("_covered"), [*group, "measure"], "value", [0.25, 0.5, 0.75], element=True).drop("n")
    out = out.join(q, [*group, "measure"], "left")
    names = ("total", "n_cell", "n_well_covered", "well_covered_total", "min", "q25", "median", "q75", "max", "mean", "std2", "std")
    at = {n: F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q25", "median", "q75"))}
    return out.select(*group, "measure", *[at.get(n, F.col(n)) for n in names])


def effective_range(cells: DataFrame, group: list[str], reads: str = "reads") -> DataFrame:
    """``group, low, high, min_reads``: P5 of the positive counts, P95 of those above it, and one per cent of the way up."""
    positive = cells.where(F.col(reads) > 0)
    low = quantiles(positive, group, reads, [0.05]).select(*group, F.col("q")[0].alias("low"))
    rest = positive.join(low, group).where(F.col(reads) > F.col("low"))
    high = quantiles(rest, group, reads, [0.95]).select(*group, F.col("q")[0].alias("high"))
    return low.join(high, group).withColumn("min_reads", F.col("low") + 0.01 * (F.col("high") - F.col("low")))


def paired_modal_cells(tables: dict[str, DataFrame], key: str = "cell_id") -> DataFrame:
    """Cells that every table has, with each table's counts under its name."""
    named = [t.select(key, F.col("count").alias(name)) for name, t in tables.items()]
    return reduce(lambda a, b: a.join(b, key), named)


def restrict_counts(counts: DataFrame, cells: DataFrame, *, key: str = "cell") -> DataFrame:
    """Counts of the cells that ``cells`` holds (one row each), with its columns."""
    return counts.join(cells, key)


def library_normalised(cells: DataFrame, library: str, columns: list[str]) -> DataFrame:
    """Totals of each library and each cell's share of them, ``_total`` and ``_norm``."""
    by = Window.partitionBy(library)
    out = cells.withColumns({f"{c}_total": F.sum(c).over(by) for c in columns})
    return out.withColumns({f"{c}_norm": safe_div(F.col(c), F.col(f"{c}_total")) for c in columns})


def covered_cells(cells: DataFrame, group: list[str], *, rna: str = "rna_umis", dna: str = "dna_umis", least: int = 500) -> DataFrame:
    """Cells with enough umis in each assay and in both, long."""
    r, d = F.col(rna) >= least, F.col(dna) >= least
    t = cells.groupBy(*group).agg(F.count_if(r).alias("rna"), F.count_if(d).alias("dna"), F.count_if(r & d).alias("both"))
    return t.unpivot(group, ["rna", "dna", "both"], "assay", "cells")


def contamination(reads: DataFrame, group: list[str], found: str, expected: str) -> DataFrame:
    """Reads of each group whose type isn't the expected one."""
    t = reads.groupBy(*group).agg(F.count("*").alias("reads"), F.count_if(F.col(found) != F.col(expected)).alias("other"))
    return t.withColumn("contamination", percentage(F.col("other") / F.col("reads")))


def sequencing_report(types: DataFrame, duplicates: DataFrame, group: list[str], *, paired: Column | None = None) -> DataFrame:
    """Reads, valid, type match, aligned and duplicates with percentages.

    ``types`` has ``reads, valid, match`` and ``duplicates`` has ``aligned,
    duplicate`` for each group; counts of pairs are halved where ``paired``.
    """
    half = F.when(paired, 2).otherwise(1) if paired is not None else F.lit(1)
    d = duplicates.withColumns({c: F.col(c) / half for c in ("aligned", "duplicate")}) if paired is not None else duplicates
    x = types.join(d.select(*group, "aligned", "duplicate"), group)
    share = lambda a, b: percentage(safe_div(F.col(a), F.col(b)))
    return x.withColumns({"pct_valid": share("valid", "reads"), "pct_match": share("match", "valid"), "pct_aligned": share("aligned", "valid"), "pct_duplicate": share("duplicate", "aligned")})


def balance(report: DataFrame, row: str, column: str, value: str, values: list[str]) -> DataFrame:
    """Each sample's share of a library's reads, samples as columns."""
    x = report.groupBy(row).pivot(column, values).agg(F.sum(value)).fillna(0)
    total = sum((F.col(c) for c in values), F.lit(0))
    return x.select(row, *[percentage(safe_div(F.col(c), total)).alias(c) for c in values])


def region_rates(reads: DataFrame, exonic: Column, genic: Column, group: list[str]) -> DataFrame:
    """Mapping, intragenic, exonic, intronic and intergenic rates."""
    m = F.col("is_mapped")
    t = reads.groupBy(*group).agg(F.count("*").alias("reads"), F.count_if(m).alias("mapped"), F.count_if(m & genic).alias("genic"), F.count_if(m & exonic).alias("exonic"))
    rate = lambda a, b: safe_div(a, F.col(b))
    return t.select(
        *group, rate(F.col("mapped"), "reads").alias("mapping_rate"), rate(F.col("genic"), "mapped").alias("intragenic_rate"),
        rate(F.col("exonic"), "mapped").alias("exonic_rate"), rate(F.col("mapped") - F.col("genic"), "mapped").alias("intergenic_rate"),
    )
