"""Queries over the read views: cells of several assays, reports by library, digests and layouts from files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import counting, fragments, matrix, qc
from ..sources import readers, writers
from .more_queries import (
    CELLQC_SQL, CELLREADS_SQL, FLAGS_SQL, MEASURES_SQL, PAIRED_SQL, R6, TYPES_SQL, VALUES_SQL, WIDE, WIDE_SQL, _types_and_duplicates,
    cell_qc_table, cell_reads, paired_cells, scratch, written,
)
from .queries import SINGLE, Views, query, single_counts


@query("restricted_counts", "SELECT feature, s.cell, n, library, rna_reads, rna_umis, dna_reads, dna_umis FROM single s JOIN paired p ON s.cell = p.cell", SINGLE, PAIRED_SQL)
def restricted_counts(spark, sf):
    """Counts of the cells that all four tables hold, with their columns."""
    v = Views(spark, sf)
    return qc.restrict_counts(single_counts(v), paired_cells(v)).select("feature", "cell", "n", "library", "rna_reads", "rna_umis", "dna_reads", "dna_umis")


@query("covered_cells_by_sample", """SELECT library, sample, unnest(['rna', 'dna', 'both']) AS assay, unnest([r, d, b]) AS cells FROM (SELECT library, split_part(cell, ':', 2) AS sample, count(*) FILTER (rna_umis >= 400) AS r,
 count(*) FILTER (dna_umis >= 400) AS d, count(*) FILTER (rna_umis >= 400 AND dna_umis >= 400) AS b FROM paired GROUP BY 1, 2)""", PAIRED_SQL)  # fmt: skip
def covered_cells_by_sample(spark, sf):
    x = paired_cells(Views(spark, sf)).withColumn("sample", F.split_part("cell", F.lit(":"), F.lit(2)))
    return qc.covered_cells(x, ["library", "sample"], least=400)


@query("library_report", """SELECT library, reads, valid, match, aligned, duplicate, round_even(1000.0 * valid / reads, 0) / 10 AS pct_valid, round_even(1000.0 * match / valid, 0) / 10 AS pct_match,
 round_even(1000.0 * aligned / valid, 0) / 10 AS pct_aligned, round_even(1000.0 * duplicate / aligned, 0) / 10 AS pct_duplicate FROM (
 SELECT library, CAST(sum(reads) AS BIGINT) AS reads, CAST(sum(valid) AS BIGINT) AS valid, CAST(sum(match) AS BIGINT) AS match FROM types GROUP BY 1) JOIN (
 SELECT library, sum(aligned) / CASE WHEN library = 'LIB2' THEN 2 ELSE 1 END AS aligned, sum(duplicate) / CASE WHEN library = 'LIB2' THEN 2 ELSE 1 END AS duplicate FROM dups GROUP BY 1) USING (library)""", TYPES_SQL)  # fmt: skip
def library_report(spark, sf):
    """The report by library; the second library's alignments count pairs twice."""
    types, duplicates = _types_and_duplicates(spark, sf)
    total = lambda df, *cs: df.groupBy("library").agg(*[F.sum(c).alias(c) for c in cs])
    out = qc.sequencing_report(total(types, "reads", "valid", "match"), total(duplicates, "aligned", "duplicate"), ["library"], paired=F.col("library") == "LIB2")
    return out.withColumns({c: F.col(c).cast("double") for c in ("aligned", "duplicate")})


@query("top_cells_seeded", """SELECT library, cell, reads, umis FROM (SELECT *, row_number() OVER (PARTITION BY library ORDER BY floor(umis / 50) DESC, md5(concat('11:', cell)), cell) AS i FROM cell_reads) WHERE i <= 12""", CELLREADS_SQL)
def top_cells_seeded(spark, sf):
    """The largest cells of each library in steps of 50 umis, ties at random by a seed."""
    x = fragments.top_cells(cell_reads(Views(spark, sf)), 12, by=F.floor(F.col("umis") / 50), within=["library"], seed=11)
    return x.select("library", "cell", "reads", "umis")


@query("rna_cell_filter", """SELECT feature, cell, n, umis FROM (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS umis, count(*) OVER w AS features, sum(CASE WHEN feature IN ('G1', 'G8', 'G15', 'G22') THEN n ELSE 0 END) OVER w AS listed
 FROM single WINDOW w AS (PARTITION BY cell)) WHERE features >= 5 AND umis >= 20 AND umis <= 6400 AND listed * 1.0 / umis <= 0.02""", SINGLE)  # fmt: skip
def rna_cell_filter(spark, sf):
    """Cells by their umis, from both sides, and by the share of listed genes."""
    counts = written(single_counts(Views(spark, sf)), "counts")
    shares = counting.gene_share(counts, ["G1", "G8", "G15", "G22"])
    kept = matrix.cell_range_filter(counts, min_features=5, min_umis=20, max_umis=6400, shares=shares, max_share=0.02)
    return kept.select("feature", "cell", "n", "umis")


ASSAY_SQL = """assays AS (SELECT p.*, CASE WHEN s.name = 'SM4' THEN 'NA' ELSE s.antibody END AS antibody FROM paired p JOIN fx_samples s ON split_part(cell, ':', 2) = s.name)"""


def cells_of_assays(v: Views):
    """Cells with their assay; one sample stands for an assay of RNA alone."""
    antibody = F.when(F.col("name") == "SM4", "NA").otherwise(F.col("antibody"))
    return paired_cells(v).join(v.samples.select("name", antibody.alias("antibody")), F.split_part("cell", F.lit(":"), F.lit(2)) == F.col("name")).withColumn("alone", F.col("antibody") == "NA")


@query("select_cells_by_umis", """SELECT antibody, library, cell, round(CASE WHEN antibody = 'NA' THEN log10(rna_reads + 1) ELSE sqrt(pow(log10(rna_reads + 1), 2) + pow(log10(dna_reads + 1), 2)) END, 6) AS r,
 round(CASE WHEN antibody = 'NA' THEN pi() / 4 ELSE atan2(log10(dna_reads + 1), log10(rna_reads + 1)) END, 6) AS theta, rna_umis >= 400 AND dna_umis >= 400 AS keep FROM assays""", PAIRED_SQL, ASSAY_SQL)  # fmt: skip
def select_cells_by_umis(spark, sf):
    x = matrix.select_cells(cells_of_assays(Views(spark, sf)), ["antibody", "library"], least=400, rna_only="alone", umis_only=True)
    return R6(x.select("antibody", "library", "cell", "r", "theta", "keep"), "r", "theta")


@query("select_cells_by_assay")
def select_cells_by_assay(spark, sf):
    """By assay and library, from the densities of radii."""
    x = matrix.select_cells(cells_of_assays(Views(spark, sf)), ["antibody", "library"], least=400, rna_only="alone")
    return x.select("antibody", "library", "cell", "r", "theta", "cut", "cut2", "keep")


@query("name_sorted_reads", "SELECT read_id, row_number() OVER (ORDER BY read_id) - 1 AS place FROM fx_reads")
def name_sorted_reads(spark, sf):
    return counting.ranked(Views(spark, sf).reads.select("read_id"), ["read_id"], "place")


ANTIBODY_SQL = MEASURES_SQL.replace("SELECT sample,", "SELECT concat_ws('/', split_part(cell, ':', 1), antibody, wide.sample) AS sample,").replace("FROM wide", "FROM wide JOIN fx_samples ON wide.sample = fx_samples.name")


@query("sample_qc_by_antibody", "SELECT sample, measure, count(*) AS n_cell, count(*) FILTER (covered) AS n_well_covered, round(max(value) FILTER (covered AND i = floor(0.5 * n)), 5) AS median, round(avg(value) FILTER (covered), 5) AS mean "
 "FROM (SELECT *, row_number() OVER (PARTITION BY sample, measure, covered ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY sample, measure, covered) AS n FROM vals) GROUP BY 1, 2", FLAGS_SQL, CELLQC_SQL, WIDE_SQL, ANTIBODY_SQL, VALUES_SQL)  # fmt: skip
def sample_qc_by_antibody(spark, sf):
    """Distributions by library, antibody and sample."""
    v = Views(spark, sf)
    w = qc.widen(cell_qc_table(v), ["sample", "cell"], ["filter", "target", "type"], values=WIDE)
    w = w.join(v.samples.select(F.col("name").alias("sample"), "antibody"), "sample").withColumn("library", F.split_part("cell", F.lit(":"), F.lit(1)))
    out = qc.sample_qc(w, ["library", "antibody", "sample"], least=300)
    out = out.select(F.concat_ws("/", "library", "antibody", "sample").alias("sample"), "measure", "n_cell", "n_well_covered", "median", "mean")
    return out.withColumns({c: F.round(c, 5) for c in ("median", "mean")})


@query("digest_of_fastq", """SELECT library AS sequence_id, sample AS lysis_id, CASE WHEN library = 'LIB1' THEN 'rna' ELSE 'dna' END AS library_type, concat('/in/', library, '_', sample, '_R1.fastq.gz') AS fastq1,
 concat('/in/', library, '_', sample, '_R2.fastq.gz') AS fastq2, count(*) AS reads FROM fx_reads WHERE sample = 'SM2' GROUP BY ALL""")  # fmt: skip
def digest_of_fastq(spark, sf):
    """A digest written from the reads and read from its files: the records of one sample's FASTQ files, by either mate's name."""
    r = Views(spark, sf).reads.groupBy(F.col("library").alias("sequence_id"), F.col("sample").alias("lysis_id")).agg(F.count("*").alias("reads"))
    name = lambda mate: F.concat(F.lit("/in/"), "sequence_id", F.lit("_"), "lysis_id", F.lit(f"_{mate}.fastq.gz"))
    r = written(r.withColumns({"library_type": F.when(F.col("sequence_id") == "LIB1", "rna").otherwise("dna"), "fastq1": name("R1"), "fastq2": name("R2")}), "digest")
    path = scratch(spark, "digest")
    writers.write_table(r.select("sequence_id", "lysis_id", "library_type", "fastq1", "fastq2"), path)
    digest = readers.read_digest(spark, path)
    found = readers.digest_for(digest, "LIB1_SM2_R1_ds.fq.gz", "LIB1").union(readers.digest_for(digest, "elsewhere/LIB2_SM2_R2.fastq"))
    return found.join(r.select("sequence_id", "lysis_id", "reads"), ["sequence_id", "lysis_id"]).select("sequence_id", "lysis_id", "library_type", "fastq1", "fastq2", "reads")


@query("layout_from_file", """SELECT concat('BC', CAST(p_partkey AS VARCHAR(10))) AS barcode, CAST(floor(k / 96) AS INT) + 1 AS plate_index, concat(substr('ABCDEFGH', CAST(floor((k % 96) / 12) AS INT) + 1, 1), CAST(k % 12 + 1 AS VARCHAR(2))) AS well_position,
 CAST(k AS BIGINT) + 1 AS well FROM (SELECT *, CAST(p_partkey AS INT) AS k FROM part)""")  # fmt: skip
def layout_from_file(spark, sf):
    """A barcode for each part on plates of 96 wells, written as a layout and read from its files; wells numbered from what was read."""
    k = F.col("p_partkey").cast("int")
    row, col = F.floor(k % 96 / 12).cast("int") + 1, k % 12 + 1
    index = F.floor(k / 96).cast("int") + 1
    x = Views(spark, sf).part.select(
        F.concat(F.lit("BC"), k.cast("string")).alias("barcode"), (k % 2).alias("split"), F.concat(F.lit("P"), index.cast("string")).alias("plate"), index.alias("plate_index"),
        row.alias("plate_row"), col.alias("plate_col"), F.concat(F.substring(F.lit("ABCDEFGH"), row, F.lit(1)), col.cast("string")).alias("well_position"),
    )
    path = scratch(spark, "layout")
    writers.write_table(x, path)
    well = C.well_number(F.col("plate_index"), F.col("plate_row"), F.col("plate_col"))
    return readers.read_layout(spark, path).select("barcode", "plate_index", "well_position", well.cast("long").alias("well"))
