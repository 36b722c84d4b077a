"""Sinks: fragments, FASTQ by sample, reads by cluster, matrices, tables, bedGraph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import UNKNOWN
from ..operators.counting import matrix
from . import blocks, committed, files


def write_fragments(frags: DataFrame, path: str, *, parts: int | None = None) -> None:
    """Fragments ``contig, start, end, cell, n`` sorted over range partitions, gz, tab separated, with an index of regions."""
    blocks.write_blocks(frags.select("contig", "start", "end", "cell", "n"), path, parts=parts)


def write_alignments(reads: DataFrame, path: str, *, parts: int | None = None) -> None:
    """Reads by position, gz, tab separated, with an index of regions; reads without a position are left out."""
    blocks.write_blocks(reads, path, start="pos", end="end_pos", parts=parts)


def fastq_lines(reads: DataFrame, name: str = "name", seq: str = "seq", qual: str = "qual"):
    return F.concat_ws("\n", F.concat(F.lit("@"), F.col(name)), F.col(seq), F.lit("+"), F.col(qual))


def write_fastq(reads: DataFrame, path: str, by: list[str], *, compressed: bool = True, least: int = 0) -> None:
    """One folder for each value of ``by``; unknown values under ``*``'s stand-in ``unknown``.

    Groups of fewer than ``least`` records in all are removed when the write is
    committed; the manifest tells how many they had. No row is shuffled.
    """
    known = lambda c: F.coalesce(F.when(F.col(c) != UNKNOWN, F.col(c).cast("string")), F.lit("unknown"))
    part = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), known(c)) for c in by])
    lines = reads.select(part.alias("part"), fastq_lines(reads).alias("value")).sortWithinPartitions("part")
    committed.write_lines(lines, path, ending=".fastq.gz" if compressed else ".fastq", least=least)


def drop_small(reads: DataFrame, by: list[str], least: int = 3) -> DataFrame:
    """Reads of groups with at least ``least`` records."""
    n = reads.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return reads.join(n.drop("_n"), by, "left_semi")


def write_by_group(reads: DataFrame, groups: DataFrame, path: str, by: list[str], *, on: str = "cell") -> None:
    """Reads of the cells in ``groups(on, …)`` as Parquet, one folder for each value of ``by``."""
    reads.join(groups, on).write.partitionBy(*by).parquet(path)


def write_matrix(counts: DataFrame, path: str) -> None:
    """Tables ``counts``, ``obs`` and ``var``."""
    for name, df in zip(("counts", "obs", "var"), matrix(counts), strict=True):
        df.write.parquet(f"{path}/{name}")


def write_matrix_market(counts: DataFrame, path: str) -> None:
    """``barcodes``, ``genes`` and ``counts``: 1-based entries by feature and cell; the size line is the file ``header``.

    Entries stay in the partitions where they are made; the commit counts them
    and writes the size line. Names are written in the order of their ids.
    """
    x, obs, var = matrix(counts)
    sizes = {}
    for name, df, i, column in (("barcodes", obs, "i", "cell"), ("genes", var, "j", "feature")):
        names = df.repartitionByRange(i).sortWithinPartitions(i)
        committed.write_lines(names.select(F.lit("").alias("part"), F.col(column).alias("value")), f"{path}/{name}")
        sizes[name] = files.read_manifest(f"{path}/{name}")["rows"]
    entry = F.concat_ws(" ", (F.col("j") + 1).cast("string"), (F.col("i") + 1).cast("string"), F.col("n").cast("string"))
    header = f"%%MatrixMarket matrix coordinate integer general\n{sizes['genes']} {sizes['barcodes']} {{rows}}\n"
    committed.write_lines(x.select(F.lit("").alias("part"), entry.alias("value")), f"{path}/counts", header=header)


def write_table(df: DataFrame, path: str, *, by: list[str] | None = None, sep: str = ",") -> None:
    w = df.write.option("header", True).option("sep", sep)
    (w.partitionBy(*by) if by else w).csv(path)


def write_bedgraph(runs: DataFrame, path: str) -> None:
    out = runs.repartitionByRange("contig", "start").sortWithinPartitions("contig", "start")
    out.select("contig", "start", "end", "depth").write.option("sep", "\t").csv(path)


def publish(tables: list[DataFrame], path: str) -> None:
    """Several tables of one shape as one."""
    concatenate(tables).write.mode("overwrite").parquet(path)


def concatenate(tables: list[DataFrame]) -> DataFrame:
    """All rows of the tables; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def enrich_accessions(digest: DataFrame, files: DataFrame, *, run: str = "run", mates: int = 3) -> DataFrame:
    """The digest with ``fastq1 …`` of each run, a dot for a missing mate."""
    wide = files.groupBy(run).pivot("mate", list(range(1, mates + 1))).agg(F.first("path"))
    wide = wide.select(run, *[F.col(str(i)).alias(f"fastq{i}") for i in range(1, mates + 1)])
    return digest.join(wide, run, "left").fillna(".", [f"fastq{i}" for i in range(1, mates + 1)])
