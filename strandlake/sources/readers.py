"""Scans: FASTQ and FASTA data sources, alignment text, tracks, digests, layouts, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import strip_suffixes
from . import blocks, committed, files, records

LIBRARY_DIGEST = "sequence_id string, lysis_id string, library_type string, fastq1 string, fastq2 string"
SAMPLE_DIGEST = (
    "sample_id string, assay_info string, pairedtag_run_id string, antibody_target string, dna_well string, barcode string, "
    "library_type string, lysis_id string, sequence_id string, fastq1 string, fastq2 string"
)
PLATE_LAYOUT = "barcode string, split int, plate string, plate_index int, plate_row int, plate_col int, well_position string"
LONG_COUNTS = "feature string, cell string, n long"


def read_fastq(spark: SparkSession, path: str, *, split: int | None = None) -> DataFrame:
    """``path, ordinal, name, seq, qual`` of FASTQ files, plain or gz; the name without the at sign.

    Plain files are cut into ranges of ``split`` bytes; see :mod:`.records`.
    """
    return records.scan(spark, path, "fastq", split)


def read_fasta(spark: SparkSession, path: str, *, split: int | None = None) -> DataFrame:
    """``path, rank, name, seq`` of FASTA files, ranks from 1 in file order; sequences may span lines."""
    return records.scan(spark, path, "fasta", split)


def read_lines(spark: SparkSession, path: str, *, split: int | None = None) -> DataFrame:
    """``path, ordinal, value``: the lines of text files with their number in the file, from 0."""
    return records.scan(spark, path, "lines", split)


def paired_scan(spark: SparkSession, first: str, second: str, *, split: int | None = None) -> DataFrame:
    """Both mates record by record: ``pair_id, ordinal, name, comment, seq1, qual1, seq2, qual2``; names must agree.

    ``comment`` is what stands behind the name in the first file. A task reads both files of a base name side by side; no row is shuffled.
    """
    found = [(side, *x) for side, pattern in enumerate((first, second)) for x in files.listed(spark, pattern)]
    named = spark.createDataFrame(found, "side int, path string, size long").withColumn("pair_id", strip_suffixes(F.col("path"))).collect()  # a row for each file
    sides: list[dict] = [{}, {}]
    for x in named:
        sides[x["side"]].setdefault(x["pair_id"], []).append((x["path"], x["size"]))
    pairs = [(name, a, b) for name, mine in sides[0].items() for a in mine for b in sides[1].get(name, [])]
    bare = lambda c: F.split_part(c, F.lit(" "), F.lit(1))
    same = F.assert_true(bare("name1").eqNullSafe(bare("name2")), F.lit("the two files hold different reads"))
    both = records.scan_pairs(spark, pairs, split).where(F.coalesce(same.cast("boolean"), F.lit(True)))
    comment = F.expr("substring(name1, length(split_part(name1, ' ', 1)) + 2)")
    return both.select("pair_id", "ordinal", bare("name1").alias("name"), comment.alias("comment"), "seq1", "qual1", "seq2", "qual2")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment text as reads: flags as booleans, 0-based half-open positions, optional tags as a map."""
    f = F.split("value", "\t")
    at = lambda i: F.get(f, F.lit(i))
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    flag, cigar = at(1).cast("int"), at(5)
    has = lambda bit: flag.bitwiseAND(F.lit(bit)) != 0
    spans = F.regexp_extract_all(cigar, F.lit(r"([0-9]+)[MDN=X]"), F.lit(1))
    length = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    pos = at(3).cast("long") - 1
    tags = F.filter(F.slice(f, 12, 1_000_000), lambda x: x.rlike("^[A-Za-z][A-Za-z0-9]:[AifZHB]:"))
    tag_map = F.map_from_arrays(F.transform(tags, lambda x: F.substring(x, 1, 2)), F.transform(tags, lambda x: x.substr(F.lit(6), F.lit(2_000_000_000))))
    return lines.select(
        at(0).alias("read_id"), F.when(at(2) != "*", at(2)).alias("contig"), pos.alias("pos"), (pos + length).alias("end_pos"),
        at(4).cast("int").alias("mapq"), (~has(4)).alias("is_mapped"), has(1).alias("is_paired"), (~has(0x900)).alias("is_primary"),
        (has(1) & ~has(8)).alias("mate_mapped"), has(64).alias("is_read1"), at(8).cast("long").alias("tlen"), F.length(at(9)).alias("query_len"),
        at(9).alias("seq"), at(10).alias("qual"), tag_map.alias("tags"),
    )


def region(reads: DataFrame, contig: str, start: int, end: int) -> DataFrame:
    """Reads that start in ``[start, end)`` of a contig; the filter reaches a Parquet scan and an indexed one."""
    return reads.where((F.col("contig") == contig) & (F.col("pos") >= start) & (F.col("pos") < end))


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Indexed fragments; filters on ``contig``, ``start`` and ``end`` decide which blocks are read."""
    return blocks.read_blocks(spark, path)


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Indexed reads; filters on ``contig``, ``pos`` and ``end_pos`` decide which blocks are read."""
    return blocks.read_blocks(spark, path)


def read_matrix_market(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(entries, cells, features)``: ``row, col, n`` 1-based, and ``id, name`` of both sides, ids by their place in the files.

    Raises an error if the size line doesn't fit what the files hold.
    """
    names = {}
    for side in ("barcodes", "genes"):
        listed, before, parts = files.read_manifest(f"{path}/{side}"), 0, []
        for x in listed["files"]:
            parts.append((x["file"].rpartition("/")[2], before))
            before += x["rows"]
        first = spark.createDataFrame(parts, "_file string, _before long")  # a row for each file
        lines = read_lines(spark, f"{path}/{side}/part-*") if parts else spark.createDataFrame([], "path string, ordinal long, value string")
        lines = lines.withColumn("_file", F.element_at(F.split("path", "/"), -1)).join(F.broadcast(first), "_file")
        lines = lines.select((F.col("_before") + F.col("ordinal") + 1).alias("id"), F.col("value").alias("name"))
        names[side] = lines, before
    store, folder = files.system(path)
    with store.open_input_stream(f"{folder}/counts/header") as f:
        size = f.read().decode().splitlines()[-1].split()
    rows = files.read_manifest(f"{path}/counts")["rows"]
    if [int(x) for x in size] != [names["genes"][1], names["barcodes"][1], rows]:
        raise ValueError(f"{path}: the size line doesn't fit the files")
    kind = "row long, col long, n long"
    counts = committed.files_of(f"{path}/counts")
    entries = spark.read.csv(counts, sep=" ", schema=kind) if counts else spark.createDataFrame([], kind)
    return entries, names["barcodes"][0], names["genes"][0]


def read_track(spark: SparkSession, path: str, track: str, *, contigs: DataFrame | None = None) -> DataFrame:
    """Intervals ``track, name, contig, f_start, f_end, strand`` of a BED or SAF file; unknown contigs dropped."""
    if path.rstrip("/").lower().endswith("saf"):
        raw = spark.read.csv(path, sep="\t", header=True, schema="GeneID string, Chr string, Start long, End long, Strand string")
        df = raw.select(F.col("GeneID").alias("name"), F.col("Chr").alias("contig"), F.col("Start").alias("f_start"), F.col("End").alias("f_end"), F.col("Strand").alias("strand"))
    else:
        raw = spark.read.csv(path, sep="\t", schema="contig string, f_start long, f_end long, name string, score string, strand string", enforceSchema=True)
        df = raw.select("name", "contig", "f_start", "f_end", F.coalesce("strand", F.lit(".")).alias("strand"))
    df = df.select(F.lit(track).alias("track"), "*")
    return df if contigs is None else df.join(contigs.select("contig"), "contig", "left_semi").select(df.columns)


def read_digest(spark: SparkSession, path: str, schema: str = LIBRARY_DIGEST) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def digest_for(digest: DataFrame, fastq: str, library: str | None = None) -> DataFrame:
    """Records whose first or second file has the same base name (also as ``…_ds``), of one library if given."""
    base = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"\.(fastq|fq)(\.gz)?$", ""), r"_ds$", "")
    want = base(F.lit(fastq))
    out = digest.where((base(F.col("fastq1")) == want) | (base(F.col("fastq2")) == want))
    return out if library is None else out.where(F.col("sequence_id") == library)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=PLATE_LAYOUT)


def read_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Long count tables ``feature, cell, n``, tab separated with a header, from many files at once."""
    return spark.read.csv(path, sep="\t", header=True, schema=LONG_COUNTS)


def reads_schema() -> T.StructType:
    return T._parse_datatype_string(
        "read_id string, library string, antibody string, sample string, bc1 string, bc2 string, umi string, seqtype string, contig string, "
        "pos long, end_pos long, mapq int, is_mapped boolean, is_paired boolean, is_primary boolean, mate_mapped boolean, tlen long, query_len int, "
        "ambig boolean, features map<string,array<string>>"
    )
