"""Queries over the read views: barcodes, counts, species, positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import barcodes as B
from ..operators import counting, fragments, intervals, matrix, qc, reads, saturation, species
from .fixtures import LINKER1, LINKER2, oracle, view

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
CELL_SQL = "concat_ws(':', library, sample, bc1, bc2)"
SQL_GOOD = "is_mapped AND mapq >= 30"


def query(name: str, sql: str | None = None, *ctes: str):
    """Register a query, and its SQL in front of which the views that it names are put."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = oracle(sql, *ctes)
        return f

    return add


class Views:
    """The views of one folder, each planned when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return view(self.spark, self.sf_dir, name if name in ("lineitem", "events", "embeddings", "part", "nation") else f"fx_{name}")


def with_cell(df: DataFrame) -> DataFrame:
    return df.withColumn("cell", C.cell_id())


def good(v: Views) -> DataFrame:
    return with_cell(v.reads).where(C.good_read(30))


# -- counts ---------------------------------------------------------------

ANNOTATED = f"""annotated AS (
  SELECT r.read_id, r.umi, {CELL_SQL} AS cell, string_agg(DISTINCT f.name, ',' ORDER BY f.name) AS feature
  FROM fx_reads r JOIN fx_features f ON r.contig = f.contig AND r.end_pos >= f.f_start AND r.pos <= f.f_end
  WHERE {SQL_GOOD} GROUP BY ALL)"""
COUNTS = "counts AS (SELECT feature, cell, count(DISTINCT umi) AS n FROM annotated GROUP BY ALL)"
SINGLE = """single AS (SELECT name AS feature, cell, count(DISTINCT umi) AS n FROM (
  SELECT f.name, r.umi, concat_ws(':', r.library, r.sample, r.bc1, r.bc2) AS cell FROM fx_reads r JOIN fx_features f
  ON r.contig = f.contig AND r.end_pos >= f.f_start AND r.pos <= f.f_end WHERE is_mapped AND mapq >= 30) GROUP BY ALL)"""


def annotated(v: Views) -> DataFrame:
    lists = intervals.annotate(v.reads.where(C.good_read(30)).select("read_id", "contig", "pos", "end_pos"), v.features)
    return good(v).select("read_id", "umi", "cell").join(lists.select("read_id", F.array_join("features", ",").alias("feature")), "read_id")


def list_counts(v: Views) -> DataFrame:
    return counting.distinct_counts(annotated(v), "umi")


def single_counts(v: Views) -> DataFrame:
    """Distinct umis by single feature and cell."""
    pairs = intervals.overlap_join(good(v).select("contig", "pos", "end_pos", "umi", "cell"), v.features.select("contig", "f_start", "f_end", "name"))
    return counting.distinct_counts(pairs, "umi", feature="name")


@query("umi_count_per_feature_cell", "SELECT * FROM counts", ANNOTATED, COUNTS)
def umi_count_per_feature_cell(spark, sf):
    return list_counts(Views(spark, sf))


@query("read_count_per_feature_cell", "SELECT feature, cell, count(DISTINCT read_id) AS n FROM annotated GROUP BY ALL", ANNOTATED)
def read_count_per_feature_cell(spark, sf):
    return counting.distinct_counts(annotated(Views(spark, sf)), "read_id")


@query("bulk_feature_count", f"""SELECT f.name AS feature, count(*) AS n FROM fx_reads r JOIN fx_features f
ON r.contig = f.contig AND r.end_pos >= f.f_start AND r.pos <= f.f_end WHERE {SQL_GOOD} GROUP BY 1""")  # fmt: skip
def bulk_feature_count(spark, sf):
    v = Views(spark, sf)
    return counting.feature_counts(intervals.overlap_join(good(v).select("contig", "pos", "end_pos"), v.features.select("contig", "f_start", "f_end", "name")))


@query("multi_track_annotation", """SELECT r.read_id, string_agg(DISTINCT CASE WHEN tag = 'EE' THEN name END, ',' ORDER BY CASE WHEN tag = 'EE' THEN name END) AS EE,
 string_agg(DISTINCT CASE WHEN tag = 'EP' THEN name END, ',' ORDER BY CASE WHEN tag = 'EP' THEN name END) AS EP,
 string_agg(DISTINCT CASE WHEN tag = 'GN' THEN name END, ',' ORDER BY CASE WHEN tag = 'GN' THEN name END) AS GN
FROM fx_reads r LEFT JOIN fx_features f ON r.is_mapped AND r.contig = f.contig AND r.end_pos >= f.f_start AND r.pos <= f.f_end GROUP BY 1""")  # fmt: skip
def multi_track_annotation(spark, sf):
    v = Views(spark, sf)
    tracks = ["EE", "EP", "GN"]
    found = intervals.annotate_tracks(v.reads.where("is_mapped").select("read_id", "contig", "pos", "end_pos"), v.features.withColumnRenamed("tag", "track"), tracks)
    return v.reads.select("read_id").join(found, "read_id", "left").select("read_id", *[F.array_join(t, ",").alias(t) for t in tracks])


@query("cell_totals", "SELECT cell, CAST(sum(n) AS BIGINT) AS molecule_count, count(*) AS feature_count FROM counts GROUP BY 1", ANNOTATED, COUNTS)
def cell_totals(spark, sf):
    return counting.cell_totals(list_counts(Views(spark, sf)))


@query("split_multifeature", """SELECT feature, cell, CAST(sum(n) AS BIGINT) AS n, round(sum(n * 1.0 / k), 6) AS part FROM (
  SELECT unnest(string_split(feature, ',')) AS feature, cell, n, len(string_split(feature, ',')) AS k FROM counts) GROUP BY 1, 2""", ANNOTATED, COUNTS)  # fmt: skip
def split_multifeature(spark, sf):
    return counting.split_features(list_counts(Views(spark, sf))).withColumn("part", F.round("part", 6))


@query("cell_metadata_join", """SELECT t.sample, cell, molecule_count, feature_count, coalesce(s.antibody, 'NA') AS antibody FROM (
  SELECT cell, split_part(cell, ':', 2) AS sample, CAST(sum(n) AS BIGINT) AS molecule_count, count(*) AS feature_count FROM counts GROUP BY 1) t
LEFT JOIN (SELECT name AS sample, antibody FROM fx_samples WHERE rank <> 2) s ON t.sample = s.sample""", ANNOTATED, COUNTS)  # fmt: skip
def cell_metadata_join(spark, sf):
    v = Views(spark, sf)
    totals = counting.cell_totals(list_counts(v)).withColumn("sample", F.split_part("cell", F.lit(":"), F.lit(2)))
    return counting.cell_metadata(totals, v.samples.where("rank <> 2").select(F.col("name").alias("sample"), "antibody"))


@query("matrix_ids", """SELECT c.i, f.j, n FROM counts JOIN (SELECT cell, row_number() OVER (ORDER BY cell) - 1 AS i FROM (SELECT DISTINCT cell FROM counts)) c USING (cell)
JOIN (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS j FROM (SELECT DISTINCT feature FROM counts)) f USING (feature)""", ANNOTATED, COUNTS)  # fmt: skip
def matrix_ids(spark, sf):
    return counting.matrix(list_counts(Views(spark, sf)))[0]


@query("feature_prevalence", """SELECT feature, cells, round((row_number() OVER (ORDER BY cells, feature) - 1) * 1.0 / count(*) OVER (), 6) AS percentile
FROM (SELECT feature, count(DISTINCT cell) AS cells FROM single GROUP BY 1)""", SINGLE)  # fmt: skip
def feature_prevalence(spark, sf):
    return counting.prevalence(single_counts(Views(spark, sf))).withColumn("percentile", F.round("percentile", 6))


GENES = ["G0", "G7", "G14", "G21", "G28"]


@query("mito_share", f"""SELECT cell, CAST(sum(n) AS BIGINT) AS total, CAST(sum(CASE WHEN feature IN ({', '.join(f"'{g}'" for g in GENES)}) THEN n ELSE 0 END) AS BIGINT) AS listed,
round(sum(CASE WHEN feature IN ({', '.join(f"'{g}'" for g in GENES)}) THEN n ELSE 0 END) * 1.0 / sum(n), 6) AS share FROM single GROUP BY 1""", SINGLE)  # fmt: skip
def mito_share(spark, sf):
    return counting.gene_share(single_counts(Views(spark, sf)), GENES).withColumn("share", F.round("share", 6))


# -- read names -----------------------------------------------------------


@query("decode_read_name", """SELECT read_id, umi AS "MI", substr(umi, 1, 2) AS "BC", concat(bc1, 'x:', bc2, 'y') AS "CR",
CASE WHEN umi LIKE 'A%' THEN '*' WHEN library = 'LIB1' THEN concat_ws(':', 'LIB1', sample, bc1, bc2) ELSE concat_ws(':', sample, bc1, bc2) END AS "CB", seqtype
FROM fx_reads""")  # fmt: skip
def decode_read_name(spark, sf):
    v = Views(spark, sf)
    sample = F.when(F.col("umi").startswith("A"), "*").otherwise(F.col("sample"))
    parsed = F.concat_ws(":", "umi", "bc1", "bc2", sample, "seqtype")
    raw = F.concat_ws(":", "umi", F.concat("bc1", F.lit("x")), F.concat("bc2", F.lit("y")), F.substring("umi", 1, 2), F.lit("TTT"))
    named = v.reads.select(F.concat_ws("|", "read_id", parsed, raw).alias("name"), F.when(F.col("library") == "LIB1", "LIB1").otherwise("").alias("lib"))
    return named.select(*[c.alias(k) for k, c in reads.decode_name(F.col("name"), library=F.col("lib")).items()])


@query("decode_alt_name", """SELECT read_id, bc1, bc2, umi, lpad(CAST(CAST(substr(sample, 3) AS INT) AS VARCHAR), 2, '0') AS well,
s.antibody FROM fx_reads r LEFT JOIN fx_samples s ON r.sample = s.name""")  # fmt: skip
def decode_alt_name(spark, sf):
    v = Views(spark, sf)
    named = v.reads.select("read_id", F.concat_ws(":", F.lit("inst"), "read_id", "bc2", "bc1", F.expr("substring(sample, 3)"), "umi").alias("name"))
    digest = v.samples.select(F.lpad(F.col("rank").cast("string"), 2, "0").alias("well"), "antibody")
    return reads.decode_well_name(named, digest).select("read_id", "bc1", "bc2", "umi", "well", "antibody")


@query("read_groups", """SELECT library, sample, concat_ws('__', library, sample, CAST(row_number() OVER (ORDER BY library, sample) - 1 AS VARCHAR)) AS read_group
FROM (SELECT DISTINCT library, sample FROM fx_reads)""")  # fmt: skip
def read_groups(spark, sf):
    return reads.read_groups(Views(spark, sf).reads, ["library", "sample"])


@query("tag_fallback", "SELECT read_id, CASE WHEN mapq % 3 = 0 THEN concat('T', umi) ELSE umi END AS mi FROM fx_reads")
def tag_fallback(spark, sf):
    v = Views(spark, sf)
    name = F.concat_ws("|", "read_id", F.concat_ws(":", "umi", "bc1", "bc2"))
    return v.reads.select("read_id", reads.tag_fallback(F.when(F.col("mapq") % 3 == 0, F.concat(F.lit("T"), "umi")), name, 0).alias("mi"))


@query("barcode_reorder", "SELECT DISTINCT concat_ws(':', bc1, bc2, sample) AS barcode, library FROM fx_reads")
def barcode_reorder(spark, sf):
    parts = F.split("cell", ":")
    x = with_cell(Views(spark, sf).reads).select(F.concat_ws(":", parts[2], parts[3], parts[1]).alias("barcode"), "library")
    return x.distinct()


@query("file_name_metadata", """SELECT concat('/d/', library, '__rna__', CASE WHEN mapq > 30 THEN 'H3' ELSE 'H4' END, '__', sample, '__', CAST(mapq % 4 AS VARCHAR), '_R1.fastq.gz') AS path,
library AS sequence_id, 'rna' AS assay, CASE WHEN mapq > 30 THEN 'H3' ELSE 'H4' END AS antibody, sample, CAST(mapq % 4 AS VARCHAR) AS part, count(*) AS reads FROM fx_reads GROUP BY ALL""")  # fmt: skip
def file_name_metadata(spark, sf):
    v = Views(spark, sf)
    ab = F.when(F.col("mapq") > 30, "H3").otherwise("H4")
    path = F.concat(F.lit("/d/"), F.concat_ws("__", "library", F.lit("rna"), ab, "sample", (F.col("mapq") % 4).cast("string")), F.lit("_R1.fastq.gz"))
    n = v.reads.groupBy(path.alias("path")).agg(F.count("*").alias("reads"))
    return n.select("path", *[c.alias(k) for k, c in reads.file_fields(F.col("path")).items()], "reads")


@query("contig_filter", "SELECT contig, count(*) AS reads FROM fx_reads WHERE contig IN ('chr1', 'chr2') GROUP BY 1")
def contig_filter(spark, sf):
    return Views(spark, sf).reads.where(reads.standard_contig(F.col("contig"), autosomes=2, others=())).groupBy("contig").agg(F.count("*").alias("reads"))


@query("rename_and_filter_reads", """SELECT CASE WHEN length(concat(read_id, '|', left(seq, 10), '|', seq)) > 150 THEN concat('read', CAST(length(seq) AS VARCHAR), '|', left(seq, 10), '|', seq)
 ELSE concat(read_id, '|', left(seq, 10), '|', seq) END AS name FROM fx_r2 WHERE length(seq) >= 108 AND right(seq, 8) <> 'AAAAAAAA'""")  # fmt: skip
def rename_and_filter_reads(spark, sf):
    v = Views(spark, sf)
    kept = v.r2.where((F.length("seq") >= 108) & (F.expr("right(seq, 8)") != "AAAAAAAA"))
    return kept.select(B.read_name(F.col("read_id"), F.substring("seq", 1, 10), F.col("seq"), F.length("seq"), longest=150).alias("name"))


@query("good_mapping", """SELECT read_id, (is_mapped AND mapq >= 30) OR spike_mapq >= 30 AS pair_good, CASE WHEN is_mapped THEN mapq ELSE -10 END AS q1,
CASE WHEN spike_mapq > 5 THEN spike_mapq ELSE -10 END AS q2,
CASE WHEN (CASE WHEN is_mapped THEN mapq ELSE -10 END) > (CASE WHEN spike_mapq > 5 THEN spike_mapq ELSE -10 END) THEN 'first'
 WHEN (CASE WHEN is_mapped THEN mapq ELSE -10 END) < (CASE WHEN spike_mapq > 5 THEN spike_mapq ELSE -10 END) THEN 'second' ELSE 'equal' END AS better,
is_mapped AND mapq >= 20 AND end_pos - pos >= 60 AS usable FROM fx_reads""")  # fmt: skip
def good_mapping(spark, sf):
    r = Views(spark, sf).reads
    m, q, sm, sq = F.col("is_mapped"), F.col("mapq"), F.col("spike_mapq") > 5, F.col("spike_mapq")
    a, b = reads.mapping_quality((m, q)), reads.mapping_quality((sm, sq))
    return r.select(
        "read_id", reads.good_pair(m, q, sm, sq, F.lit(True)).alias("pair_good"), a.alias("q1"), b.alias("q2"),
        reads.compare_mapping(a, b).alias("better"), reads.usable_alignment(min_mapq=20, min_length=60).alias("usable"),
    )


NUMBERED = "numbered AS (SELECT *, row_number() OVER (ORDER BY read_id) - 1 AS ordinal FROM fx_reads)"


@query("read_length_probe", """SELECT round(avg(len), 6) AS mean_length, avg(len) >= 95 AS paired FROM (SELECT end_pos - pos AS len, ordinal FROM numbered WHERE ordinal < 100 ORDER BY len DESC, ordinal LIMIT 10)""", NUMBERED)
def read_length_probe(spark, sf):
    r = reads.number_reads(Views(spark, sf).reads, ["read_id"]).withColumn("ordinal", F.col("XX").cast("long")).withColumn("query_len", F.col("end_pos") - F.col("pos"))
    return reads.looks_paired(r, least=95.0).withColumn("mean_length", F.round("mean_length", 6))


@query("downsample_head", "SELECT library, read_id FROM (SELECT library, read_id, row_number() OVER (PARTITION BY library ORDER BY read_id) - 1 AS i FROM fx_r2) WHERE i < 500")
def downsample_head(spark, sf):
    r = reads.number_reads(Views(spark, sf).r2, ["read_id"], within=["library"]).withColumn("ordinal", F.col("XX").cast("long"))
    return reads.keep_sampled(r, 500).select("library", "read_id")


@query("positional_join", """SELECT r.library, r.read_id, r.umi, lpad(CAST(row_number() OVER (PARTITION BY r.library ORDER BY r.read_id) - 1 AS VARCHAR), 9, '0') AS "XX", length(q.seq) AS seq_len
FROM fx_reads r JOIN fx_r2 q ON r.read_id = q.read_id""")  # fmt: skip
def positional_join(spark, sf):
    v = Views(spark, sf)
    wells = v.wells.select("name")  # reads with a known well are those that read 2 has
    a = v.reads.join(wells.withColumnRenamed("name", "bc1"), "bc1", "left_semi").join(wells.withColumnRenamed("name", "bc2"), "bc2", "left_semi")
    number = lambda df: reads.number_reads(df, ["read_id"], within=["library"])
    a = number(a.select("library", "read_id", "umi")).select(F.col("library").alias("pair_id"), "XX", F.col("read_id").alias("name"), "umi")
    b = number(v.r2).select(F.col("library").alias("pair_id"), "XX", F.col("read_id").alias("name"), F.length("seq").alias("seq_len"))
    j = reads.join_by_place(a, b, keys=("pair_id", "XX"))
    return j.select(F.col("pair_id").alias("library"), F.col("name").alias("read_id"), "umi", "XX", F.col("seq_len").cast("long").alias("seq_len"))


@query("tag_merge", """SELECT coalesce(a.read_id, b.read_id) AS read_id, a.gn AS "GN", b.ee AS "EE" FROM
 (SELECT r.read_id, string_agg(DISTINCT name, ',' ORDER BY name) AS gn FROM fx_reads r JOIN fx_features f ON r.contig = f.contig AND end_pos >= f_start AND pos <= f_end WHERE tag = 'GN' AND is_mapped GROUP BY 1) a
FULL JOIN (SELECT r.read_id, string_agg(DISTINCT name, ',' ORDER BY name) AS ee FROM fx_reads r JOIN fx_features f ON r.contig = f.contig AND end_pos >= f_start AND pos <= f_end WHERE tag = 'EE' AND is_mapped GROUP BY 1) b
ON a.read_id = b.read_id""")  # fmt: skip
def tag_merge(spark, sf):
    v = Views(spark, sf)
    r = v.reads.where("is_mapped").select("read_id", "contig", "pos", "end_pos")
    side = lambda tag: intervals.annotate(r, v.features.where(F.col("tag") == tag)).select("read_id", F.array_join("features", ",").alias("XT"))
    return reads.merge_tags(side("GN").withColumnRenamed("XT", "GN"), side("EE"), rename={"XT": "EE"})


@query("trim_clip_repair", """SELECT read_id, substr(CASE WHEN length(seq) % 7 = 0 THEN 'N' ELSE seq END, 1, 50) AS seq,
 substr(rpad(CASE WHEN length(seq) % 7 = 0 THEN '' ELSE repeat('I', 40) END, CAST(length(CASE WHEN length(seq) % 7 = 0 THEN 'N' ELSE seq END) AS INT), '!'), 1, 50) AS qual FROM fx_r2""")  # fmt: skip
def trim_clip_repair(spark, sf):
    empty = F.length("seq") % 7 == 0
    x = Views(spark, sf).r2.select("read_id", F.when(empty, "").otherwise(F.col("seq")).alias("seq"), F.when(empty, "").otherwise(F.repeat(F.lit("I"), 40)).alias("qual"))
    return reads.clip(reads.repair(x), 50)


# by passes: what follows the 5' adapter, then what precedes the 3' one or, at the end, a beginning of it without an edit
PASS_SQL = "(SELECT *, CASE WHEN instr(s, '{a}') > 0 THEN substr(s, instr(s, '{a}') + 6) ELSE s END AS t FROM {x})"
CUT_SQL = "(SELECT read_id, CASE WHEN instr(t, '{l}') > 0 THEN left(t, instr(t, '{l}') - 1) ELSE t END AS s FROM {x})"
TAIL_SQL = "CASE " + " ".join(f"WHEN right(s, {k}) = '{LINKER2[:k]}' THEN left(s, -{k})" for k in range(9, 4, -1)) + " ELSE s END"
TRIM_SQL = PASS_SQL.format(a="ACGTAC", x=CUT_SQL.format(l=LINKER2, x=PASS_SQL.format(a="ACGTAC", x="(SELECT read_id, left(seq, 90) AS s FROM fx_r2)")))


@query("trim_adapters", f"SELECT read_id, seq, length(seq) AS n FROM (SELECT read_id, {TAIL_SQL.replace('(s,', '(t,').replace('ELSE s', 'ELSE t')} AS seq FROM {TRIM_SQL}) WHERE length(seq) >= 20")
def trim_adapters(spark, sf):
    x = Views(spark, sf).r2.select("read_id", "seq", F.concat(F.repeat(F.lit("I"), 90), F.repeat(F.lit("#"), F.length("seq") - 90)).alias("qual"))
    return reads.trim_reads(x, [LINKER2], five=("ACGTAC",)).select("read_id", "seq", F.length("seq").cast("long").alias("n"))


# -- barcodes -------------------------------------------------------------

DECODED_SQL = f"""cut AS (SELECT read_id, library, seq, instr(seq, '{LINKER1}') - 1 AS l1 FROM fx_r2),
parts AS (SELECT read_id, library, seq, substr(seq, 1, 10) AS umi, substr(seq, 11, 8) AS bc1, substr(seq, l1 + 31, 8) AS bc2,
  substr(seq, l1 + 70, 4) AS sbc, concat(substr(seq, l1 + 69, 1), substr(seq, l1 + 74, 8)) AS res, substr(seq, l1 + 82) AS tail FROM cut)"""
FIXED_SQL = """near AS (SELECT p.*, w.name AS w1, row_number() OVER (PARTITION BY p.read_id ORDER BY CASE WHEN p.bc1 = w.seq THEN 0 ELSE 1 END, w.rank) AS i
  FROM (SELECT DISTINCT read_id, bc1 FROM parts) p JOIN fx_wells w ON hamming(p.bc1, w.seq) <= 1),
near2 AS (SELECT p.read_id, w.name AS w2, row_number() OVER (PARTITION BY p.read_id ORDER BY CASE WHEN p.bc2 = w.seq THEN 0 ELSE 1 END, w.rank) AS i
  FROM parts p JOIN fx_wells w ON hamming(p.bc2, w.seq) <= 1),
near3 AS (SELECT p.read_id, w.name AS s1, row_number() OVER (PARTITION BY p.read_id ORDER BY CASE WHEN p.sbc = w.seq THEN 0 ELSE 1 END, w.rank) AS i
  FROM parts p JOIN fx_samples w ON hamming(p.sbc, w.seq) <= 1),
decoded AS (SELECT p.read_id, p.library, CASE WHEN p.umi NOT LIKE 'N%' THEN p.umi END AS umi, near.w1 AS bc1, near2.w2 AS bc2, near3.s1 AS sample,
  CASE WHEN p.res LIKE '%TGCA%' THEN 'rna' WHEN p.res LIKE '%GGCC%' THEN 'dna' ELSE 'unk' END AS seqtype
  FROM parts p LEFT JOIN near ON p.read_id = near.read_id AND near.i = 1 LEFT JOIN near2 ON p.read_id = near2.read_id AND near2.i = 1
  LEFT JOIN near3 ON p.read_id = near3.read_id AND near3.i = 1)"""
TALLY_SQL = "tally AS (SELECT coalesce(sample, '*') AS sample, CASE WHEN sample IS NULL OR bc1 IS NULL OR bc2 IS NULL THEN '*' ELSE concat_ws(':', bc1, bc2) END AS cell, count(*) AS reads FROM decoded GROUP BY 1, 2)"


def sliced(v: Views) -> DataFrame:
    return B.extract_barcodes(v.r2.where(B.admissible(F.col("seq"))), LINKER1, LINKER2)


def decoded(v: Views) -> DataFrame:
    x = sliced(v)
    for whitelist, column, into in ((v.wells, "bc1", "w1"), (v.wells, "bc2", "w2"), (v.samples.select("rank", "name", "seq"), "sbc", "sample")):
        x = B.correct(x, whitelist, column, into)
    return x.select("read_id", "library", B.known_umi(F.col("umi")).alias("umi"), F.col("w1").alias("bc1"), F.col("w2").alias("bc2"), "sample", B.molecule_type(F.col("res")).alias("seqtype"))


def tally(v: Views) -> DataFrame:
    return B.tally_cells(decoded(v))


@query("barcode_extract_exact", "SELECT read_id, umi, bc1, bc2, sbc, res, tail FROM parts", DECODED_SQL)
def barcode_extract_exact(spark, sf):
    return sliced(Views(spark, sf)).select("read_id", "umi", "bc1", "bc2", "sbc", "res", "tail")


@query("barcode_extract_damaged", f"""SELECT read_id, CASE WHEN l1 < 18 THEN concat(repeat('N', CAST(18 - l1 AS INT)), substr(seq, 1, l1 - 8)) ELSE substr(seq, 1, 10) END AS umi,
 CASE WHEN l1 < 18 THEN substr(seq, l1 - 7, 8) ELSE substr(seq, 11, 8) END AS bc1, substr(seq, l1 + 31, 8) AS bc2, substr(seq, l1 + 70, 4) AS sbc,
 CASE WHEN l1 IS NOT NULL THEN concat(substr(seq, l1 + 69, 1), substr(seq, l1 + 74, 8)) END AS res, substr(seq, l1 + 82) AS tail, substr(qual, l1 + 82) AS tail_qual
 FROM (SELECT *, CASE WHEN b % 1000 = one + 38 OR (b % 1000 > one AND b % 1000 < one + 38 AND b // 1000 < a // 1000) THEN b % 1000 - 38 END AS l1 FROM (
 SELECT *, list_min(list_transform(range(one + 30, 62), lambda i: hamming(substr(seq, i + 1, 30), '{LINKER2}') * 1000 + i)) AS b FROM (SELECT *, a % 1000 AS one FROM (
 SELECT read_id, concat(seq, 'ACG') AS seq, concat(repeat('I', CAST(length(seq) AS INT)), 'FG#') AS qual, list_min(list_transform(range(8, 24), lambda i: hamming(substr(seq, i + 1, 30), '{LINKER1}') * 1000 + i)) AS a FROM fx_r2_damaged))))""")  # fmt: skip
def barcode_extract_damaged(spark, sf):
    """Reads with planted errors in their linkers; what follows the restriction site is carried with its qualities."""
    r = Views(spark, sf).r2_damaged
    r = r.select("read_id", F.concat("seq", F.lit("ACG")).alias("seq"), F.concat(F.repeat(F.lit("I"), F.length("seq")), F.lit("FG#")).alias("qual"))
    return B.extract_barcodes(r, LINKER1, LINKER2, qual="qual").select("read_id", "umi", "bc1", "bc2", "sbc", "res", "tail", "tail_qual")


@query("barcode_correct", "SELECT * FROM decoded", DECODED_SQL, FIXED_SQL)
def barcode_correct(spark, sf):
    return decoded(Views(spark, sf))


@query("barcode_tally", "SELECT * FROM tally", DECODED_SQL, FIXED_SQL, TALLY_SQL)
def barcode_tally(spark, sf):
    return tally(Views(spark, sf))


@query("type_tally", "SELECT coalesce(sample, '*') AS sample, seqtype, count(*) AS reads FROM decoded GROUP BY 1, 2", DECODED_SQL, FIXED_SQL)
def type_tally(spark, sf):
    return B.tally_types(decoded(Views(spark, sf)))


@query("assignment_summary", """SELECT assignment, reads, round(reads * 1.0 / sum(reads) OVER (), 6) AS share FROM (
 SELECT CASE WHEN sample = '*' THEN 'unassigned' WHEN cell = '*' THEN 'no_wells' ELSE 'assigned' END AS assignment, CAST(sum(reads) AS BIGINT) AS reads FROM tally GROUP BY 1)""", DECODED_SQL, FIXED_SQL, TALLY_SQL)  # fmt: skip
def assignment_summary(spark, sf):
    return B.assignment_summary(tally(Views(spark, sf))).withColumn("share", F.round("share", 6))


def layout(v: Views) -> DataFrame:
    """Wells in order on plates of 8 x 12, for both splits."""
    i = F.col("rank")
    at = v.wells.select(F.col("name").alias("barcode"), (F.floor(i / 96) + 1).cast("int").alias("plate_index"), (F.floor(i % 96 / 12) + 1).cast("int").alias("plate_row"), (i % 12 + 1).alias("plate_col"))
    return at.withColumn("split", F.explode(F.array(F.lit(1), F.lit(2))))


LAYOUT_SQL = "layout AS (SELECT name AS barcode, CAST(floor(rank / 96) AS INT) + 1 AS plate_index, CAST(floor((rank % 96) / 12) AS INT) + 1 AS plate_row, CAST(rank % 12 + 1 AS INT) AS plate_col FROM fx_wells)"
PLACED_SQL = """placed AS (SELECT t.*, a.plate_row AS row1, a.plate_col AS col1, b.plate_row AS row2, b.plate_col AS col2,
 CASE WHEN cell = '*' THEN 999 ELSE coalesce((a.plate_index - 1) * 96 + (a.plate_row - 1) * 12 + a.plate_col, -1) END AS well1,
 CASE WHEN cell = '*' THEN 999 ELSE coalesce((b.plate_index - 1) * 96 + (b.plate_row - 1) * 12 + b.plate_col, -1) END AS well2
 FROM tally t LEFT JOIN layout a ON split_part(cell, ':', 1) = a.barcode LEFT JOIN layout b ON split_part(cell, ':', 2) = b.barcode)"""


@query("plate_positions", "SELECT sample, cell, reads, coalesce(row1, -1) AS row1, coalesce(col1, -1) AS col1, CAST(well1 AS INT) AS well1, coalesce(row2, -1) AS row2, coalesce(col2, -1) AS col2, CAST(well2 AS INT) AS well2 FROM placed", DECODED_SQL, FIXED_SQL, TALLY_SQL, LAYOUT_SQL, PLACED_SQL)
def plate_positions(spark, sf):
    v = Views(spark, sf)
    return B.plate_positions(tally(v), layout(v)).fillna(-1, ["row1", "col1", "row2", "col2"])


@query("plate_heatmap", """SELECT plate_row, plate_col, reads, best_cell, round(reads * 1.0 / sum(reads) OVER (), 6) AS share FROM (
 SELECT row1 AS plate_row, col1 AS plate_col, CAST(sum(reads) AS BIGINT) AS reads, max(reads) AS best_cell FROM placed WHERE well1 BETWEEN 1 AND 998 GROUP BY 1, 2)""", DECODED_SQL, FIXED_SQL, TALLY_SQL, LAYOUT_SQL, PLACED_SQL)  # fmt: skip
def plate_heatmap(spark, sf):
    v = Views(spark, sf)
    return B.plate_heatmap(B.plate_positions(tally(v), layout(v)), 1).withColumn("share", F.round("share", 6))


@query("assignment_by_sample", """SELECT sample, CASE WHEN sample = '*' OR cell = '*' THEN 'unassigned' ELSE 'assigned' END AS assignment, well1 <> -1 AND well2 <> -1 AS valid, CAST(sum(reads) AS BIGINT) AS reads, count(*) AS cells
FROM placed GROUP BY 1, 2, 3""", DECODED_SQL, FIXED_SQL, TALLY_SQL, LAYOUT_SQL, PLACED_SQL)  # fmt: skip
def assignment_by_sample(spark, sf):
    v = Views(spark, sf)
    return B.assignment_by_sample(B.plate_positions(tally(v), layout(v)))


@query("plate_map", """SELECT well1, well2, reads, best_cell, covered, round(100.0 * (1 + best_cell) / (1 + reads), 6) AS best_share FROM (SELECT CAST(well1 AS INT) AS well1, CAST(well2 AS INT) AS well2, CAST(sum(reads) AS BIGINT) AS reads, max(reads) AS best_cell,
 count(*) FILTER (reads >= 100) AS covered FROM placed WHERE well1 BETWEEN 1 AND 998 AND well2 BETWEEN 1 AND 998 GROUP BY 1, 2)""", DECODED_SQL, FIXED_SQL, TALLY_SQL, LAYOUT_SQL, PLACED_SQL)  # fmt: skip
def plate_map(spark, sf):
    v = Views(spark, sf)
    return B.plate_map(B.plate_positions(tally(v), layout(v)), least=100).withColumn("best_share", F.round("best_share", 6))


@query("closest_threshold", """SELECT sample, threshold, cells FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY abs(threshold - goal), threshold) AS i FROM (
 SELECT s.sample, CAST(t.threshold AS INT) AS threshold, count(c.cell) AS cells FROM (SELECT DISTINCT sample FROM tally) s
 CROSS JOIN (SELECT unnest(range(250, 2001, 50)) AS threshold) t LEFT JOIN tally c ON c.sample = s.sample AND c.reads >= t.threshold GROUP BY 1, 2),
 (SELECT CAST(floor(0.5 + sum(reads) * 2500.0 / 600000.0) AS BIGINT) AS goal FROM tally)) WHERE i = 1""", DECODED_SQL, FIXED_SQL, TALLY_SQL)  # fmt: skip
def closest_threshold(spark, sf):
    t = tally(Views(spark, sf))
    return B.closest_threshold(B.threshold_curve(t), B.depth_threshold(t, depth=600_000.0))


@query("cells_above_threshold", """SELECT s.sample, CAST(t.threshold AS INT) AS threshold, count(c.cell) AS cells FROM (SELECT DISTINCT sample FROM tally) s
CROSS JOIN (SELECT unnest(range(250, 2001, 50)) AS threshold) t LEFT JOIN tally c ON c.sample = s.sample AND c.reads >= t.threshold GROUP BY 1, 2""", DECODED_SQL, FIXED_SQL, TALLY_SQL)  # fmt: skip
def cells_above_threshold(spark, sf):
    return B.threshold_curve(tally(Views(spark, sf)))


@query("adjusted_threshold", """SELECT sample, count(*) FILTER (reads >= threshold) AS well_covered, count(*) FILTER (reads >= 10 AND reads < threshold) AS under_covered
FROM tally, (SELECT CAST(floor(0.5 + sum(reads) * 2500.0 / 600000.0) AS BIGINT) AS threshold FROM tally) WHERE cell <> '*' GROUP BY 1""", DECODED_SQL, FIXED_SQL, TALLY_SQL)  # fmt: skip
def adjusted_threshold(spark, sf):
    t = tally(Views(spark, sf))
    return B.covered_by_threshold(t, B.depth_threshold(t, depth=600_000.0))


@query("cells_per_sample", """SELECT sample, count(*) AS cells, CAST(sum(reads) AS BIGINT) AS reads, CAST(sum(umis) AS BIGINT) AS umis FROM (
 SELECT sample, bc1, bc2, count(*) AS reads, count(DISTINCT umi) AS umis FROM fx_reads GROUP BY 1, 2, 3) GROUP BY 1""")  # fmt: skip
def cells_per_sample(spark, sf):
    return B.cells_per_sample(Views(spark, sf).reads)


@query("block_groups", """SELECT sample, bc1, bc2, reads, CAST(floor((row_number() OVER (ORDER BY sample, bc1, bc2) - 1) / ceil(count(*) OVER () / 7.0)) AS INT) AS "group" FROM (
 SELECT g.sample, g.bc1, g.bc2, count(r.read_id) AS reads FROM (SELECT s.name AS sample, a.name AS bc1, b.name AS bc2 FROM fx_samples s, fx_wells a, fx_wells b) g
 LEFT JOIN fx_reads r ON g.sample = r.sample AND g.bc1 = r.bc1 AND g.bc2 = r.bc2 GROUP BY 1, 2, 3)""")  # fmt: skip
def block_groups(spark, sf):
    v = Views(spark, sf)
    grid = B.block_groups(B.barcode_grid(v.samples, v.wells), groups=7)
    n = v.reads.groupBy("sample", "bc1", "bc2").agg(F.count("*").alias("reads"))
    return grid.join(n, ["sample", "bc1", "bc2"], "left").select("sample", "bc1", "bc2", F.coalesce("reads", F.lit(0)).cast("long").alias("reads"), "group")


@query("reference_sequences", f"""SELECT concat_ws(':', a.name, b.name, s.name) AS name, concat('CC', a.seq, '{LINKER1}', b.seq, '{LINKER2}', s.seq) AS seq
FROM fx_wells a, fx_wells b, fx_samples s""")  # fmt: skip
def reference_sequences(spark, sf):
    v = Views(spark, sf)
    return B.reference_sequences(v.samples, v.wells, LINKER1, LINKER2, "CC")


TEMPLATE = LINKER1[:20]


PWM_SQL = f"""pwm AS (SELECT pos, sum(CASE b WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.25 ELSE 0 END) / count(*) AS a, sum(CASE b WHEN 'C' THEN 1.0 WHEN 'N' THEN 0.25 ELSE 0 END) / count(*) AS c,
 sum(CASE b WHEN 'G' THEN 1.0 WHEN 'N' THEN 0.25 ELSE 0 END) / count(*) AS g, sum(CASE b WHEN 'T' THEN 1.0 WHEN 'N' THEN 0.25 ELSE 0 END) / count(*) AS t FROM (
 SELECT CAST(i AS INT) AS pos, substr(seq, CAST(o + i + 1 AS BIGINT), 1) AS b FROM (SELECT seq, CASE least(d0, d1, d2) WHEN d0 THEN 23 WHEN d1 THEN 24 ELSE 25 END AS o FROM (
  SELECT seq, hamming(substr(seq, 24, 20), '{TEMPLATE}') AS d0, hamming(substr(seq, 25, 20), '{TEMPLATE}') AS d1, hamming(substr(seq, 26, 20), '{TEMPLATE}') AS d2 FROM fx_r2)), range(20) t(i)) GROUP BY 1)"""


@query("linker_pwm", """SELECT pos, round(a, 6) AS "A", round(c, 6) AS "C", round(g, 6) AS "G", round(t, 6) AS "T", round(2 + CASE WHEN a > 0 THEN a * log2(a) ELSE 0 END + CASE WHEN c > 0 THEN c * log2(c) ELSE 0 END
 + CASE WHEN g > 0 THEN g * log2(g) ELSE 0 END + CASE WHEN t > 0 THEN t * log2(t) ELSE 0 END, 6) AS information FROM pwm""", PWM_SQL)  # fmt: skip
def linker_pwm(spark, sf):
    x = Views(spark, sf).r2.withColumn("part", F.expr("substring(seq, 24)"))
    x = x.withColumn("o", B.best_offset(F.col("part"), TEMPLATE)["offset"])
    w = B.position_weights(x.select(F.substring(F.col("part"), F.col("o") + 1, F.lit(len(TEMPLATE))).alias("w")), "w")
    return w.select("pos", *[F.round(b, 6).alias(b) for b in (*"ACGT", "information")])


# -- species --------------------------------------------------------------

BOTH_SQL = "both_maps AS (SELECT read_id, concat_ws(':', sample, bc1, bc2) AS barcode, is_mapped AND mapq >= 30 AS good_primary, spike_mapq >= 45 AS good_spike FROM fx_reads)"
PROB_SQL = """prob AS (SELECT barcode, "primary", spikein, "primary" / (0.05 + "primary" + spikein) AS p FROM (
 SELECT barcode, count(*) FILTER (good_primary AND NOT good_spike) AS "primary", count(*) FILTER (good_spike AND NOT good_primary) AS spikein FROM both_maps GROUP BY 1))"""


def both_maps(v: Views) -> DataFrame:
    r = v.reads.withColumn("barcode", F.concat_ws(":", "sample", "bc1", "bc2"))
    return species.dual_mapping(r.withColumn("good", C.good_read(30)), r.withColumn("good", F.col("spike_mapq") >= 45))


@query("species_tally", """SELECT barcode, "primary", spikein, round(p, 6) AS p, round(CASE WHEN "primary" + spikein > 0 THEN 100.0 * "primary" / ("primary" + spikein) ELSE 0 END, 6) AS pct_primary FROM prob""", BOTH_SQL, PROB_SQL)
def species_tally(spark, sf):
    t = species.barcode_probability(both_maps(Views(spark, sf)))
    return t.withColumns({c: F.round(c, 6) for c in ("p", "pct_primary")})


@query("species_route", """SELECT read_id, b.barcode, good_primary, good_spike, p > 0.3 AND p < 0.7 AS ambig, unnest(CASE WHEN "primary" + spikein = 0 THEN ['primary', 'spikein']
 WHEN p >= 0.7 THEN ['primary'] WHEN p <= 0.3 THEN ['spikein'] ELSE ['primary', 'spikein'] END) AS destination FROM both_maps b JOIN prob USING (barcode)""", BOTH_SQL, PROB_SQL)  # fmt: skip
def species_route(spark, sf):
    b = both_maps(Views(spark, sf))
    return species.route(b, species.barcode_probability(b)).select("read_id", "barcode", "good_primary", "good_spike", "ambig", "destination")


@query("species_ladder", """SELECT CAST(t AS INT) AS count_threshold, count(*) AS barcodes, CAST(sum("primary" + spikein) AS BIGINT) AS reads, count(*) FILTER (p > 0.8) AS primary_barcodes,
 CAST(coalesce(sum("primary" + spikein) FILTER (p > 0.8), 0) AS BIGINT) AS primary_reads, count(*) FILTER (p < 0.2) AS spikein_barcodes, CAST(coalesce(sum("primary" + spikein) FILTER (p < 0.2), 0) AS BIGINT) AS spikein_reads,
 count(*) FILTER (p >= 0.2 AND p <= 0.8) AS ambiguous_barcodes FROM prob, (SELECT unnest([0, 50, 100, 200, 500]) AS t) WHERE "primary" + spikein >= t GROUP BY 1""", BOTH_SQL, PROB_SQL)  # fmt: skip
def species_ladder(spark, sf):
    return species.ladder(species.barcode_probability(both_maps(Views(spark, sf))))
