"""Read, whitelist and interval views over the star-schema tables.

The same SQL text runs in Spark and in the oracle; ``{t}`` stands for a base
table or another view. No row is dropped: every view but the whitelists, whose
size is their definition, covers its whole table. Each 10,000 bases of a contig
hold the reads of 10,000 orders and the features of 200 parts, so the genome
grows with the tables and a read overlaps about as many features at any size.
"""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def dna(expression: str, length: int) -> str:
    """SQL that spells a number as a DNA string, lowest base-4 digit first."""
    digit = "substr('ACGT', CAST(CAST(floor(({e}) / {p}) AS BIGINT) % 4 AS INT) + 1, 1)"
    return "concat(" + ", ".join(digit.format(e=expression, p=4**i) for i in range(length)) + ")"


LINKER1 = "GTGGCCGATGTTTCGGTGCGAACTCAGACC"
LINKER2 = "ATCCACGTGCTTGAGAGGCCAGAGCATTCG"

VIEWS = {
    "fx_wells": f"""
SELECT CAST(p_partkey AS INT) AS rank, concat('BC', CAST(p_partkey AS VARCHAR(10))) AS name,
       {dna('(p_partkey * 7919) % 65536', 8)} AS seq
FROM {{part}} WHERE p_partkey <= 24""",
    "fx_samples": f"""
SELECT CAST(n_nationkey + 1 AS INT) AS rank, concat('SM', CAST(n_nationkey + 1 AS VARCHAR(10))) AS name,
       {dna('((n_nationkey + 1) * 37) % 256', 4)} AS seq,
       CASE WHEN n_nationkey % 2 = 0 THEN 'H3K27ac' ELSE 'H3K27me3' END AS antibody
FROM {{nation}} WHERE n_nationkey < 4""",
    "fx_reads": f"""
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)),
                 CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20)),
                 CAST(l_shipdate AS VARCHAR(40))) AS read_id,
       CASE WHEN l_suppkey % 2 = 0 THEN 'LIB1' ELSE 'LIB2' END AS library,
       concat('SM', CAST(l_orderkey % 4 + 1 AS VARCHAR(10))) AS sample,
       concat('BC', CAST(l_orderkey % 6 + 1 AS VARCHAR(10))) AS bc1,
       concat('BC', CAST(CAST(floor(l_orderkey / 6) AS BIGINT) % 4 + 1 AS VARCHAR(10))) AS bc2,
       {dna('l_linenumber * 5 + l_partkey % 3', 4)} AS umi,
       CASE WHEN l_returnflag = 'R' THEN 'rna' WHEN l_returnflag = 'A' THEN 'dna' ELSE 'unk' END AS seqtype,
       concat('chr', CAST(l_suppkey % 3 + 1 AS VARCHAR(10))) AS contig,
       10000 * CAST(floor(l_orderkey / 10000) AS BIGINT) + (l_partkey % 50) * 200 AS pos,
       10000 * CAST(floor(l_orderkey / 10000) AS BIGINT) + (l_partkey % 50) * 200 + 50 + CAST(l_quantity AS BIGINT) AS end_pos,
       CAST((l_orderkey * 7 + l_linenumber * 13) % 61 AS INT) AS mapq,
       CAST((l_orderkey * 11 + l_linenumber * 17) % 61 AS INT) AS spike_mapq,
       l_linestatus = 'O' OR l_partkey % 5 <> 0 AS is_mapped
FROM {{lineitem}}""",
    "fx_features": """
SELECT concat('G', CAST(p_partkey AS VARCHAR(10))) AS name,
       concat('chr', CAST(p_partkey % 3 + 1 AS VARCHAR(10))) AS contig,
       10000 * CAST(floor(p_partkey / 200) AS BIGINT) + (p_partkey * 53) % 10000 AS f_start,
       10000 * CAST(floor(p_partkey / 200) AS BIGINT) + (p_partkey * 53) % 10000 + p_size * 4 AS f_end,
       CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
       CASE CAST(floor(p_partkey / 3) AS BIGINT) % 3 WHEN 0 THEN 'EE' WHEN 1 THEN 'EP' ELSE 'GN' END AS tag
FROM {part}""",
    "fx_r2": f"""
SELECT r.read_id, r.library,
       concat(r.umi, 'ACGTAC',
              CASE WHEN length(r.read_id) % 5 = 0 THEN concat('N', substr(w1.seq, 2, 7)) ELSE w1.seq END,
              substr('TCA', 1, CAST(CAST(floor(r.pos / 200) AS BIGINT) % 4 AS INT)),
              '{LINKER1}', w2.seq, '{LINKER2}',
              'T', s.seq,
              CASE WHEN r.seqtype = 'rna' THEN 'CCTGCAGG' WHEN r.seqtype = 'dna' THEN 'GCGGCCGC' ELSE 'AAAAAAAA' END) AS seq
FROM {{fx_reads}} r JOIN {{fx_wells}} w1 ON r.bc1 = w1.name JOIN {{fx_wells}} w2 ON r.bc2 = w2.name
JOIN {{fx_samples}} s ON r.sample = s.name""",
    # one or two substitutions in linker 1, one in linker 2, or a base of linker 1 left out
    "fx_r2_damaged": f"""
SELECT read_id, library,
       concat(substr(seq, 1, CAST(a - 1 AS INT)), CASE WHEN o % 3 = 0 THEN translate(substr(seq, CAST(a AS INT), 1), 'ACGTN', 'CGTAC') WHEN o % 11 = 1 THEN '' ELSE substr(seq, CAST(a AS INT), 1) END,
              substr(seq, CAST(a + 1 AS INT), CAST(b - a - 1 AS INT)), CASE WHEN o % 6 = 0 THEN translate(substr(seq, CAST(b AS INT), 1), 'ACGTN', 'CGTAC') ELSE substr(seq, CAST(b AS INT), 1) END,
              substr(seq, CAST(b + 1 AS INT), CAST(c - b - 1 AS INT)), CASE WHEN n % 2 = 0 THEN translate(substr(seq, CAST(c AS INT), 1), 'ACGTN', 'CGTAC') ELSE substr(seq, CAST(c AS INT), 1) END,
              substr(seq, CAST(c + 1 AS INT), 200)) AS seq
FROM (SELECT *, l1 + o % 14 AS a, l1 + 15 + o % 15 AS b, l1 + 38 + o % 30 AS c FROM (
  SELECT read_id, library, seq, instr(seq, '{LINKER1}') AS l1, CAST(split_part(read_id, '-', 1) AS BIGINT) AS o, CAST(split_part(read_id, '-', 2) AS BIGINT) AS n FROM {{fx_r2}}) x) y""",
}
NEEDS = {
    "fx_wells": ("part",),
    "fx_samples": ("nation",),
    "fx_reads": ("lineitem",),
    "fx_features": ("part",),
    "fx_r2": ("fx_reads", "fx_wells", "fx_samples"),
    "fx_r2_damaged": ("fx_r2",),
}


def reachable_by_workers(spark: SparkSession) -> None:
    """Tell Python workers where this package is, for a driver that found it by sys.path alone."""
    root = str(Path(__file__).parents[2])
    found = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in found:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*found, root]))


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A view or table; ``given`` are tables that take the place of those it needs."""
    reachable_by_workers(spark)
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{t: given[t] if t in given else view(spark, sf_dir, t) for t in NEEDS[name]})


def oracle(query: str, *more: str) -> str:
    """``query`` with the views that it names in front of it; ``more`` are further CTEs, ``name AS (...)``."""
    text = query + " ".join(more)
    used: list[str] = []

    def add(name: str) -> None:
        for t in NEEDS.get(name, ()):
            add(t)
        if name in VIEWS and name not in used:
            used.append(name)

    for name in VIEWS:
        if name in text:
            add(name)
    ctes = [f"{n} AS ({VIEWS[n].format(**{t: t for t in NEEDS[n]})})" for n in used] + list(more)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + query
