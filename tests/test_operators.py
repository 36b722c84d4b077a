import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.functions import columns as C
from strandlake.operators import barcodes, counting, fragments, intervals, matrix, peaks, reads, saturation, species
from strandlake.plans.fixtures import LINKER1, LINKER2
from strandlake.sources import readers, writers


def test_barcodes_are_cut_from_built_reads(spark):
    """Every combination of wells, sample, gap and damage gives its own parts back."""
    r = random.Random(1)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    rows = []
    for i, (gap, damage) in enumerate(itertools.product(range(4), ("none", "l1", "l2", "both"))):
        umi, bc1, bc2, sbc = dna(10), dna(8), dna(8), dna(4)
        hit = lambda s: s[:5] + ("A" if s[5] != "A" else "C") + s[6:]
        l1, l2 = hit(LINKER1) if damage in ("l1", "both") else LINKER1, hit(LINKER2) if damage in ("l2", "both") else LINKER2
        rows.append((i, umi + bc1 + dna(gap) + l1 + bc2 + l2 + "T" + sbc + "CCTGCAGG" + "GATTACA", umi, bc1, bc2, sbc))
    rows += [(90, "ACGT", None, None, None, None), (91, None, None, None, None, None), (92, LINKER1 + "ACGTACGT" + LINKER2 + "TACGTAA", None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, seq string, w_umi string, w_bc1 string, w_bc2 string, w_sbc string")
    df = df.withColumn("q", F.concat(F.repeat(F.lit("I"), F.length("seq") - 7), F.lit("ABCDEFG")))
    for x in barcodes.extract_barcodes(df, LINKER1, LINKER2, qual="q").collect():
        if x["id"] < 90:
            assert (x["umi"], x["bc1"], x["bc2"], x["sbc"], x["res"]) == (x["w_umi"], x["w_bc1"], x["w_bc2"], x["w_sbc"], "TCCTGCAGG")
            assert (x["tail"], x["tail_qual"]) == ("GATTACA", "ABCDEFG")
        else:
            assert x["sbc"] is None or x["id"] == 92


def test_skipped_bases_pad_the_umi(spark):
    seq = "ACGTACG" + "GGGGCCCC" + LINKER1 + "TTTTAAAA" + LINKER2 + "TACGTCC"
    x = barcodes.extract_barcodes(spark.createDataFrame([(seq,)], "seq string"), LINKER1, LINKER2).first()
    assert (x["umi"], x["bc1"], x["bc2"], x["sbc"]) == ("NNNACGTACG", "GGGGCCCC", "TTTTAAAA", "ACGT")


def test_a_lost_base_in_linker_1_is_told_by_linker_2(spark):
    lost = LINKER1[:6] + LINKER1[7:]
    short = "ACGTACGTAC" + "GGGGCCCC" + LINKER1 + "TTTTAAAA" + LINKER2
    rows = [("ACGTACGTAC" + "GGGGCCCC" + lost + "TTTTAAAA" + LINKER2 + "TACGTCC",), (short,), (short + "T",), (short + "TACG",), (short + "TACGT",)]
    got = [tuple(x)[1:] for x in barcodes.extract_barcodes(spark.createDataFrame(rows, "seq string").coalesce(1), LINKER1, LINKER2).collect()]
    assert got[0] == ("NACGTACGTA", "CGGGGCCC", "TTTTAAAA", "ACGT", "TCC", "")
    for i, (sbc, res) in enumerate([(None, "N" * 9), (None, "N" * 9), (None, "T"), ("ACGT", "T")], 1):
        assert got[i] == ("ACGTACGTAC", "GGGGCCCC", "TTTTAAAA", sbc, res, "")


def test_linker_placement_equals_a_plain_search(spark):
    r = random.Random(4)
    rows = []
    for i in range(300):
        s = "".join(r.choice("ACGT") for _ in range(r.randint(14, 26))) + LINKER1 + "".join(r.choice("ACGT") for _ in range(r.choice([8, 8, 8, 7, 9]))) + LINKER2 + "TACGTCCTGCAGG"
        s = list(s)
        for _ in range(r.randint(0, 12)):
            s[r.randrange(len(s))] = r.choice(["A", "C", "G", "T", "N", ""])
        rows.append((i, "".join(s)[: r.randint(40, 110)]))

    def plain(s):
        cost = lambda i, x: sum(a != b for a, b in itertools.zip_longest(s[i : i + 30], x))
        m1, one = min((cost(i, LINKER1), i) for i in range(8, 24))
        m2, two = min((cost(i, LINKER2), i) for i in range(one + 30, 62))
        off = two - one - 38
        one += off
        return one if one >= 8 and (off == 0 or (-8 < off < 0 and m2 < m1)) else None

    got = {x["id"]: x["at"] for x in spark.createDataFrame(rows, "id int, seq string").select("id", barcodes._anchor(LINKER1, LINKER2, 10, 8, None)("seq").alias("at")).collect()}
    assert got == {i: plain(s) for i, s in rows}
    assert len({x for x in got.values() if x}) > 5 and None in got.values()


def test_correction_takes_exact_then_lowest_rank(spark):
    wl = spark.createDataFrame([(1, "a", "AAAA"), (2, "b", "AATT"), (3, "c", "AATA")], "rank int, name string, seq string")
    r = spark.createDataFrame([("AAAA",), ("AATA",), ("AATG",), ("NATT",), ("GGGG",), ("AAA",), (None,), ("AAAT",)], "s string")
    got = {x["s"]: x["n"] for x in barcodes.correct(r, wl, "s", "n").collect()}
    assert got == {"AAAA": "a", "AATA": "c", "AATG": "b", "NATT": "b", "GGGG": None, "AAA": None, None: None, "AAAT": "a"}


@pytest.mark.parametrize("library,antibody", list(itertools.product(["", "L:1", "lib x"], ["", "H3K27ac"])))
def test_name_decoding(spark, library, antibody):
    names = ["plain", "a b:c/1", "@x#y"]
    rows = [(n, f"{n}|ACGT:BC1:BC2:SM1:rna|ACGT:AAAA:CCCC:GG:TT", library, antibody) for n in names] + [("u", "u|*:BC1:*:SM1:dna|N:A:C:G:T", library, antibody), ("bare", "bare", library, antibody)]
    df = spark.createDataFrame(rows, "n string, name string, lib string, ab string")
    tags = reads.decode_name(F.col("name"), library=F.col("lib"), antibody=F.col("ab"))
    for x in df.select("n", *[c.alias(k) for k, c in tags.items()]).collect():
        assert x["read_id"] == x["n"]
        if x["n"] in names:
            assert x["CB"] == ":".join(p for p in (library, antibody, "SM1", "BC1", "BC2") if p) and x["MI"] == "ACGT" and x["BC"] == "GG" and x["CR"] == "AAAA:CCCC"
        else:
            assert x["CB"] == "*" and x["MI"] is None


@pytest.mark.parametrize("base,end", list(itertools.product(["a", "a.b_c", "R1_x"], ["", ".fq", ".fastq", ".fq.gz", "_R1.fastq.gz", "_1.fq", "_R2.fq.gz"])))
def test_base_names(spark, base, end):
    assert spark.range(1).select(C.strip_suffixes(F.lit(f"/d/{base}{end}"))).first()[0] == base


@pytest.mark.parametrize("sizes", [[1], [125, 1], [12, 14, 18, 2], [256] * 6, [1] * 10])
def test_cells_per_sample_and_groups(spark, sizes):
    rows = [(f"S{s}", f"B{i}", "C", f"U{u}") for s, n in enumerate(sizes) for i in range(n) for u in range(2)] + [(None, "B", "C", "U"), ("S0", None, "C", "U")]
    got = barcodes.cells_per_sample(spark.createDataFrame(rows, "sample string, bc1 string, bc2 string, umi string")).collect()
    assert {x["sample"]: x["cells"] for x in got} == {f"S{s}": n for s, n in enumerate(sizes)}
    cells = spark.createDataFrame([(f"S{s}", f"B{i:04d}") for s, n in enumerate(sizes) for i in range(n)], "sample string, bc1 string")
    k = min(3, sum(sizes))
    groups = barcodes.block_groups(cells, groups=k).groupBy("group").count().collect()
    assert sum(x["count"] for x in groups) == sum(sizes) and max(x["count"] for x in groups) <= math.ceil(sum(sizes) / k)


def test_overlap_join_equals_brute_force(spark):
    r = random.Random(2)
    span = lambda top: (lambda a: (a, a + r.choice([0, 3, 40, r.randint(0, top)])))(r.randint(0, 5000))
    a = [(i, f"chr{i % 2}", *span(300)) for i in range(200)] + [(900, None, 1, 2), (901, "chr0", None, 3)]
    b = [(f"f{i}", f"chr{i % 3}", *span(5000)) for i in range(80)]
    got = intervals.overlap_join(spark.createDataFrame(a, "read_id int, contig string, pos long, end_pos long"), spark.createDataFrame(b, "name string, contig string, f_start long, f_end long"), width=50)
    want = sorted((i, n) for i, c, s, e in a for n, d, fs, fe in b if c == d and s is not None and e >= fs and s <= fe)
    assert sorted((x["read_id"], x["name"]) for x in got.collect()) == want


def test_merged_intervals_are_disjoint_and_cover(spark):
    r = random.Random(3)
    rows = [("t", "c", s, s + r.randint(1, 30)) for s in (r.randint(0, 400) for _ in range(60))]
    m = [(x["f_start"], x["f_end"]) for x in intervals.merge_intervals(spark.createDataFrame(rows, "tag string, contig string, f_start long, f_end long"), ["tag", "contig"]).orderBy("f_start").collect()]
    assert all(a[1] < b[0] for a, b in itertools.pairwise(m))
    assert all(any(s <= x[2] and x[3] <= e for s, e in m) for x in rows)


@pytest.mark.parametrize("block", [7, 1000])
def test_coverage_equals_depth_by_position(spark, block):
    r = random.Random(4)
    rows = [("c", s, s + r.randint(0, 20)) for s in (r.randint(0, 100) for _ in range(50))]
    depth = [sum(s <= p < e for _, s, e in rows) for p in range(140)]
    got = [0] * 140
    for x in intervals.coverage_runs(spark.createDataFrame(rows, "contig string, pos long, end_pos long"), block=block).collect():
        for p in range(x["start"], x["end"]):
            got[p] += x["depth"]
    assert got == depth


def test_fragments_and_gap_sessions(spark):
    rows = [("m", p, 100) for p in (0, 100, 400, 701, 702)] + [("n", 5, 0)]
    f = fragments.fragments(spark.createDataFrame(rows, "molecule string, pos long, tlen long"), ["molecule"]).collect()
    assert sorted((x["molecule"], x["start"], x["length"], x["n"]) for x in f) == [("m", 166, 100, 3), ("m", 701, 100, 2), ("n", 5, 300, 1)]


def test_saturation_equals_direct_counts(spark):
    r = random.Random(5)
    rows = [(f"r{i}", "L", f"c{r.randint(0, 5)}", r.randint(0, 30)) for i in range(400)]
    df = spark.createDataFrame(rows, "read_id string, library string, cell string, umi int")
    curve = {x["step"]: x for x in saturation.saturation_curve(df, ["library"], ["cell", "umi"], steps=10).collect()}
    p = {x["read_id"]: x["p"] for x in df.select("read_id", C.uniform(F.col("read_id")).alias("p")).collect()}
    back = {x["step"]: x for x in saturation.background_molecules(df, ["library"], "cell", ["umi"], share=0.2, steps=10).collect()}
    for k in range(1, 11):
        seen = [x for x in rows if p[x[0]] < k / 10]
        assert curve[k]["reads"] == len(seen) and curve[k]["umi"] == len({x[2:] for x in seen})
        per = [len({x[3] for x in seen if x[2] == c}) for c in {x[2] for x in seen}]
        if k in back:
            assert back[k]["background_umi"] == sum(n for n in per if n <= 1 + int(0.2 * sum(per)))


def test_fit_recovers_a_logistic(spark):
    x = np.linspace(5, 12, 40)
    rows = [("L", i, float(np.exp(v)), float(9000 / (1 + np.exp(-0.9 * (v - 9.5))))) for i, v in enumerate(x)]
    f = saturation.fit_saturation(spark.createDataFrame(rows, "library string, step int, reads double, umi double"), ["library"]).first()
    assert abs(f["top"] - 9000) < 1 and abs(f["rate"] - 0.9) < 1e-3 and abs(f["mid"] - 9.5) < 1e-3


def test_routes_follow_the_probability(spark):
    rows = [(f"a{i}", "P", True, False) for i in range(9)] + [("b", "P", False, False)] + [(f"c{i}", "M", i % 2 == 0, i % 2 == 1) for i in range(4)] + [("d", "N", False, False)]
    both = spark.createDataFrame(rows, "read_id string, barcode string, good_primary boolean, good_spike boolean")
    out = species.route(both, species.barcode_probability(both)).collect()
    to = {}
    for x in out:
        to.setdefault(x["read_id"], set()).add((x["destination"], x["ambig"]))
    assert to["a0"] == to["b"] == {("primary", False)}
    assert to["c1"] == {("primary", True), ("spikein", True)} and to["d"] == {("primary", False), ("spikein", False)}


def test_ids_are_dense_and_sorted(spark):
    counts = spark.createDataFrame([(f"f{i % 37}", f"c{i % 11:02d}", 1) for i in range(400)], "feature string, cell string, n long").distinct()
    got = counting.dense_ids(counts, "cell").orderBy("id").collect()
    assert [x["cell"] for x in got] == sorted({x["cell"] for x in counts.collect()}) and [x["id"] for x in got] == list(range(11))


def test_trimming(spark):
    rows = [("ACGTACGTACGTTTTTGGAAGG", "I" * 22), ("ACGTACGTACGTACGT", "I" * 12 + "!!!!"), ("GG", "II"), (None, None)]
    out = reads.trim_reads(spark.createDataFrame(rows, "seq string, qual string"), ["TTTTGGAAGGCC"], min_length=4).collect()
    assert sorted(x["seq"] for x in out) == ["ACGTACGTACGT", "ACGTACGTACGT"] and all(len(x["seq"]) == len(x["qual"]) for x in out)


def test_quadratic_fit(spark):
    rows = [(x / 10, 1 + 2 * x / 10 - 3 * (x / 10) ** 2) for x in range(20)]
    c = matrix.quadratic_fit(spark.createDataFrame(rows, "x double, y double"), "x", "y").first()
    assert np.allclose(tuple(c), (1, 2, -3))


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_nearest_equals_brute_force(spark, block_rows):
    x = np.random.default_rng(6).normal(size=(90, 5))
    df = spark.createDataFrame([(i, [float(v) for v in e]) for i, e in enumerate(x)], "k long, x array<double>")
    got = {(r["k"], r["rank"]): r["neighbour"] for r in matrix.nearest(df, 4, key="k", x="x", unit=block_rows).collect()}
    d = np.square(x[:, None] - x[None]).sum(2)
    np.fill_diagonal(d, np.inf)
    for i in range(90):
        assert [got[i, j + 1] for j in range(4)] == np.argsort(d[i])[:4].tolist()


def test_enriched_bins_find_the_planted_peak(spark):
    r = random.Random(7)
    rows = [("ab", "c", r.randint(0, 100_000)) for _ in range(2000)] + [("ab", "c", 50_000 + r.randint(0, 399)) for _ in range(200)]
    found = peaks.call_peaks(spark.createDataFrame(rows, "antibody string, contig string, pos long"), q=0.01).where("kind = 'narrow'").collect()
    assert [(p["f_start"], p["f_end"]) for p in found] == [(50_000, 50_400)]


def test_select_cells_cuts_between_modes(spark):
    r = random.Random(8)
    rows = [("L", f"c{i}", int(math.exp(r.gauss(3, 0.3))), int(math.exp(r.gauss(3, 0.3))), 5, 5) for i in range(300)]
    rows += [("L", f"d{i}", int(math.exp(r.gauss(8, 0.3))), int(math.exp(r.gauss(8, 0.3))), 5, 5) for i in range(200)] + [("one", "x", 5, 5, 600, 1), ("one", "y", 5, 5, 1, 1), ("one", "z", 5, 5, 600, 500)]
    rows += [("L", f"off{i}", 3000, 30, 900, 900) for i in range(5)]  # far off the diagonal
    out = matrix.select_cells(spark.createDataFrame(rows, "library string, cell string, rna_reads int, dna_reads int, rna_umis int, dna_umis int"), ["library"]).collect()
    kept = {x["cell"] for x in out if x["keep"]}
    assert {x for x in kept if x[0] != "d"} == {"z"}  # without modes both assays need the umis
    assert sum(x[0] == "d" for x in kept) >= 190
    cuts = {(x["cut"], x["cut2"]) for x in out if x["library"] == "L"}
    assert len(cuts) == 1 and 2.5 < next(iter(cuts))[0] < 4.6


def test_select_cells_of_rna_alone(spark):
    r = random.Random(7)
    rows = [("NA", f"u{i}", int(10 ** r.gauss(4.4, 0.1)), 1, 600, 0) for i in range(300)] + [("NA", f"d{i}", int(10 ** r.gauss(2.4, 0.2)), 1, 5, 0) for i in range(300)]
    rows += [("H3", f"x{i}", int(10 ** r.gauss(4.4, 0.1)), 0, 600, 600) for i in range(50)]  # off the diagonal: no density, umis decide
    df = spark.createDataFrame(rows, "antibody string, cell string, rna_reads int, dna_reads int, rna_umis int, dna_umis int").withColumn("alone", F.col("antibody") == "NA")
    out = {x["cell"]: x for x in matrix.select_cells(df, ["antibody"], rna_only="alone").collect()}
    assert all(out[f"u{i}"]["keep"] for i in range(300)) and not any(out[f"d{i}"]["keep"] for i in range(300))
    assert all(out[f"x{i}"]["keep"] and out[f"x{i}"]["cut"] is None for i in range(50))
    assert out["u0"]["theta"] == pytest.approx(math.pi / 4) and out["u0"]["r"] == pytest.approx(math.log10(rows[0][2] + 1))
    by = {x["cell"]: x["keep"] for x in matrix.select_cells(df, ["antibody"], rna_only="alone", umis_only=True).collect()}
    assert by == {x[1]: x[4] >= 350 and x[5] >= 350 for x in rows}


def test_files(spark, tmp_path):
    rows = [(f"r{i}", "ACGT" * (i % 3 + 1), "IIII" * (i % 3 + 1), ["SM1", "*", None][i % 3]) for i in range(12)]
    writers.write_fastq(spark.createDataFrame(rows, "name string, seq string, qual string, sample string"), str(tmp_path / "fq"), ["sample"])
    back = readers.read_fastq(spark, str(tmp_path / "fq" / "sample=*" / "*")).collect()
    assert sorted((x["name"], x["seq"], x["qual"]) for x in back) == sorted(x[:3] for x in rows)
    assert {p.name for p in (tmp_path / "fq").glob("sample=*")} == {"sample=SM1", "sample=unknown"}
    (tmp_path / "a_R1.fq").write_text("@x 1\nAC\n+\nII\n@y 1\nGG\n+\nII\n")
    (tmp_path / "a_R2.fq").write_text("@x 2\nTT\n+\nII\n@y 2\nCC\n+\nII\n")
    both = readers.paired_scan(spark, str(tmp_path / "a_R1.fq"), str(tmp_path / "a_R2.fq")).orderBy("ordinal").collect()
    assert [(x["name"], x["seq1"], x["seq2"]) for x in both] == [("x", "AC", "TT"), ("y", "GG", "CC")]
    (tmp_path / "a_R2.fq").write_text("@x 2\nTT\n+\nII\n@z 2\nCC\n+\nII\n")
    with pytest.raises(Exception, match="different reads"):
        readers.paired_scan(spark, str(tmp_path / "a_R1.fq"), str(tmp_path / "a_R2.fq")).collect()
    (tmp_path / "w.fa").write_text(">b\nAC\nGT\n>a\nTTTT\n")
    assert [(x["rank"], x["name"], x["seq"]) for x in readers.read_fasta(spark, str(tmp_path / "w.fa")).orderBy("rank").collect()] == [(1, "b", "ACGT"), (2, "a", "TTTT")]
    (tmp_path / "x.sam").write_text("@HD\tVN:1.6\nq1\t99\tchr1\t11\t60\t5S10M2I3D5M\t=\t100\t120\tACGT\tIIII\tMI:Z:AA\tXX:i:5\nq2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    sam = {x["read_id"]: x for x in readers.read_sam(spark, str(tmp_path / "x.sam")).collect()}
    assert (sam["q1"]["pos"], sam["q1"]["end_pos"], sam["q1"]["is_read1"], sam["q1"]["tags"]) == (10, 28, True, {"MI": "AA", "XX": "5"})
    assert (sam["q2"]["is_mapped"], sam["q2"]["contig"]) == (False, None)


def test_digest_records_by_file(spark):
    d = spark.createDataFrame([("s1", "a.fastq.gz", "b.fq"), ("s2", "a_ds.fq.gz", "c.fq"), ("s3", "gaz.fastq.gz", "d.fq")], "sequence_id string, fastq1 string, fastq2 string")
    assert {x["sequence_id"] for x in readers.digest_for(d, "/in/a.fq.gz").collect()} == {"s1", "s2"}
    assert {x["sequence_id"] for x in readers.digest_for(d, "gaz.fastq.gz", "s3").collect()} == {"s3"}


def test_trimming_helpers_equal_plain_loops():
    r = random.Random(1)

    def quality_end(q, cutoff):
        total = low = 0
        end = len(q)
        for i in range(len(q) - 1, -1, -1):
            total += ord(q[i]) - 33 - cutoff
            if total > 0:
                break
            if total <= low:
                low, end = total, i
        return end

    def cost(a, b):
        """Edits between two strings, by rows."""
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    def adapter_start(s, adapter):
        best = len(s)
        for p in range(5, len(adapter) + 1):
            most = int(0.1 * p)
            ends = lambda i: range(i, len(s) + 1) if p == len(adapter) else [len(s)]  # noqa: B023, E731
            least = {i: min(cost(adapter[:p], s[i:e]) for e in ends(i)) for i in range(len(s) + 1)}
            fits = [i for i, c in least.items() if c <= most]
            if fits:
                best = min(best, min(range(fits[0], fits[0] + most + 1), key=lambda i: (least.get(i, 99), i)))
        return best

    quals = ["".join(chr(33 + r.choice([2, 10, 19, 20, 21, 30, 40])) for _ in range(r.randint(0, 30))) for _ in range(1000)] + [""]
    assert reads._quality_ends(quals, 20).tolist() == [quality_end(q, 20) for q in quals]
    adapters = ["ACGTACGTGGCATTGCATGA", "TTGACC"]
    seqs = ["".join(r.choice("ACGT") for _ in range(r.randint(0, 30))) + r.choice(["", adapters[0], adapters[0][:6], adapters[0][:15], adapters[1], "ACGTACCTGGCATTGCATGA", "ACGTACGTGCATTGCATGA", "ACGTACGTGGCATTAGCATGA", "ACGTACGTGGCATTGCAG"]) + "ACG" * r.randint(0, 2) for _ in range(150)] + [""]
    assert reads._adapter_starts(seqs, adapters, 5, 0.1).tolist() == [min(adapter_start(s, a) for a in adapters) for s in seqs]


def test_ranked_with_wide_rows_and_merging_of_partitions(spark):
    """Column pruning and merged partitions don't make sizes and rows differ."""
    from pyspark.sql import functions as F

    from strandlake.operators import counting

    rows = spark.range(40_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 2).alias("g"), F.repeat(F.lit("x"), 200).alias("wide"), F.col("id"))
    for merging in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merging)
        got = counting.ranked(rows, ["k"], "place", ["g"])
        whole = got.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("place").alias("d"), F.max("place").alias("top"), F.sum(F.length("wide")).alias("w")).collect()
        assert {(r["n"], r["d"], r["top"], r["w"]) for r in whole} == {(20_000, 20_000, 19_999, 4_000_000)}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
