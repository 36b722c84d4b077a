"""The data sources against plain readers, over every way to cut a file."""

import gzip
import random

import pytest

from pyspark.sql import functions as F

from strandlake.sources import blocks, committed, readers, records, writers


def fastq_text(seed, n):
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = r.choice([0, 1, 5, 30])
        qual = "".join(r.choice("@+I!~>") for _ in range(k))  # quality lines may look like names
        out.append((f"r{i} {r.random()}", "".join(r.choice("ACGTN") for _ in range(k)), qual))
    return out, "".join(f"@{n}\n{s}\n+{r.choice(['', 'x'])}\n{q}\n" for n, s, q in out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fastq_ranges_hold_every_record_once(tmp_path, monkeypatch, seed):
    monkeypatch.setattr(records, "CHUNK", 50)
    want, text = fastq_text(seed, 40)
    f = tmp_path / "a.fq"
    for body in (text, text[:-1], text + "\n\n"):
        f.write_text(body)
        for split in (1, 7, 64, 333, 10_000):
            got = []
            for at in range(0, len(body), split):
                for name, seq, _, qual in records.fastq_records(records.Range(str(f), at, min(len(body), at + split))):
                    got += zip(name, seq, qual, strict=True)
            assert [(n[1:].decode(), s.decode(), q.decode()) for n, s, q in got] == want


def test_a_cut_record_is_an_error(tmp_path):
    f = tmp_path / "a.fq"
    f.write_text("@x\nAC\n+\nII\n@y\nAC\n+")
    with pytest.raises(ValueError, match="within a record"):
        list(records.fastq_records(records.Range(str(f), 0, 18)))


@pytest.mark.parametrize("seed", [1, 2])
def test_fasta_ranges_hold_every_record_once(tmp_path, monkeypatch, seed):
    monkeypatch.setattr(records, "CHUNK", 40)
    r = random.Random(seed)
    want = [(f"c{i} x>y", ["ACGT"[: r.randint(0, 4)] * r.randint(1, 9) for _ in range(r.randint(0, 6))]) for i in range(25)]
    body = "no name\n" * (seed - 1) + "".join(f">{n}\n" + "".join(f"{x}\n" for x in s) for n, s in want)
    f = tmp_path / "a.fa"
    f.write_text(body)
    for split in (1, 9, 77, 5_000):
        got = [(n.decode(), b"".join(s).decode()) for at in range(0, len(body), split) for n, s in records.fasta_records(records.Range(str(f), at, min(len(body), at + split)))]
        assert got == [(n, "".join(s)) for n, s in want]


def test_scan_numbers_records_without_an_exchange(spark, tmp_path):
    want, text = fastq_text(5, 400)
    (tmp_path / "a.fq").write_text(text.replace("\n", "\r\n"))
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write(text)
    (tmp_path / "_hidden").write_text("x")
    (tmp_path / "empty.fq").write_text("")
    df = readers.read_fastq(spark, str(tmp_path), split=700)
    assert df.rdd.getNumPartitions() > 10
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    for name in ("a.fq", "b.fq.gz"):
        got = sorted((r["ordinal"], r["name"], r["seq"], r["qual"]) for r in df.collect() if r["path"].endswith(name))
        assert got == [(i, *x) for i, x in enumerate(want)]
    with pytest.raises(FileNotFoundError):
        readers.read_fastq(spark, str(tmp_path / "none*"))
    (tmp_path / "w.fa").write_text(">a\nAC\n\nGT\r\n>b\n>c\nT\n")
    fa = readers.read_fasta(spark, str(tmp_path / "w.fa"), split=4)
    assert sorted((r["rank"], r["name"], r["seq"]) for r in fa.collect()) == [(1, "a", "ACGT"), (2, "b", ""), (3, "c", "T")]


# --- indexed blocks and committed sinks


def positions(spark, n=4000):
    r = random.Random(n)
    rows = [(f"chr{r.randint(1, 3)}", s := r.randint(0, 50_000), s + r.randint(1, 300), r.choice(["é", "c d", None]), r.choice([True, False, None]), r.random(), i) for i in range(n)]
    return rows, spark.createDataFrame([*rows, (None, 1, 2, "", None, 0.5, -1)], "contig string, start long, end long, name string, ok boolean, x double, i int")


def test_blocks_of_a_region_are_all_that_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 2_000)
    monkeypatch.setattr(blocks, "RUN", 1)
    rows, df = positions(spark)
    blocks.write_blocks(df, str(tmp_path / "b"), parts=3)
    back = blocks.read_blocks(spark, str(tmp_path / "b"))
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))
    with gzip.open(next((tmp_path / "b").glob("*.tsv.gz")), "rt") as f:  # any tool reads it whole
        assert len(next(f).rstrip("\n").split("\t")) == 7
    want = sorted(x[6] for x in rows if x[0] == "chr2" and x[1] < 21_000 and x[2] > 20_000)
    region = back.where("contig = 'chr2' AND start < 21000 AND end > 20000")
    assert sorted(x["i"] for x in region.collect()) == want
    wanted = blocks.Wanted("chr2", None, 20_999, 20_001)
    files, total, read = sorted((tmp_path / "b").glob("*.tsv.gz")), 0, 0
    for f in files:
        keep = blocks.blocks_of(blocks.File(str(f)[: -len(".tsv.gz")], wanted))
        raw = bytearray(f.read_bytes())
        total, read = total + len(raw), read + sum(n for _, n in keep)
        for k in range(len(raw)):
            if not any(at <= k < at + n for at, n in keep):
                raw[k] = 255
        f.write_bytes(raw)  # nothing but the region's blocks can be read any more
    assert 0 < read < total / 5
    assert sorted(x["i"] for x in region.collect()) == want
    assert back.where("contig = 'chr9'").count() == 0 and back.where("contig = 'chr1' AND start >= 60000").count() == 0
    with pytest.raises(Exception, match="gzip"):
        back.where("contig = 'chr1'").collect()


def test_blocks_of_nothing(spark, tmp_path):
    _, df = positions(spark, 1)
    blocks.write_blocks(df.where("i > 5"), str(tmp_path / "none"))
    assert blocks.read_blocks(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(Exception, match="Quotes|quot|CSV|line"):
        blocks.write_blocks(df.where("contig IS NOT NULL").withColumn("name", F.lit("a\tb")), str(tmp_path / "tab"))


def test_commit_removes_small_groups_and_lists_them(spark, tmp_path):
    rows = [(f"r{i}", "ACGT", "IIII", ["a", "a", "b", "*", None][i % 5] if i < 20 else "few") for i in range(22)]
    df = spark.createDataFrame(rows, "name string, seq string, qual string, sample string").repartition(3)
    path = str(tmp_path / "fq")
    writers.write_fastq(df, path, ["sample"], least=3)
    assert {(r["part"], r["rows"], r["kept"]) for r in committed.manifest_rows(spark, path).collect()} == {("sample=a", 8, True), ("sample=b", 4, True), ("sample=unknown", 8, True), ("sample=few", 2, False)}
    assert sorted(r["name"] for r in readers.read_fastq(spark, path).collect()) == sorted(f"r{i}" for i in range(20))
    left = [p.name for p in (tmp_path / "fq").rglob("*") if p.is_file()]
    assert all(n.startswith(("part-", "_manifest")) or n.endswith(".crc") for n in left)
    assert len(committed.files_of(path)) == len([n for n in left if n.startswith("part-")])
    writers.write_fastq(df.limit(0), str(tmp_path / "none"), ["sample"])
    assert committed.files_of(str(tmp_path / "none")) == []


def test_a_failed_write_leaves_no_manifest(spark, tmp_path):
    bad = spark.range(100).repartition(4).select(F.lit("p").alias("part"), F.when(F.col("id") == 70, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="broken"):
        committed.write_lines(bad, str(tmp_path / "x"))
    assert not (tmp_path / "x" / "_manifest.json").exists()


def test_matrix_market_over_many_files(spark, tmp_path):
    r = random.Random(3)
    want = {(f"g{r.randint(0, 40)}", f"c{r.randint(0, 30)}"): r.randint(1, 9) for _ in range(300)}
    counts = spark.createDataFrame([(*k, n) for k, n in want.items()], "feature string, cell string, n long").repartition(5)
    path = str(tmp_path / "m")
    writers.write_matrix_market(counts, path)
    head = (tmp_path / "m" / "counts" / "header").read_text().splitlines()
    assert head[0].startswith("%%MatrixMarket") and head[1].split() == [str(len({k[0] for k in want})), str(len({k[1] for k in want})), str(len(want))]
    entries, cells, features = readers.read_matrix_market(spark, path)
    cell, feature = ({x["id"]: x["name"] for x in df.collect()} for df in (cells, features))
    assert list(cell.values()) and sorted(cell.values()) == [cell[i] for i in range(1, len(cell) + 1)]
    assert {(feature[x["row"]], cell[x["col"]]): x["n"] for x in entries.collect()} == want
    (tmp_path / "m" / "counts" / "header").write_text("%%\n1 2 3\n")
    with pytest.raises(ValueError, match="size line"):
        readers.read_matrix_market(spark, path)


def test_numbered_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n\ny\nz")
    got = {(r["ordinal"], r["value"]) for r in readers.read_lines(spark, str(tmp_path / "a.txt"), split=2).collect()}
    assert got == {(0, "x"), (1, ""), (2, "y"), (3, "z")}


def test_mates_are_read_side_by_side(spark, tmp_path):
    """Plain files cut anywhere and compressed ones, without an exchange; one mate has records that the other lacks."""
    want, _ = fastq_text(8, 300)
    r = random.Random(9)
    names = [f"r{i}" for i in range(300)]
    one = "".join(f"@{n} L{i % 2} R1\n{s}\n+\n{q}\n" for i, (n, (_, s, q)) in enumerate(zip(names, want, strict=True)))
    other = "".join(f"@{n} R2\n{'ACGT' * r.randint(0, 20)}{n}\n+\n{'I' * r.randint(0, 90)}\n" for n in [*names, "more", "most"])
    for folder, text in (("m1", one), ("m2", other)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / f"a_R{folder[1]}.fq").write_text(text)
        with gzip.open(tmp_path / folder / f"b_R{folder[1]}.fq.gz", "wt") as f:
            f.write(text)
    (tmp_path / "m1" / "c_R1.fq").write_text(one)
    with gzip.open(tmp_path / "m2" / "c_R2.fq.gz", "wt") as f:
        f.write(other)
    seq2 = [x.split("\n")[1] for x in other.split("@")[1:]]
    for split in (150, 1_111, 20_000, None):
        both = readers.paired_scan(spark, str(tmp_path / "m1"), str(tmp_path / "m2"), split=split)
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        rows = both.collect()
        for name in "abc":
            got = sorted((x["ordinal"], x["name"], x["comment"], x["seq1"], x["qual1"], x["seq2"]) for x in rows if x["pair_id"] == name)
            assert got == [(i, n, f"L{i % 2} R1", s, q, seq2[i]) for i, (n, (_, s, q)) in enumerate(zip(names, want, strict=True))]


def test_parts_that_come_mixed(spark, tmp_path):
    df = spark.range(1000).repartition(3).selectExpr("inline(array(struct(concat('p=', id % 2) AS part, CAST(id AS STRING) AS value), struct('q' AS part, CAST(-id AS STRING) AS value)))")
    committed.write_lines(df, str(tmp_path / "x"), together=2)
    assert sorted(int(x) for f in committed.files_of(str(tmp_path / "x")) for x in open(f)) == sorted([*range(1000), *(-i for i in range(1000))])
    one = df.where("part <> 'p=1'")
    committed.write_lines(one, str(tmp_path / "y"), together=2)
    files = committed.files_of(str(tmp_path / "y"))
    assert len(files) == 6
    for f in (x for x in files if "/q/" in x):
        assert set(open(f.replace("/q/", "/p=0/"))) <= {x.lstrip("-") for x in open(f)}


def test_paired_reads_of_ids_that_stand_several_times(spark, tmp_path):
    """Also how much it writes: the mates were stored as a table, written plain, and shuffled three times."""
    import os
    from pathlib import Path

    import duckdb

    from strandlake.functions.shared import shared_dir
    from strandlake.plans import more_queries  # noqa: F401
    from strandlake.plans.queries import ORACLES, QUERIES

    con, top = duckdb.connect(), "/root/testdata/sf0.001"
    for name in ("part", "nation"):
        os.symlink(f"{top}/{name}.parquet", tmp_path / f"{name}.parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{top}/{name}.parquet'")
    con.sql(f"COPY (SELECT * FROM '{top}/lineitem.parquet' UNION ALL SELECT * FROM '{top}/lineitem.parquet' WHERE l_orderkey % 50 = 0 UNION ALL (SELECT * FROM '{top}/lineitem.parquet' WHERE l_orderkey % 100 = 0)) TO '{tmp_path}/lineitem.parquet'")
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    folder = Path(shared_dir(spark).removeprefix("file:"))
    written = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    before = written()
    df = QUERIES["paired_reads"](spark, str(tmp_path))
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(con.sql(ORACLES["paired_reads"]).project(", ".join(df.columns)).fetchall())
    assert len(got) > len(set(got))
    assert written() - before < 100 * len(got)
