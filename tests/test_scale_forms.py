"""Operators that never hold a whole group, against plain versions, with bounds small enough to take every path."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.operators import intervals, matrix, peaks, ranks


@pytest.mark.parametrize(("few", "bins"), [(1 << 16, 4096), (4, 3), (1, 2)])
def test_quantiles_equal_numpy(spark, few, bins):
    r = random.Random(few)
    groups = {"a": [r.gauss(0, 1) for _ in range(300)], "b": [1.0] * 50 + [2.0], "c": [5.0], "d": [10.0 ** r.randint(-6, 6) for _ in range(120)], "e": [float(r.randint(0, 9)) for _ in range(200)]}
    rows = [(g, x) for g, v in groups.items() for x in v] + [("a", None), ("f", None)]
    shares = [0.0, 0.05, 0.25, 0.5, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = {x["g"]: (x["n"], x["q"]) for x in ranks.quantiles(df, ["g"], "v", shares, few=few, bins=bins).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        assert got[g][0] == len(v)
        np.testing.assert_allclose(got[g][1], np.quantile(v, shares), rtol=1e-12)
    got = {x["g"]: x["q"] for x in ranks.quantiles(df, ["g"], "v", shares, element=True, few=few, bins=bins).collect()}
    for g, v in groups.items():
        assert got[g] == [sorted(v)[min(len(v) - 1, int(s * len(v)))] for s in shares]
    whole = ranks.quantiles(df, [], "v", [0.5], few=few, bins=bins).first()
    assert whole["q"][0] == pytest.approx(np.median([x for v in groups.values() for x in v]))
    assert ranks.quantiles(df.limit(0), [], "v", [0.5]).collect() == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_union_of_intervals_over_many_blocks(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice("ab"), r.choice(["x", "y"]), s := r.randint(0, 3_000), s + r.choice([0, 3, 10, 900 if seed == 2 else 12])) for _ in range(400)]
    want = {}
    for g in {x[:2] for x in rows}:
        out = []
        for s, e in sorted(x[2:] for x in rows if x[:2] == g):
            if out and s <= out[-1][1]:
                out[-1] = [out[-1][0], max(out[-1][1], e), out[-1][2] + 1]
            else:
                out.append([s, e, 1])
        want[g] = out
    df = spark.createDataFrame(rows, "tag string, contig string, f_start long, f_end long")
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        merged = intervals.merge_intervals(df, ["tag", "contig"])
        got = merged.collect()
        named = intervals.number_peaks(merged, "tag").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((x["tag"], x["contig"], x["f_start"], x["f_end"], x["n"]) for x in got) == sorted((*g, *x) for g, v in want.items() for x in v)
    for tag in "ab":
        order = [f"{c}:{s}:{e}" for c in "xy" for s, e, _ in want[tag, c]]
        assert sorted(x["name"] for x in named if x["tag"] == tag) == sorted(f"{tag}_Peak.{i}@{x}" for i, x in enumerate(order, 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_start_enrichment_equals_a_plain_sum(spark, seed):
    r = random.Random(seed)
    reach, width = 40, 7
    features = [(f"G{i}", "c", s := r.randint(0, 600), s + r.randint(5, 90), r.choice("+-")) for i in range(25)]
    reads = [("c", s := r.randint(0, 700), r.choice("ABCD"), s + r.choice([1, 3, 20, 120])) for _ in range(60 * seed)]
    once = {}
    for c, s, u, e in reads:
        once[c, s, u] = max(e, once.get((c, s, u), 0))
    want = {}
    for name, _, fs, fe, strand in features:
        left = (fe if strand == "-" else fs) - reach
        depth = np.zeros(2 * reach, int)
        for (_, s, _), e in once.items():
            if e >= left and s <= left + 2 * reach - 1:
                depth[max(0, s - left) : max(0, min(2 * reach, e - left))] += 1
        v = np.array([depth[i : i + width].sum() for i in range(2 * reach - width)])
        if v.max() > 0:
            edge = (v[0] + v[-1]) / 2
            want[name] = v.max() / (edge if edge > 0 else v[v > 0].min())
    f = spark.createDataFrame(features, "name string, contig string, f_start long, f_end long, strand string")
    x = spark.createDataFrame(reads, "contig string, pos long, umi string, end_pos long")
    got = intervals.start_enrichment(x, f, ["contig", "pos", "umi"], reach=reach, bin=width)
    assert {r["name"]: pytest.approx(r["score"]) for r in got.collect()} == want
    assert got.where(F.col("score") <= 0).count() == 0


@pytest.mark.parametrize("least", [0.2, 0.5, 0.8, 1.0])
def test_similar_cells_equal_the_full_join(spark, least):
    r = random.Random(int(least * 10))
    rows = []
    for c in range(60):
        base = c // 4
        mine = {f"f{base}_{k}" for k in range(10)} if r.random() < 0.9 else {f"g{r.randint(0, 99)}" for _ in range(r.randint(1, 9))}
        mine = {x if r.random() < 0.96 else f"h{r.randint(0, 30)}" for x in mine} | {"common"}
        rows += [(f, f"c{c:02d}", r.choice([0, *[1, 2] * 9])) for f in mine]
    counts = spark.createDataFrame(rows, "feature string, cell string, n int")
    want = sorted((x["i"], x["j"], x["inter"], x["ni"], x["nj"], x["jaccard"]) for x in matrix.jaccard(counts).collect() if x["jaccard"] >= least)
    assert sorted(map(tuple, matrix.similar_cells(counts, least).collect())) == want
    assert len(want) > 3 or least == 1.0


@pytest.mark.parametrize(("rows", "columns"), [(200, 30), (60, 10_000)])
def test_singular_values_equal_numpy(spark, rows, columns):
    r = np.random.default_rng(columns)
    x = (r.normal(size=(rows, 12)) * 0.7 ** np.arange(12)) @ r.normal(size=(12, columns)) + 1e-3 * r.normal(size=(rows, columns))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell long, x array<double>").repartition(3)
    value, vec = matrix.singular_basis(df, 4)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    np.testing.assert_allclose(value, s[:4], rtol=1e-8)
    np.testing.assert_allclose(np.abs((vec * vt[:4].T).sum(0)), 1, rtol=1e-6)
    got = {y["cell"]: y["sv"] for y in matrix.singular_vectors(df, 3).collect()}
    np.testing.assert_allclose(np.abs(np.array([got[i] for i in range(rows)])), np.abs(x @ vt[1:4].T), rtol=1e-4, atol=1e-4)


def test_planted_narrow_and_broad_peaks(spark):
    r = np.random.default_rng(5)
    rate = np.full(2_000, 6.0)
    rate[[300, 301, 900]] = 60  # narrow
    rate[1_200:1_230] = 14  # broad: weak all over, strong here and there
    rate[1_215] = 60
    reads = [("ab", "c1", int(b) * 200 + int(r.integers(0, 200))) for b, n in enumerate(r.poisson(rate)) for _ in range(n)]
    reads += [("other", "c1", int(p)) for p in r.integers(0, 400_000, 4_000)]
    df = spark.createDataFrame(reads, "antibody string, contig string, pos long")
    got = peaks.call_peaks(df, around=200, q=0.01, weak=0.05, block=97).collect()
    bins = lambda kind, name="ab": {b for x in got if x["kind"] == kind and x["antibody"] == name for b in range(x["f_start"] // 200, x["f_end"] // 200)}
    assert {300, 301, 900, 1_215} <= bins("narrow") <= bins("broad")
    assert len(bins("broad") & set(range(1_200, 1_230))) >= 5 and len(bins("narrow") - {300, 301, 900, *range(1_200, 1_230)}) <= 3
    assert not bins("narrow", "other")
    whole = peaks.peak_set(spark.createDataFrame(got)).collect()
    assert {b for x in whole for b in range(x["f_start"] // 200, x["f_end"] // 200)} == bins("broad") | bins("broad", "other")
    # blocks don't change the sums over neighbours
    a, b = (sorted(map(tuple, peaks.bin_rates(df, "antibody", block=k).collect())) for k in (7, 4096))
    assert [x[:5] for x in a] == [x[:5] for x in b] and np.allclose([x[5] for x in a], [x[5] for x in b])
    # a control that rises at the same places explains them away
    control = df.where("antibody = 'ab'").drop("antibody")
    assert peaks.call_peaks(df, around=200, q=0.01, weak=0.05, control=control).where("antibody = 'ab' AND kind = 'narrow'").count() == 0


def test_poisson_tails():
    import math

    k, rate = np.array([0, 1, 5, 30, 3, 1_000]), np.array([2.0, 0.5, 1.5, 4.0, 3.0, 700.0])
    got = peaks.poisson_tail(k, rate)
    for n, lam, p in zip(k[:4], rate[:4], got[:4], strict=True):
        want = 1 - sum(math.exp(-lam) * lam**i / math.factorial(i) for i in range(n)) if n > lam else 1
        assert p == pytest.approx(want, abs=1e-14)
    assert got[4] == 1 and 0 < got[5] < 1e-20


@pytest.mark.parametrize(("spread", "share"), [(0.01, 0.4), (5.0, 1.01)])
def test_neighbours_equal_brute_force(spark, spread, share):
    """Groups of near vectors hardly meet each other; vectors without groups all do."""
    r = np.random.default_rng(int(spread * 100))
    x = r.normal(size=(30, 8))[r.integers(0, 30, 400)] + spread * r.normal(size=(400, 8))
    x[5] = x[6]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").repartition(3)
    compared = spark.sparkContext.accumulator(0)
    got = {}
    for row in matrix.nearest(df, 5, key="id", x="x", unit=20, compared=compared).collect():
        got.setdefault(row["id"], {})[row["rank"]] = (row["neighbour"], row["distance"])
    d = np.square(x[:, None] - x[None]).sum(2)
    for i in range(400):
        want = sorted((d[i, j], j) for j in range(400) if j != i)[:5]
        assert [got[i][n][0] for n in range(1, 6)] == [j for _, j in want]
        np.testing.assert_allclose([got[i][n][1] for n in range(1, 6)], [y for y, _ in want], rtol=1e-9, atol=1e-12)
    assert 0 < compared.value / 400**2 < share
    assert matrix.nearest(df.limit(0), 5, key="id", x="x").collect() == []
    few = matrix.nearest(df.limit(3), 5, key="id", x="x").collect()
    assert len(few) == 6


def test_neighbours_store_no_row_for_each_unit(spark):
    """Vectors without groups meet all units; until then each was written once for each of them."""
    from pathlib import Path

    from strandlake.functions.shared import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    written = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    x = np.random.default_rng(4).normal(size=(3000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").repartition(5)
    before = written()
    got = sorted((r["id"], r["rank"], r["neighbour"]) for r in matrix.nearest(df, 3, key="id", x="x", unit=20).collect())
    assert 0 < written() - before < 4 * x.nbytes
    d = np.square(x[:, None] - x[None]).sum(2)
    np.fill_diagonal(d, np.inf)
    assert got == [(i, n + 1, j) for i in range(3000) for n, j in enumerate(np.argsort(d[i])[:3].tolist())]


def test_neighbours_of_ids_with_several_rows(spark):
    x = np.random.default_rng(5).normal(size=(120, 3)).round(1).astype(np.float32)
    x[20:60] = x[7]  # more copies than neighbours, so ids decide
    keys = [None if i == 3 else i % 90 for i in range(120)]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, x, strict=True)], "id long, x array<float>").repartition(3)
    got = {}
    for r in matrix.nearest(df, 4, key="id", x="x", unit=16).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["distance"], r["neighbour"]))
    pairs = {}
    for k, v in zip(keys, x.astype(float), strict=True):
        pairs.setdefault(k, []).extend((sum((v - w) ** 2), n) for n, w in zip(keys, x.astype(float), strict=True) if n is not None and n != k)
    del pairs[None]
    assert {k: sorted(v) for k, v in got.items()} == {k: [(i, *p) for i, p in enumerate(sorted(v)[:4], 1)] for k, v in pairs.items()}


@pytest.mark.parametrize("single", [True, False])
@pytest.mark.parametrize("scale", [1e-25, 1.0, 1e25])
def test_units_meet_in_pieces(monkeypatch, single, scale):
    monkeypatch.setattr(matrix, "SCORED", 700)
    monkeypatch.setattr(matrix, "MEASURED", 60)
    x = (np.random.default_rng(6).normal(size=(300, 6)) * scale + 3 * scale).astype(np.float32).astype(float)
    x[100:140] = x[50]
    keys = np.random.default_rng(7).permutation(300)
    held = matrix._Nearest(np.zeros(90, int), keys[:90], x[:90], 5, single)
    for start in range(0, 300, 45):
        held.meet(np.arange(90), keys[start : start + 45], x[start : start + 45])
    for i in range(90):
        d = np.square((x - x[i]).T).sum(0)
        order = [j for j in np.lexsort((keys, d)) if j != i][:5]
        assert held.name[i].tolist() == keys[order].tolist() and held.found[i].tolist() == d[order].tolist()
