import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import cells, embeddings, graph, lines, ngram_join

from . import plain

DOCS = "doc_id long, text string, cell string, node long, size long, source string"


def near_copies(seed, n):
    """Texts with copies, near copies, shared passages, short and empty ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6)))
    common = [word() for _ in range(12)]
    bases = [[word() for _ in range(r.randint(5, 120))] for _ in range(max(2, n // 6))]
    out = []
    for i in range(n):
        kind = r.random()
        w = list(r.choice(bases))
        if kind < 0.6:
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = word()
        elif kind < 0.75:
            w = common + [word() for _ in range(r.randint(3, 40))]
        elif kind < 0.85:
            w = w[: r.randint(1, 4)]
        sep = r.choice([" ", "\n", "\t  "])
        out.append((i, [None, "", " \n", sep.join(w).upper()][min(3, r.randint(0, 40))], "x", 1, 2, "s"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    rows = near_copies(seed, 240)
    got = {r["doc_id"]: r for r in ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()}
    sets = {r[0]: plain.shingles(r[1]) for r in rows}
    find = plain.components(plain.linked(sets))
    assert len(got) == len(rows)
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == {i: find(i) for i in sets}


def test_jaccard_with_common_order_first(spark, monkeypatch):
    """Any order is exact, also one in which most shingles count as common."""
    monkeypatch.setattr(ngram_join, "SAMPLE", 1)
    monkeypatch.setattr(ngram_join, "COMMON_LEAST", 2)
    rows = near_copies(3, 150)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()}
    find = plain.components(plain.linked({r[0]: plain.shingles(r[1]) for r in rows}))
    assert got == {i: find(i) for i in got}


def test_jaccard_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (4, "A B C D E F"), (4, "a b c d e f"), (5, "x"), (6, "x"), (7, "x y"), (8, long), (9, long + " z")]
    got = ngram_join.jaccard_components(spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, component_id string")).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {
        (None, 2, None), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 2, 1), (5, 1, 5), (6, 1, 5), (7, 1, 7), (8, 59_996, 8), (9, 59_997, 8)
    }
    assert ngram_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_jaccard_of_ids_with_several_texts(spark):
    """Every text of an id finds its own partners."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    for ids in ([1, 1, 2, 3], [3, 3, 2, 1], [1, 4, 2, 3]):
        rows = list(zip(ids, [a, b, f"{a} z", f"{b} z"], strict=True))
        got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        want = [(ids[0], min(ids[0], ids[2])), (ids[1], min(ids[1], ids[3])), (ids[2], min(ids[0], ids[2])), (ids[3], min(ids[1], ids[3]))]
        assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted(want)


@pytest.mark.parametrize("seed", [4, 5])
def test_jaccard_of_repeated_ids_equals_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(r.randrange(60), *x[1:]) for x in near_copies(seed, 160)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    sets = {k: plain.shingles(x[1]) for k, x in enumerate(rows)}
    find = plain.components(plain.linked(sets))
    least = {}
    for k, x in enumerate(rows):
        least[find(k)] = min(x[0], least.get(find(k), x[0]))
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == sorted((x[0], len(sets[k]), least[find(k)]) for k, x in enumerate(rows))


def test_which_copy_stays_does_not_depend_on_the_order(spark):
    rows = [(1, "a b c d e f", s) for s in "pqrs"] + [(2, "g h i j k l", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {tuple(map(tuple, ngram_join.keep_one(d).orderBy("doc_id").collect())) for d in (docs, docs.orderBy(F.desc("source")), docs.repartition(4))}
    assert len(kept) == 1 and [r[0] for r in next(iter(kept))] == [1, 2]


def test_keep_one_of_each_group_whatever_the_ids(spark):
    x = "a b c d e f"
    rows = [(1, x, "p"), (2, x, "q"), (None, x, "r"), (3, None, "s"), (4, "one id two texts that differ here", "t"), (4, "the other text of that id is this", "u"), (5, "just the same row twice here", "v"), (5, "just the same row twice here", "v"), (None, "without id and alone so it stays", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["component_id"] for r in kept.collect()) == ["p", "s", "t", "u", "v", "w"]


def test_many_rounds_of_pivots_give_the_same_components(spark):
    """Two large cells of nodes on a line: neighbours link, so one pivot settles little."""
    places = {i: i for i in range(60)}
    rows = [("a", i, 10, [0]) for i in range(60)] + [("b", i, 10, [0]) for i in range(0, 60, 2)]

    def judge(pairs, n):
        d = F.abs(F.col("a") - F.col("b"))
        return pairs.select("a", "b", (d / 5.0).alias("lo"), (d / 5.0).alias("hi"), (d <= 1).alias("linked"))

    label = cells.link_cells(spark.createDataFrame(rows, "cell string, node long, size long, sketch array<long>"), judge)
    assert {(r["node"], r["component"]) for r in label.collect()} == {(i, 0) for i in places}


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (2001, 2000), (2000, 2001)]
    random.Random(4).shuffle(edges)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    find = plain.components(edges)
    assert got == {i: find(i) for i in got} and len(got) == 201 + 50 + 2
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_further_edges_extend_components(spark):
    """Rounds of linking follow their own edges only, whichever way these join what is there."""
    rng = random.Random(5)
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    for old, new in [(40, 40), (0, 30), (40, 0), (60, 3)]:
        edges = [[(rng.randrange(80), rng.randrange(80)) for _ in range(n)] for n in (old, new)]
        label = graph.extended(graph.components(frame(edges[0])), frame(edges[1]), rows=80)
        find = plain.components([*edges[0], *edges[1]])
        nodes = {i for a, b in [*edges[0], *edges[1]] if a != b for i in (a, b)}
        assert sorted((r["node"], r["component"]) for r in label.collect()) == sorted((i, find(i)) for i in nodes)


def test_a_pair_of_many_shared_cells_is_made_once(spark):
    # twenty nodes in most of thirty cells
    rows = [(c, n) for c in range(30) for n in range(20) if (c * 7 + n * 3) % 5]
    met = cells.with_met(spark.createDataFrame(rows, "cell long, node long"))
    x, y = (met.select("cell", F.col("node").alias(c), F.col("met").alias(f"{c}_met")) for c in "xy")
    made = [(r.x, r.y) for r in x.join(y, "cell").where("x < y").where(~F.arrays_overlap("x_met", "y_met")).collect()]
    assert len(made) == len(set(made))
    assert set(made) == {(a, b) for c, a in rows for d, b in rows if c == d and a < b}


def test_without(spark):
    ids = spark.range(0, 3000, 3).select(F.col("id").alias("node"))
    left = cells.without(spark.range(3000).withColumn("node", F.lit("x")), ids, "id")
    assert {r["id"] for r in left.collect()} == {i for i in range(3000) if i % 3}


def line_windows(x):
    """All windows of eight UTF-16 units, cut by plain slicing."""
    b = x.encode("utf-16-be")
    return frozenset(b[i : i + 16] for i in range(0, max(1, len(b) - 15), 2))


def test_lines_equal_brute_force(spark):
    r = random.Random(5)
    base = [" ".join("".join(r.choice("abcde") for _ in range(r.randint(2, 7))) for _ in range(r.randint(1, 40))) for _ in range(40)]
    rows = []
    for i in range(80):
        some = []
        for _ in range(r.randint(0, 8)):
            w = r.choice(base).split()
            if r.random() < 0.5:
                w[r.randrange(len(w))] = r.choice(["qq", "zzz", w[0]])
            some.append(r.choice(["", "  "]) + " ".join(w))
        rows.append((i, "\n".join(some) if i % 9 else None))
    got = {(x["doc_id"], x["line_no"]): x for x in lines.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = {(i, n): x.strip(" ") for i, t in rows for n, x in enumerate((t or "").split("\n")) if x.strip(" ")}
    assert set(got) == set(text)
    sets = {k: line_windows(x) for k, x in text.items()}
    assert all(got[k]["n_shingles"] == len(s) for k, s in sets.items())
    pairs = list(plain.linked(sets))
    together = [got[a]["component_id"] == got[b]["component_id"] for a, b in pairs]
    assert pairs and np.mean(together) > 0.98
    find = plain.components(pairs)
    for k in text:  # nothing is linked that isn't reachable
        assert got[k]["kept"] or any(find(k) == find(o) for o in text if o != k and got[o]["component_id"] == got[k]["component_id"])
    kept = [k for k in text if got[k]["kept"]]
    assert len({got[k]["component_id"] for k in kept}) == len(kept)


def test_lines_are_read_whole(spark):
    """Lines without spaces that start alike are kept; shingles at all positions equal brute force."""
    r = random.Random(9)
    key = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    apart = ["https://a.example.org/one", "https://other.net/something/else", "AAAAB3NzaC1yc2E" + key(60), "AAAAB3NzXXXX" + key(60), "ภาษาไทยเขียนติดกันไม่เว้นวรรค", "ภาษาไทยเขียอย่างอื่นโดยสิ้นเชิง", "12345678" + "9" * 30, "12345678" + "0" * 30]
    base = "https://example.org/" + key(80)
    near = [base, base[:-1] + "_", "q8 x", "q8 x", "😀" * 3 + key(40)]
    out = lines.drop_repeated_lines(spark.createDataFrame([(i, x) for i, x in enumerate(apart + near)], "doc_id long, text string"))
    assert {x["doc_id"] for x in out.collect()} == set(range(len(apart))) | {len(apart), len(apart) + 2, len(apart) + 4}
    got = spark.createDataFrame([(x,) for x in apart + near], "line string")
    got = {x["line"]: set(x["h"]) for x in lines.with_sets(got, "line", "h").collect()}
    for x in apart + near:
        for y in apart + near:
            assert len(got[x] & got[y]) == len(line_windows(x) & line_windows(y))


def test_sketches_make_each_set_once(spark):
    """A filter on the exploded sets would make them again. Long sketches are compared in a loop, as short ones are."""
    text = spark.createDataFrame([(1, "a line of some length"), (2, "a line of same length"), (3, "q8")], "node long, line string")
    out = lines._sketches(text)(text.select("node"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("array_distinct(") == 1
    got = {x["node"]: x["sketch"] for x in out.collect()}
    for node, line in ((x["node"], x["line"]) for x in text.collect()):
        assert sum(i.bit_count() for i in (v & (2**64 - 1) for v in got[node])) <= len(line_windows(line))
    side = lambda c: out.select(*[F.col(x).alias(f"{c}{x}") for x in out.columns])
    both = side("x_").crossJoin(side("y_")).withColumn("ones", cells._ones("x_", "y_", lines.LONGS))
    for x in both.collect():
        assert x["ones"] == sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(x["x_sketch"], x["y_sketch"], strict=True))
    assert cells.INLINE < lines.LONGS


def test_bands_look_for_each_mark_once(spark):
    rng = random.Random(6)
    text = spark.createDataFrame([("".join(rng.choice("abcdef ") for _ in range(n)),) for n in (3, 12, 26, 40, 400)], "line string")
    out = lines.line_bands(text)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("array_position(") == lines.BANDS - 1
    h = F.array_distinct(lines.windows(F.col("line")))
    alone = text.select(lines._node("line"), F.size(h).alias("size"), lines.band_keys(lines.with_marks(h), F.size(h)).alias("keys"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, alone.collect()))


def test_bands_meet_at_the_threshold(spark):
    """Random pairs of a Jaccard similarity of just 0.8 share a band, at every size."""
    cases = [(4, 0, 1), (8, 1, 1), (8, 0, 2), (12, 1, 2), (16, 2, 2), (16, 0, 4), (24, 3, 3), (64, 8, 8), (256, 32, 32)]
    some = lambda start, n: F.transform(F.sequence(F.lit(start), F.lit(start + n - 1)), lambda i: F.xxhash64(F.lit(17), F.col("id"), i))
    keys = lambda h: lines.band_keys(lines.with_marks(h), F.size(h))
    for both, a, b in cases:
        x = F.concat(some(0, both), some(1000, a)) if a else some(0, both)
        y = F.concat(some(0, both), some(2000, b))
        pairs = spark.range(1500).select(x.alias("x"), y.alias("y")).select(keys(F.col("x")).alias("x"), keys(F.col("y")).alias("y"))
        share = pairs.agg(F.avg(F.arrays_overlap("x", "y").cast("int"))).first()[0]
        assert share > 0.985, (both, a, b, share)


def test_dropped_lines_and_odd_documents(spark):
    a, b = "the quick brown fox jumps over it", "another line that stands for itself"
    rows = [(1, f"{a}\n{b}", 5), (2, f"  {a}\n\nonly here, this one", 5), (3, a, 5), (4, None, 5), (5, "", 5), (None, a, 5), (6, "日本語の文章がここにあります。\n" + a, 5)]
    rows += [(7, "one id, two texts of its own", 5), (7, f"one id, another text instead\n{b}", 5), (8, "a row that is there twice\n" * 2, 5), (8, "a row that is there twice\n" * 2, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("line_no", F.lit("a clashing name"))
    out = lines.drop_repeated_lines(docs)
    assert out.columns == ["doc_id", "text", "n_chars", "line_no"]
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in out.collect()))
    texts = [x for _, x in got]
    whole = "\n".join(texts).split("\n")
    assert whole.count(a) == 1 and whole.count(b) == 1 and whole.count("a row that is there twice") == 1
    for x in ("only here, this one", "日本語の文章がここにあります。", "one id, two texts of its own", "one id, another text instead"):
        assert whole.count(x) == 1
    assert sum(i == 4 for i, _ in got) == sum(i == 5 for i, _ in got) == 1
    assert lines.line_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def vectors(seed, n, d=8):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, d))
    x = centre[r.integers(0, 6, n)] + r.normal(size=(n, d)) * r.choice([0.1, 0.4, 2.0], (n, 1))
    x[::7] = x[0]
    x[3] *= 1e200
    x[5] *= 1e-200
    return x


@pytest.mark.parametrize("unit", [16, 4096])
def test_vectors_equal_brute_force(spark, unit):
    x = vectors(6, 300)
    rows = [(i, [float(v) for v in e], "l", 0.5) for i, e in enumerate(x)]
    rows += [(300, None, "l", 0.1), (301, [], "l", 0.1), (302, [0.0] * 8, "l", 0.1), (303, [float("nan")] + [1.0] * 7, "l", 0.1), (304, [None] + [1.0] * 7, "l", 0.1), (None, [1.0] * 8, "l", 0.1), (305, [float("inf")] * 8, "l", 0.1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, w double")
    got = {r["vec_id"]: r for r in embeddings.link_vectors(df, unit=unit).collect()}
    assert len(got) == len(rows)
    u = x / np.abs(x).max(1, keepdims=True)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    find = plain.components(np.argwhere(near).tolist())
    for i in range(300):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), find(i), find(i) == i)
    for i in range(300, 306):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert (got[None]["n_links"], got[None]["kept"]) == (0, False)
    assert embeddings.link_vectors(df.limit(0), unit=unit).count() == 0


def test_a_document_of_very_many_equal_lines(spark):
    """Linear in its lines: one stays."""
    docs = spark.createDataFrame([(1, "the very same line\n" * 60_000), (2, "another document")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(docs).collect()} == {1: "the very same line\n", 2: "another document"}
