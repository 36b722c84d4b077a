"""URL rules, hard negatives and the filter audit against plain versions."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandlake.llm import audit, negatives, urls

from . import plain

# --- URL filters


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(plain.LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path, rules):
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=None)


def some_urls(seed, n):
    r = random.Random(seed)
    out = []
    for i in range(n):
        bad = r.random() < 0.4
        host = ".".join(r.choice([["casino", "win"], ["free", "bets"]] if bad else [["the", "news"], ["blog", "tea"]])) + r.choice([".example.org", ".Example.com", ".net"])
        path = r.choice(["/fr/", "/en/", "/es/", "/de/", "/en/1", ""]) + str(r.randint(1, 99))
        out.append((i, f"http{r.choice(['', 's'])}://{host}{path}{r.choice(['', '?a=1&b=2', '#top', '?ref=/x#y'])}", "h", "t", "u"))
    return out


ODD = [
    (None, None), (None, ""), (1, "no scheme"), (1, "http://"), (2, "http://ORG"), (3, "http://a.org/"), (4, "x://y.example.org/es/?q=http://z.com/de/"), (5, "http://example.org/en/1"),
    (6, "http://Éa.example.org/en/2#"), (7, "http://notexample.org/es/"), (7, "http://notexample.org/es/"), (8, "http://a.com/fr"), (9, "http://a.com?x=/fr/"), (10, "http://a.org\n/x"), (11, "http://net.net/" + "a-1/" * 30_000),
]
PAGES = "page_id long, url string, host string, tokens string, items string"


def test_host_path_and_listed_rule(spark):
    rows = [(i, u, "h", "t", "i") for i, u in ODD] + some_urls(1, 200)
    got = urls.judge_urls(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows)
    want = []
    for i, u, *_ in rows:
        host, path = plain_parts(u)
        rule = plain_rule(host, path, urls.RULES)
        want.append((i, u, host, path, rule and rule[0], rule and rule[1]))
    key = lambda r: str(r[:5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(g[:5]) == w[:5]
        assert g["verdict"] in ("allow", "block")
        if w[5]:
            assert g["verdict"] == w[5] and not g["mined"]


def plain_rules(rows, support, confidence):
    """All token sets with a verdict, counted one by one."""
    n = len(rows)
    count = {}
    for items, verdict in rows:
        for k in range(len(items) + 1):
            for c in itertools.combinations(sorted(items), k):
                both = count.setdefault(c, {})
                both[verdict] = both.get(verdict, 0) + 1
    conf = {(c, v): x / sum(both.values()) for c, both in count.items() for v, x in both.items()}
    out = {}
    for (c, v), x in conf.items():
        if c and count[c][v] >= support * n and x >= confidence:
            parts = [tuple(t for t in c if t != gone) for gone in c]
            if all(conf.get((p, v), 0) < x for p in parts):
                out[c, v] = (round(x, 9), round(count[c][v] / n, 9))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_mined_rules_equal_brute_force(spark, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(150):
        items = [t for t in "abcdef" if r.random() < 0.5]
        verdict = "block" if ("a" in items and "b" in items) or (r.random() < 0.1) else "allow"
        rows.append((items, verdict))
    got = urls.mined_rules(spark.createDataFrame(rows, "items array<string>, verdict string"), support=0.05, confidence=0.7).collect()
    got = {(tuple(g["antecedent"]), g["verdict"]): (round(g["confidence"], 9), round(g["support"], 9)) for g in got}
    assert got == plain_rules(rows, 0.05, 0.7)
    assert ("a", "b") in {c for c, _ in got}


def test_verdicts_follow_the_mined_rules(spark):
    pages = spark.createDataFrame(some_urls(3, 600), PAGES)
    rules = [("example.org", "/es/", "block"), ("example.org", "/", "allow"), ("example.com", "/es/", "block"), ("example.com", "/", "allow")]
    got = {r["page_id"]: r for r in urls.judge_urls(pages, rules).collect()}
    listed = urls.host_and_path(pages.select("page_id", "url")).withColumn("r", urls.listed_rule(rules)).withColumn("tokens", urls.tokens()).select("page_id", "r.verdict", "tokens").collect()
    told = set(urls.telling_tokens(spark.createDataFrame([(x["tokens"], x["verdict"]) for x in listed if x["verdict"]], "tokens array<string>, verdict string")))
    items = {x["page_id"]: sorted(told & set(x["tokens"])) for x in listed}
    mined = plain_rules([(items[x["page_id"]], x["verdict"]) for x in listed if x["verdict"]], urls.SUPPORT, urls.CONFIDENCE)
    n_mined = 0
    for x in listed:
        if x["verdict"] is None:
            fits = [(*m, len(c), v) for (c, v), m in mined.items() if set(c) <= set(items[x["page_id"]])]
            assert got[x["page_id"]]["verdict"] == (max(fits)[-1] if fits else "allow")
            assert got[x["page_id"]]["mined"] == bool(fits)
            n_mined += bool(fits)
            if "/es/" in got[x["page_id"]]["path"]:
                assert got[x["page_id"]]["verdict"] == "block"
    assert n_mined > 50


def test_every_frequent_token_takes_part(spark):
    words = [a + b for a in "bcdfghjk" for b in "aeiouyxz"]  # 64 words, all alike in what they tell
    urls_ = [f"http://{w}.x.{'org' if i % 2 else 'com'}/{k}" for i, w in enumerate(words) for k in range(4)]
    asked = {f"http://{w}.net/": "allow" if i % 2 else "block" for i, w in enumerate(words)}
    # a long URL that comes again and again: its tokens stand in the same rows
    long = [a + b + "q" for a in "bcdfgh" for b in "lmnrs"]
    urls_ += [f"https://y.com/{'/'.join(long)}"] * 6
    asked |= {f"ftp://u.net/{w}": "block" for w in long}
    pages = spark.createDataFrame([(i, u, "", "", "") for i, u in enumerate([*urls_, *asked])], PAGES)
    got = {r["url"]: r for r in urls.judge_urls(pages, [("org", "/", "allow"), ("com", "/", "block")]).collect()}
    assert {u: (got[u]["verdict"], got[u]["mined"]) for u in asked} == {u: (v, True) for u, v in asked.items()}


def test_urls_without_labels_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "", "", ""), (2, None, "", "", "")], PAGES)
    assert {r["verdict"] for r in urls.judge_urls(pages).collect()} == {"allow"}
    assert {r["verdict"] for r in urls.judge_urls(pages, default="block").collect()} == {"block"}
    one = spark.createDataFrame([(1, "http://a.org/x", "", "", ""), (2, "http://a.net/x", "", "", "")], PAGES)
    assert {r["page_id"]: r["verdict"] for r in urls.judge_urls(one).collect()} == {1: "allow", 2: "allow"}
    assert urls.judge_urls(pages.limit(0)).collect() == []


# --- hard negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (33, 64, 70), (65, 33, 129), (8, 0, 8)])
def test_strassen_is_exact(shape):
    r = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = r.integers(-(1 << 20), 1 << 20, (m, k)), r.integers(-(1 << 20), 1 << 20, (k, n))
    for leaf in (1, 4, 32):
        assert (negatives.strassen(a, b, leaf) == a @ b).all()


def plain_negatives(rows, positives=5, negatives=10, low=30, high=90):
    """``rows``: (vec_id, label, q, is_anchor)."""
    rows = [(i, label, q, a) for i, label, q, a in rows if i is not None and label is not None and q is not None and None not in q]
    out = []
    for x, (i, label, q, is_anchor) in enumerate(rows):
        if not is_anchor:
            continue
        score = lambda o: sum(a * b for a, b in zip(q, o, strict=False))  # noqa: B023, E731
        same = sorted((-score(o), j) for y, (j, other, o, _) in enumerate(rows) if other == label and y != x)[:positives]
        rest = sorted((-score(o), j) for j, other, o, _ in rows if other != label)
        for p, pos in same:
            p = -p
            fit = [(-s, j) for s, j in rest if low * p <= -100 * s <= high * p][:negatives]
            out += [(i, pos, k + 1, j, p, s) for k, (s, j) in enumerate(fit)]
    return sorted(out)


VECTORS = "vec_id long, label int, q array<long>, is_anchor boolean, a long, place long"


@pytest.mark.parametrize(("seed", "tiles"), [(1, (4, 7)), (2, (1, 1)), (3, (256, 1024))])
def test_negatives_equal_brute_force(spark, seed, tiles):
    r = random.Random(seed)
    rows = []
    for i in range(90 if tiles != (1, 1) else 25):
        q = [r.randint(-3, 6) for _ in range(r.choice([6, 6, 6, 4]))]
        rows.append((r.choice([i, i, i // 2]), r.choice([0, 0, 0, 1, 2, i + 10]), q, r.random() < 0.2, 9, 9))
    rows += [(None, 1, [1, 2], True, 0, 0), (5, None, [1], True, 0, 0), (6, 1, None, True, 0, 0), (7, 1, [1, None], True, 0, 0), (8, 0, [], True, 0, 0)]
    rows += [(500, 0, [4, 4, 4], True, 0, 0)] * 2  # equal rows are separate
    got = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(3), tiles=tiles, leaf=2)
    want = plain_negatives([row[:4] for row in rows])
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) > 100 or tiles == (1, 1)


def test_negatives_odd_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(none).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(1, 1, [1], False, 0, 0)], VECTORS)).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(1, 1, [1], True, 0, 0)], VECTORS)).collect() == []
    with pytest.raises(ValueError, match="too large"):
        negatives.hard_negatives(spark.createDataFrame([(1, 1, [1 << 30], True, 0, 0)], VECTORS))
    x = spark.createDataFrame([([0.00390625, -0.001, 1.5, -0.0],)], "embedding array<float>")
    assert x.select(negatives.integers()).first()[0] == [1, -1, 384, 0]


# --- filter audit


def plain_failed(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = []
    for i, text, source in rows:
        text = text or ""
        w = plain.WORD.findall(text)
        bad = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text)), i is not None and first[text] < i]
        out.append((i, source or "", "".join(f for f, b in zip("ABCDE", bad, strict=True) if b)))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs, out = plain_failed(rows), {}
    for part in {p for _, p, _ in docs}:
        mine = [(i, set(f)) for i, p, f in docs if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            here = list(mine)
            for k, f in enumerate(order):
                lost = [(i, x) for i, x in here if f in x]
                here = [(i, x) for i, x in here if f not in x]
                total[f] += len(lost)
                out[part, order, k + 1] = [len(here), len(lost), sum(f in x for _, x in mine) - len(lost), sum(x == {f} for _, x in mine), sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost)]
        for (p, order, k), x in out.items():
            if p == part:
                x.append(total[order[k - 1]])
    return {k: tuple(x) for k, x in out.items()}


def audit_rows(seed, n):
    r = random.Random(seed)
    words = ["tea", "Tea", "é", "a\u00a0b", "x" * 80, "y" * 70, "A#", "50%", "ÄB", *[f"w{i}" for i in range(60)]]
    texts = []
    for _ in range(n):
        k = r.choice([3, 49, 50, 51, 80, 200])
        t = r.choice([" ", "\n", "\x0b", " \t"]).join(r.choice(words if r.random() < 0.7 else words[:12]) for _ in range(k))
        texts.append(t.upper() if r.random() < 0.1 else t)
    texts += ["", None, " \n", texts[0]]
    rows = [(r.choice([i, i, i, i // 2, None]), r.choice(texts), r.choice(["web", "", None, "b"])) for i in range(n)]
    return rows, [(r.choice([i, None]), r.choice([0, 1, None]), r.choice([0, 1, None])) for i in [*range(n), *range(9)]]


DOCS, LABELS = "doc_id long, text string, source string, part string, shard long, sha string", "doc_id long, quality int, toxic int, good int"


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_brute_force(spark, seed):
    rows, labels = audit_rows(seed, 120)
    docs = spark.createDataFrame([(*x, "p", 1, "s") for x in rows], DOCS).repartition(3)
    bits = lambda m: "".join(f for f, b in audit.BIT.items() if m & b)
    got = sorted((str(r["doc_id"]), r["part"], bits(r["failed"])) for r in audit.failed_filters(docs).collect())
    assert got == sorted((str(i), p, f) for i, p, f in plain_failed(rows))
    if seed == 1:
        out = audit.audit_filters(docs, spark.createDataFrame([(*x, 1) for x in labels], LABELS)).collect()
        assert {(r["part"], r["filter_order"], r["step"]): tuple(r[3:]) for r in out} == plain_audit(rows, labels)
        assert len(out) == 600 * len({p for _, p, _ in plain_failed(rows)})


def test_term_shards_hold_every_word(spark):
    rows = [(i, t, "s") for i, (_, t, _) in enumerate(audit_rows(5, 60)[0])]
    docs = spark.createDataFrame([(i, s, "h", t or "") for i, t, s in rows], "doc_id long, part string, sha string, text string").repartition(5)
    found = audit.encoded(docs, words_of_page=20)
    pages = audit.dictionary(found).collect()
    known = {r["id"]: bytes(r["word"]).decode() for r in pages}
    assert len(known) == len(set(known.values())) and len({r["own"] >> 31 for r in pages}) > 2
    ids = {r["shard"]: r["doc_id"] for r in found.where("words IS NULL").collect()}
    got = {}
    for r in audit.term_shards(found).collect():
        ptr, col, n = (audit._unpacked(pa.scalar(r["indptr"])), np.frombuffer(r["indices"], np.int64), audit._unpacked(pa.scalar(r["data"])))
        assert len(ptr) == r["n_rows"] + 1 and ptr[-1] == len(col) == len(n)
        for row in range(r["n_rows"]):
            got[ids[r["shard"]][row]] = {known[col[k]]: n[k] for k in range(ptr[row], ptr[row + 1])}
    want = {i: plain.WORD.findall(t or "") for i, t, _ in rows}
    assert got == {i: {x: w.count(x) for x in w} for i, w in want.items()}


def test_term_counts_take_one_python_worker(spark):
    docs = spark.createDataFrame([(1, "", "x", "a b a"), (2, "s", "y", "b c\nb"), (3, "s", "z", "")], "doc_id long, part string, sha string, text string")
    found = audit.encoded(docs, words_of_page=2)
    counts = audit.term_counts(found)
    at = lambda df: sorted(tuple(r) for r in df.select("shard", "row", "n_words", "n_distinct").collect())
    assert at(counts) == at(audit.row_counts(audit.term_shards(found)))
    assert sorted(r[2:] for r in at(counts)) == [(0, 0), (3, 2), (3, 2)]
    assert counts._jdf.queryExecution().executedPlan().toString().count("Arrow") == 1


def test_audit_of_odd_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit.audit_filters(spark.createDataFrame([], DOCS), none).collect() == []
    long = spark.createDataFrame([(1, "word " * 900_000, None, "", 0, ""), (1, "word " * 900_000, None, "", 0, ""), (2, "a b c", None, "", 0, "")], DOCS)
    assert sorted(r["failed"] for r in audit.failed_filters(long).collect()) == [1, 2, 2]
    assert audit.audit_filters(long, none).where(F.col("filter_order") == "ABCDE").count() == 5
