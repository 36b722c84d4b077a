"""Jaccard metric-space join over word shingles, exact.

Two levels of pivots. On the first, every shingle of the corpus is a pivot: the
set {s}. All of a document's own shingles are its nearest pivots at the same
distance 1 - 1/n, so a global order breaks the tie, and the Voronoi region of a
document is that of its first shingle. A partner within the threshold can lack
at most n - ceil(0.8 n) of the document's shingles; so, by the triangle
inequality of the set difference, the partner's region is among those of the
document's first n - ceil(0.8 n) + 1 shingles. The document is replicated to
this window and nowhere else. On the second level (:mod:`cells`) the documents
of a region are joined by document pivots with triangle-inequality windows,
recursively.

The order puts shingles that very many documents share last, so regions stay
small; any order is exact.

Pairs are first bounded from below by parity sketches: a bit for each hash class,
the parity of its members. The xor of two sketches is the sketch of the
symmetric difference, so its number of ones never exceeds the size of that
difference. What the bound can't exclude is compared shingle by shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.counting import ranked
from .cells import in_company, link_cells
from .common import few, once, row_key, sendable, settled, stored, table
from .textstats import Words, mix, parts, slices

WORDS, SHARE = 5, 80
#: Longs of the sketch that travels with a region's members.
LONGS = 4
#: Common shingles only steer the order. They are looked for in one of SAMPLE documents, and this many are sent to the tasks (8 bytes each).
SAMPLE, COMMON_LEAST, MAX_COMMON = 16, 4, 1 << 18


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)``: the distinct shingles of each row, sorted."""
    flat, size = [], []
    for _, _, data, offsets in slices(text):
        w = Words(data, offsets)
        h = w.hashes()
        n = np.diff(w.first)
        # a shingle starts at every word that has enough behind it; short texts are one shingle
        room = w.first[w.row + 1] - np.arange(len(h)) if len(h) else np.zeros(0, np.int64)
        length = np.minimum(n[w.row], WORDS) if len(h) else room
        starts = np.flatnonzero((room >= length) & ((length == WORDS) | (np.arange(len(h)) == w.first[w.row]))) if len(h) else room
        g = np.zeros(len(starts), np.uint64)
        for i in range(WORDS):
            use = i < length[starts]
            g = np.where(use, g * np.uint64(0x9E3779B97F4A7C15) + h[np.minimum(starts + i, max(0, len(h) - 1))], g)
        g = mix(g + length[starts].astype(np.uint64))
        row = w.row[starts]
        order = np.lexsort((g, row))
        g, row = g[order], row[order]
        keep = np.ones(len(g), bool)
        keep[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
        flat.append(g[keep])
        size.append(np.bincount(row[keep], minlength=len(offsets) - 1))
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(size))]) if size else np.zeros(1, np.int64)
    return (np.concatenate(flat) if flat else np.zeros(0, np.uint64)), offsets


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Hashes of the shingles that stand in many of a sample's different texts, sorted."""
    sample = docs.where((F.pmod(F.xxhash64("said"), F.lit(SAMPLE)) == 0) & F.col("text").isNotNull()).select("text").dropDuplicates(["text"])

    def run(batches):
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(batch.column("text"))[0].view(np.int64))], names=["s"])

    often = sample.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= COMMON_LEAST)
    top = often.orderBy(F.desc("count"), "s").limit(MAX_COMMON).select("s").toPandas()
    return np.sort(top["s"].to_numpy(np.int64).view(np.uint64))


def region_windows(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """``id, said, n, d1, d2, window, n_rare, sketch`` for each row of ``docs(id, said, text)``; ``said`` is a hash of the text.

    ``d1, d2`` name the set (sums of two hashes); ``window`` holds the regions
    that the document goes to, of which the first ``n_rare`` aren't common.
    """

    def run(batches):
        for batch in parts(batches):
            flat, offsets = shingle_sets(batch.column("text"))
            n = np.diff(offsets)
            row = np.repeat(np.arange(len(n)), n)
            c1, c2 = (np.concatenate([[0], np.cumsum(x)]).astype(np.uint64) for x in (flat, mix(flat ^ np.uint64(0x5851F42D4C957F2D))))
            d1, d2 = (c[offsets[1:]] - c[offsets[:-1]] for c in (c1, c2))
            is_common = np.isin(flat, common)
            order = np.lexsort((flat, is_common, row))
            place = np.arange(len(flat)) - offsets[:-1][row]
            length = np.where(n > 0, n - (n * SHARE + 99) // 100 + 1, 0)
            inside = place < length[row]
            window = flat[order][inside]
            w_offsets = np.concatenate([[0], np.cumsum(length)])
            rare = np.concatenate([[0], np.cumsum(~is_common[order])])
            n_rare = np.minimum(rare[offsets[1:]] - rare[offsets[:-1]], length)
            # parity sketches: a power of two of longs, about a bit for each shingle
            longs = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(n, 1) / 64.0)).astype(np.int64).clip(0))
            s_offsets = np.concatenate([[0], np.cumsum(longs)])
            sketch = np.zeros(s_offsets[-1], np.uint64)
            bits = mix(flat + np.uint64(0x9E3779B97F4A7C15))
            at = s_offsets[:-1][row] + ((bits >> np.uint64(6)) & (longs[row] - 1).astype(np.uint64)).astype(np.int64)
            np.bitwise_xor.at(sketch, at, np.uint64(1) << (bits & np.uint64(63)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("said"), pa.array(n.astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 _lists(window, w_offsets), pa.array(n_rare.astype(np.int64)), _lists(sketch, s_offsets)],
                names=["id", "said", "n", "d1", "d2", "window", "n_rare", "sketch"],
            )

    kind = "id long, said long, n long, d1 long, d2 long, window array<long>, n_rare long, sketch array<long>"
    return docs.select("id", "said", "text").mapInArrow(run, kind)


def _bounded(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``a, b, total, apart``: the sum of the sizes and a lower bound of the symmetric difference."""
    x = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("xa"))
    y = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("xb"))

    def run(batches):
        for batch in batches:
            xa, xb = batch.column("xa"), batch.column("xb")
            la, lb = (np.diff(np.asarray(x.offsets)) for x in (xa, xb))
            fa, fb = (x.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for x in (xa, xb))
            oa, ob = (np.concatenate([[0], np.cumsum(x)]) for x in (la, lb))
            apart = np.zeros(batch.num_rows, np.int64)
            for key in set(zip(la.tolist(), lb.tolist(), strict=True)):
                rows = np.flatnonzero((la == key[0]) & (lb == key[1]))
                k = min(key)
                # a sketch folds to half its length by xor
                ma = np.bitwise_xor.reduce(fa[oa[rows][:, None] + np.arange(key[0])].reshape(len(rows), -1, k), axis=1)
                mb = np.bitwise_xor.reduce(fb[ob[rows][:, None] + np.arange(key[1])].reshape(len(rows), -1, k), axis=1)
                apart[rows] = np.bitwise_count(ma ^ mb).sum(1)
            total = np.asarray(batch.column("na")) + np.asarray(batch.column("nb"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(total), pa.array(apart)], names=["a", "b", "total", "apart"])

    return pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long, total long, apart long")


def _exact(pairs: DataFrame, docs: DataFrame, said: DataFrame, n: int) -> DataFrame:
    """``a, b, total, apart`` with the true symmetric difference; ``said(node, id, said)`` names a document of each node."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(said, "node")
    nodes = sendable(stored(few(nodes, 2 * n), "nodes"))
    text = docs.join(nodes, ["id", "said"]).dropDuplicates(["node"]).select("node", "text")
    text = stored(few(text, 2 * n, 5_000), "texts")
    both = pairs.join(text.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(text.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in parts(batches, 500):
            (fa, oa), (fb, ob) = shingle_sets(batch.column("ta")), shingle_sets(batch.column("tb"))
            row = np.concatenate([np.repeat(np.arange(batch.num_rows), np.diff(o)) for o in (oa, ob)])
            h = np.concatenate([fa, fb])
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            twice = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
            inter = np.bincount(row[1:][twice], minlength=batch.num_rows)
            total = np.diff(oa) + np.diff(ob)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(total), pa.array(total - 2 * inter)], names=["a", "b", "total", "apart"])

    return both.mapInArrow(run, "a long, b long, total long, apart long")


def _named(sets: DataFrame) -> DataFrame:
    """``sets`` with ``node``: the smallest id of a set's documents, or where sets share that id, for all but one of them a number above all ids."""
    shared = stored(sets.groupBy("least").agg(F.count("*").alias("_n"), F.min(F.struct("d1", "d2")).alias("_first")).where("_n > 1"), "shared")
    if shared.isEmpty():
        return sets.withColumn("node", F.col("least"))
    more = sets.select("least", "d1", "d2", "n").join(shared, "least").where(F.struct("d1", "d2") != F.col("_first")).select("least", "d1", "d2", "n")
    top = sets.agg(F.max("least")).first()[0]
    more = ranked(more, ["least", "d1", "d2", "n"], "_more").select("d1", "d2", "n", (F.col("_more") + top + 1).alias("_more"))
    return stored(sets.join(more, ["d1", "d2", "n"], "left").withColumn("node", F.coalesce("_more", "least")).drop("_more"), "named")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set
    holds a document's distinct five-word runs, or its whole sequence if it has
    fewer words. Documents link at a Jaccard similarity of 0.8 or more.
    Documents with equal sets are one node, so groups of copies don't multiply
    pairs. Null and empty texts have size 0 and link with nothing, as do rows
    with a null doc_id (component null). Each row is a document: rows that share
    an id but not the text link by their own texts, and their id counts wherever
    one of them is. Other columns are ignored; an empty table gives an empty table.
    Shingles are 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("said"), "text")
    sets = stored(region_windows(docs, common_shingles(docs)), "windows")
    node = (
        sets.where("n > 0 AND id IS NOT NULL")
        .groupBy("d1", "d2", "n", "n_rare", "window", "sketch")
        .agg(F.min(F.struct("id", "said")).alias("first"))
        .select("d1", "d2", "n", "n_rare", "window", "sketch", F.col("first.id").alias("least"), F.col("first.said").alias("said"))
    )
    nodes = _named(stored(node, "sets"))
    folded = F.aggregate("sketch", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))  # one long of the sketch
    spread = nodes.select("node", F.col("n").alias("size"), folded.alias("sketch"), "n_rare", F.posexplode("window").alias("place", "cell"))
    spread = spread.select("cell", "node", "size", "sketch", (F.col("place") >= F.col("n_rare")).alias("common"))
    # what has company gets a longer sketch; sketches fold by xor of their quarters
    part = lambda i: F.aggregate(F.filter("sketch", lambda _, k: k % LONGS == i), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))
    quarters = nodes.select("node", F.array(*[part(i) for i in range(LONGS)]).alias("sketch"))
    cells = stored(in_company(spread, F.col("common")).drop("sketch").join(quarters, "node"), "cells")
    sketches = nodes.select("node", "n", "sketch")

    def judge(pairs: DataFrame, n: int) -> DataFrame:
        bounded = stored(few(_bounded(pairs, sketches), n), "bounded")
        # similarity is (total - apart) / (total + apart)
        possible = (F.col("total") - F.col("apart")) * 100 >= (F.col("total") + F.col("apart")) * SHARE
        distance = 2 * F.col("apart") / (F.col("total") + F.col("apart"))
        close = bounded.where(possible).select("a", "b")
        exact = _exact(close, docs, nodes.select("node", F.col("least").alias("id"), "said"), close.count()).select("a", "b", distance.alias("lo"), distance.alias("hi"), possible.alias("linked"))
        return exact.union(bounded.where(~possible).select("a", "b", distance.alias("lo"), F.lit(1.0), F.lit(False)))

    label = link_cells(cells, judge, share=SHARE, longs=LONGS)
    of_set = nodes.join(label, "node", "left").select("d1", "d2", F.col("n").alias("m"), F.coalesce("component", "node").alias("component"), "least")
    least = stored(of_set.groupBy("component").agg(F.min("least").alias("first")), "components")
    of_set = of_set.join(least, "component").select("d1", "d2", "m", "first")
    out = sets.select("id", "n", "d1", "d2").join(of_set, (sets.d1 == of_set.d1) & (sets.d2 == of_set.d2) & (F.col("n") == F.col("m")) & F.col("id").isNotNull(), "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("first", "id").alias("component_id"))


def _lost(docs: DataFrame) -> DataFrame:
    """``_key`` of the documents that aren't the first of their group."""
    group = jaccard_components(docs.select(row_key().alias("doc_id"), "text")).select(F.col("doc_id").alias("_key"), "component_id").distinct()
    grouped = group.join(group.groupBy("component_id").agg(F.count("*").alias("_n")).where("_n > 1"), "component_id").select("_key", "component_id")
    ids = docs.select(row_key().alias("_key"), F.col("doc_id").cast("long").alias("_id")).distinct().join(grouped, "_key")
    ids = stored(ids.select("component_id", "_key", F.struct(F.col("_id").isNull(), "_id", "_key").alias("at")), "ids")
    first = ids.groupBy("component_id").agg(F.min("at").alias("first"))
    return ids.join(first, "component_id").where(~F.col("at").eqNullSafe(F.col("first"))).select("_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group of near copies in ``docs`` the row with the smallest id; rows with an id come before rows without.

    A document is a pair of id and text here, so ids may be null or repeated.
    Rows that share both are copies, whatever their other columns: one of them
    stays, the same on every run. Empty and null texts are near copies of nothing.
    All columns stay, whatever their names.
    """
    keyed = once(docs.select(row_key().alias("_key"), F.struct(*docs.columns).alias("_row")), "_key")
    lost = settled(docs.sparkSession, lambda: _lost(docs), "lost")
    return keyed.join(sendable(lost), "_key", "left_anti").select("_row.*")


def op9_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
