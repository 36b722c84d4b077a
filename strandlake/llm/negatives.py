"""Hard negatives of anchors: exact integer products by Strassen's recursion.

Rows are ordered by label and cut into tiles. A pair of an anchor tile and a
candidate tile meets in one task, where the block of scores comes from
Strassen's recursion on int64, padded with zeros; int64 sums are exact, so
the result doesn't depend on the recursion. Each tile pair gives a bounded heap for
each anchor: its best rows of the same label in the first pass, the best rows of
other labels within the windows of its positives in the second. Heaps merge by
rank, before and after the shuffle. In the first pass an anchor tile only meets
tiles that hold its labels, which follow each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.counting import ranked
from .common import MAX_IDS, stored, table

#: Rows of an anchor tile and of a candidate tile; a side up to LEAF is multiplied plainly.
ANCHORS, CANDIDATES, LEAF = 256, 1024, 32
#: Scores stay below this, so that a hundred times a score fits in 64 bits.
MOST = 1 << 56


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for int64 matrices by seven products of halves; odd sides are padded with zeros."""
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :c], b[:j, c:], b[j:, :c], b[j:, c:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * c), np.int64)
    out[:i, :c] = p1 + p4 - p5 + p7
    out[:i, c:] = p3 + p5
    out[i:, :c] = p2 + p4
    out[i:, c:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def _matrix(q: pa.ChunkedArray, size: int) -> np.ndarray:
    """Lists as rows, shorter ones padded with zeros."""
    q = q.combine_chunks()
    offsets = np.asarray(q.offsets)
    n = np.diff(offsets)
    out = np.zeros((len(n), size), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = q.flatten().to_numpy(zero_copy_only=False)
    return out


def _scores(rows: pa.Table, size: int) -> tuple[pa.Table, pa.Table, np.ndarray] | None:
    """Anchors and candidates of a tile pair, the latter by id, and their scores."""
    is_anchor = rows.column("as_anchor").to_numpy()
    a, b = rows.filter(pa.array(is_anchor)), rows.filter(pa.array(~is_anchor)).sort_by([("vec_id", "ascending"), ("place", "ascending")])
    if not a.num_rows or not b.num_rows:
        return None
    return a, b, strassen(_matrix(a.column("q"), size), np.ascontiguousarray(_matrix(b.column("q"), size).T))


def _top(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first ``n`` of each heap by score, id and place, with their ``rank`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "place")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def integers(vector: str | Column = "embedding") -> Column:
    """``floor(256 x)`` of each component, as a double first."""
    return F.transform(vector, lambda x: F.floor(256 * x.cast("double")))


def hard_negatives(
    vectors: DataFrame, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, tiles: tuple[int, int] = (ANCHORS, CANDIDATES), leaf: int = LEAF
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vectors(vec_id, label, q, is_anchor)``.

    ``q`` holds integers, ``label`` is an integer. A row's score is its inner
    product with the anchor; higher ones come first, ties by smaller vec_id. An
    anchor's positives are its first ``positives`` other rows of the same label; for
    each of them the first ``negatives`` rows of other labels count whose score is between
    ``low`` and ``high`` percent of the positive's. So no negative belongs to a
    positive score under zero.

    Rows with a null id, label, vector or component take no part. Rows that
    share an id are separate rows, each with a result of its own, also if they are equal in all columns;
    shorter vectors count as padded with zeros, empty ones score zero. Other
    columns are ignored, an empty table gives an empty table. Vectors whose
    products could exceed 2^56 are an error.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "q", F.col("is_anchor").alias("anchor"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("q").isNotNull() & ~F.exists("q", lambda x: x.isNull()))
    v = stored(ranked(v, ["label", "vec_id"], "place"), "vectors")
    largest = F.greatest(F.coalesce(F.array_max("q"), F.lit(0)), -F.coalesce(F.array_min("q"), F.lit(0)))
    n, size, most = v.agg(F.count("*"), F.max(F.size("q")), F.max(largest)).first()
    anchors = stored(ranked(v.where("anchor"), ["place"], "at"), "anchors")
    n_anchors = anchors.count()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], out)
    if most < 0 or size * most * most >= MOST:
        raise ValueError("components are too large for scores of 64 bits")
    per_a, per_c = tiles
    a_tile, c_tile = F.floor(F.col("at") / per_a), F.floor(F.col("place") / per_c)
    columns = ["vec_id", "label", "q", "place"]

    def dealt(of_candidate: Column, of_anchor: Column, cand: DataFrame, anch: DataFrame, extra: list[str]) -> DataFrame:
        """Candidates go to the anchor tiles of ``of_candidate``, anchors to the candidate tiles of ``of_anchor``."""
        a = anch.select(a_tile.alias("a"), F.explode(of_anchor).alias("c"), F.lit(True).alias("as_anchor"), *columns, *extra)
        c = cand.select(F.explode(of_candidate).alias("a"), c_tile.alias("c"), F.lit(False).alias("as_anchor"), *columns, *[F.lit(None).cast(anch.schema[e].dataType).alias(e) for e in extra])
        return a.union(c).groupBy("a", "c")

    # where each label's rows and anchors lie
    lies = v.groupBy("label").agg(F.min(c_tile).alias("c0"), F.max(c_tile).alias("c1"))
    lies = lies.join(anchors.groupBy("label").agg(F.min(a_tile).alias("a0"), F.max(a_tile).alias("a1")), "label")
    lies = stored(lies, "labels")
    lies = F.broadcast(lies) if lies.count() <= MAX_IDS else lies

    def best(rows: pa.Table) -> pa.Table:
        made = _scores(rows, size)
        found: list = [[], [], [], []]
        if made:
            a, b, s = made
            la, lb, pa_, pb = (t.column(c).to_numpy() for c, t in (("label", a), ("label", b), ("place", a), ("place", b)))
            ids = b.column("vec_id").to_numpy()
            for i in range(len(la)):
                at = np.flatnonzero((lb == la[i]) & (pb != pa_[i]))
                at = at[np.argsort(-s[i, at], kind="stable")[:positives]]
                for x, y in zip(found, (np.full(len(at), pa_[i]), s[i, at], ids[at], pb[at]), strict=True):
                    x.append(y)
        return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in found], names=["anchor", "score", "vec_id", "place"])

    same = dealt(F.sequence("a0", "a1"), F.sequence("c0", "c1"), v.join(lies, "label"), anchors.join(lies, "label"), [])
    heap = _top(same.applyInArrow(best, "anchor long, score long, vec_id long, place long"), ["anchor"], positives)
    heap = stored(heap.select("anchor", "score", F.col("vec_id").alias("positive_id"), F.col("rank").alias("nth")), "positives")
    wanted = heap.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "score"))).alias("positive"))  # a few for each
    anchors = anchors.join(wanted.select(F.col("anchor").alias("place"), F.col("positive.score").alias("positive")), "place")

    def within(rows: pa.Table) -> pa.Table:
        made = _scores(rows, size)
        found: list = [[], [], [], [], []]
        if made:
            a, b, s = made
            la, lb, place, pb = (t.column(c).to_numpy() for c, t in (("label", a), ("label", b), ("place", a), ("place", b)))
            ids = b.column("vec_id").to_numpy()
            for i, scores in enumerate(a.column("positive").to_pylist()):
                at = np.flatnonzero(lb != la[i])
                down = -s[i, at]
                order = np.argsort(down, kind="stable")
                at, down = at[order], down[order]
                for k, p in enumerate(scores):
                    lo, hi = -(-low * p // 100), high * p // 100  # rounded into the window
                    start, end = np.searchsorted(down, -hi, "left"), np.searchsorted(down, -lo, "right")
                    x = at[start : max(start, min(end, start + negatives))]
                    for col, y in zip(found, (np.full(len(x), place[i]), np.full(len(x), k + 1), s[i, x], ids[x], pb[x]), strict=True):
                        col.append(y)
        return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in found], names=["anchor", "nth", "score", "vec_id", "place"])

    tiles_of = lambda rows, per: F.sequence(F.lit(0).cast("long"), F.lit((rows - 1) // per).cast("long"))
    other = dealt(tiles_of(n_anchors, per_a), tiles_of(n, per_c), v, anchors, ["positive"])
    window = _top(other.applyInArrow(within, "anchor long, nth long, score long, vec_id long, place long"), ["anchor", "nth"], negatives)
    ids = anchors.select(F.col("place").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    window = window.select("anchor", "nth", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = window.join(heap.withColumnRenamed("score", "positive_score"), ["anchor", "nth"]).join(ids, "anchor")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_negatives(spark, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(finite & F.col("label").isNotNull())
    return hard_negatives(v.select("vec_id", label.alias("label"), integers().alias("q"), (F.col("vec_id") % 100 == 0).alias("is_anchor")))


def oracle() -> str:
    return """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
