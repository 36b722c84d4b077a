"""Embedding near-dedup: an exact metric range join over pivot cells.

Unit vectors under chord distance. Pivots partition them into Voronoi cells. A
vector is replicated to another cell only if a partner there is possible: the
distance to the bisector of the two pivots, and the triangle inequality against
the cell's radius, both have to be within the range. A cell of many vectors is
cut into units of bounded size, and any two units that share vectors by
replication are joined on their own, each pair of units once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .graph import components

UNIT, MAX_PIVOTS = 4096, 1024


def _unit_vectors(raw: pa.Array, size: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw.to_pylist() if isinstance(raw, pa.Array) else raw), np.float64).reshape(-1, size)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have that cosine: single precision decides but near the threshold, double there."""
    out = np.zeros((len(a), len(b)), bool)
    fa, fb = a.astype(np.float32), b.astype(np.float32)
    margin = 1e-6 * (8 + a.shape[1])
    for i in range(0, len(a), 1024):
        s = fa[i : i + 1024] @ fb.T
        near = s >= threshold - margin
        if near.any():
            r, c = np.nonzero(near & (s < threshold + margin))
            near[r, c] = np.einsum("ij,ij->i", a[i + r], b[c]) >= threshold
            out[i : i + 1024] = near
    return out


def _labels(s: np.ndarray, la: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label within reach for both sides of a bipartite graph."""
    big = np.iinfo(np.int64).max
    while True:
        na = np.minimum(la, np.where(s, lb[None, :], big).min(1))
        nb = np.minimum(lb, np.where(s, na[:, None], big).min(0))
        if (na == la).all() and (nb == lb).all():
            return na, nb
        la, lb = na, nb


def link_vectors(vectors: DataFrame, *, threshold: float = 0.9, unit: int = UNIT) -> DataFrame:
    """One row for each row of ``vectors(vec_id, embedding)``: ``vec_id, n_links, component_id, kept``.

    Two vectors link at a cosine of ``threshold`` or more, in double precision.
    Vectors that are null, empty, zero or hold nulls or non-finite numbers link
    with nothing, and so do rows with a null vec_id (component null, kept
    false). A shorter vector counts as padded with zeros. Equal vectors are one
    node with a weight, so a group of copies isn't compared with itself; rows
    count as separate vectors even if they share an id. Other columns are
    ignored; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    limit = F.lit(float("inf"))
    usable = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists("e", lambda x: x != 0)
    ok = F.coalesce(F.col("vec_id").isNotNull() & (F.size("e") > 0) & usable, F.lit(False))
    size = v.where(ok).agg(F.max(F.size("e"))).first()[0] or 1

    def pack(batches):
        for batch in batches:
            e = batch.column("e")
            n = np.diff(np.asarray(e.offsets))
            rows = np.zeros((batch.num_rows, size))
            rows[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = e.flatten().to_numpy(zero_copy_only=False)
            rows += 0.0  # -0.0 and 0.0 are equal
            top = np.abs(rows).max(1, initial=0.0)
            rows /= np.ldexp(1.0, np.frexp(np.where(top > 0, top, 1.0))[1])[:, None]  # exact, and squares can't overflow
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["vec_id", "x"])

    packed = stored(v.where(ok).mapInArrow(pack, "vec_id long, x binary"), "vectors")
    nodes = stored(packed.groupBy("x").agg(F.min("vec_id").alias("node"), F.count("*").alias("w")), "nodes")
    n = nodes.count()
    k = min(MAX_PIVOTS, max(1, -(-n // unit)))
    sampled = nodes.orderBy(F.xxhash64("x"), "node").limit(k).collect()  # at most MAX_PIVOTS vectors
    rest = v.where(~ok).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if not sampled:
        return rest
    pivots = _unit_vectors([bytes(r["x"]) for r in sampled], size)
    theta = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9

    def home(batches):
        for batch in batches:
            s = _unit_vectors(batch.column("x"), size) @ pivots.T
            at = s.argmax(1)
            radius = np.sqrt(np.maximum(0, 2 - 2 * s.max(1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "w", "x")), pa.array(at.astype(np.int64)), pa.array(radius)], names=["node", "w", "x", "home", "radius"])

    homes = stored(nodes.select("node", "w", "x").mapInArrow(home, "node long, w long, x binary, home long, radius double"), "homes")
    radius, units = np.full(k, -10.0), np.zeros(k, np.int64)
    for r in homes.groupBy("home").agg(F.count("*").alias("n"), F.max("radius").alias("r")).collect():  # a row for each pivot
        radius[r["home"]], units[r["home"]] = r["r"], -(-r["n"] // unit)
    first = np.concatenate([[0], np.cumsum(units)])  # units of a cell have consecutive numbers
    apart = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))

    def spread(batches):
        for batch in batches:
            x = _unit_vectors(batch.column("x"), size)
            s, at = x @ pivots.T, np.asarray(batch.column("home"))
            node = np.asarray(batch.column("node"))
            own = first[at] + (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % units[at]
            mine = s[np.arange(len(at)), at]
            bisector = (mine[:, None] - s) / np.maximum(apart[at], 1e-12)
            go = (bisector <= theta + 1e-9) & (np.sqrt(np.maximum(0, 2 - 2 * s)) <= radius + theta + 1e-9) & (units > 0)
            go[np.arange(len(at)), at] = True
            row, cell = np.nonzero(go)
            many = units[cell]
            row = np.repeat(row, many)
            other = np.repeat(first[cell], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            u, lo, hi = own[row], np.minimum(own[row], other), np.maximum(own[row], other)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi), pa.array(u == lo), *(batch.column(c).take(take) for c in ("node", "w", "x"))], names=["u", "v", "low", "node", "w", "x"])

    dealt = homes.mapInArrow(spread, "u long, v long, low boolean, node long, w long, x binary")

    def join(key, rows: pd.DataFrame) -> pd.DataFrame:
        same = key[0] == key[1]
        a = rows if same else rows[rows["low"]]
        b = rows if same else rows[~rows["low"]]
        none = pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "label": pd.Series(dtype="int64")})
        if not len(a) or not len(b):
            return none
        xa = _unit_vectors(a["x"].tolist(), size)
        s = _pairs(xa, xa if same else _unit_vectors(b["x"].tolist(), size), threshold)
        if same:
            np.fill_diagonal(s, False)
        ra, rb = np.flatnonzero(s.any(1)), np.flatnonzero(s.any(0))
        if not len(ra):
            return none
        s = s[np.ix_(ra, rb)]
        na, wa, nb, wb = (d[c].to_numpy()[r] for d, r in ((a, ra), (b, rb)) for c in ("node", "w"))
        la, lb = _labels(s, na, nb)
        out = [pd.DataFrame({"node": na, "links": s @ wb, "label": la})]
        if not same:
            out.append(pd.DataFrame({"node": nb, "links": s.T @ wa, "label": lb}))
        return pd.concat(out)

    found = stored(dealt.groupBy("u", "v").applyInPandas(join, "node long, links long, label long"), "vector-links")
    label = components(found.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a <> b"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_node = nodes.select("x", "node", "w").join(links, "node", "left").join(label, "node", "left")
    of_node = of_node.select("x", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = packed.join(of_node, "x").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return out.union(rest)


def op3_embeddings(spark, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
