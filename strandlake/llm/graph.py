"""Distributed union-find: components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, few, sendable, stored


def components(edges: DataFrame, *, rows: int | None = None, max_rounds: int = 60) -> DataFrame:
    """Map each node of ``edges(a, b)`` to the smallest node that it reaches.

    Returns ``(node, component)`` for every node of an edge that isn't a loop.
    Each round hangs every node on the neighbour that comes first in an order,
    follows that for some steps and contracts the edges by that. The first two rounds go
    by id, which settles stars around their smallest node; later ones go by a
    random order of the round, so a fixed share of the nodes goes in each, also
    on long paths. Hubs are
    pre-aggregated (min), never gathered. Every round is written to the shared
    folder. An empty table gives an empty table. ``rows``: no more edges than
    this, if that is known.
    """
    kind = edges.schema["a"].dataType
    live = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = stored(live if rows is None else few(live, rows), "edges")
    parents = []
    while n := live.count():
        if len(parents) == max_rounds:
            raise RuntimeError(f"the components didn't settle in {max_rounds} rounds")
        both = live.select(F.col("a").alias("node"), F.col("b").alias("to")).union(live.select("b", "a"))
        turn = F.xxhash64 if len(parents) > 1 else lambda *_: F.lit(0).cast("long")
        ranked = lambda c: F.struct(turn(c, F.lit(len(parents))).alias("h"), F.col(c).alias("id"))  # noqa: E731, B023
        first = both.groupBy("node").agg(F.min(ranked("to")).alias("to")).select("node", F.least("to", ranked("node"))["id"].alias("parent"))
        parent = first
        for _ in range(3 if n <= 200_000 else 1):
            jump = first.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
            parent = parent.join(jump, "parent").select("node", F.col("up").alias("parent"))
        parent = stored(few(parent, 2 * n), "parent")
        parents.append(parent)
        pa = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        pb = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        up = live.join(pa, "a").join(pb, "b").where("pa <> pb")
        before, live = live, stored(few(up.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), n), "edges")
        drop_stored(before)
    if not parents:
        return edges.sparkSession.createDataFrame([], f"node {kind.simpleString()}, component {kind.simpleString()}")
    whole = parents[0]
    for parent in parents[1:]:
        step = parent.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        whole = whole.join(step, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"))
    nodes = parents[0].count()
    whole = stored(few(whole, nodes), "roots")
    least = whole.groupBy("parent").agg(F.least(F.min("node"), F.col("parent")).alias("component"))
    out = stored(few(whole.join(least, "parent").select("node", "component"), nodes), "components")
    for table in (live, whole, *parents):
        drop_stored(table)
    return out


def extended(label: DataFrame, edges: DataFrame, *, rows: int) -> DataFrame:
    """What :func:`components` gives of the edges behind ``label(node, component)`` and further ``edges(a, b)``, no more than ``rows``.

    Only the further edges are followed, between components instead of nodes.
    """
    held = sendable(label)
    of = lambda c: held.select(F.col("node").alias(c), F.col("component").alias(f"{c}_comp"))
    between = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b"))
    joined = components(between, rows=rows)
    if joined.isEmpty():
        return label
    up = sendable(joined.select(F.col("node").alias("component"), F.col("component").alias("up")))
    moved = label.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    # a component bears the name of one of its nodes
    new = joined.join(held.select("node"), "node", "left_anti").select("node", "component")
    return stored(few(moved.union(new), 2 * rows), "components")
