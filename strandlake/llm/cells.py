"""Links between the members of cells, without comparing all of them with all.

A cell is a group of nodes that may be linked: a region of a metric space or a
bucket of a signature. The first pivot of every cell is compared with all its
members. What lies within the threshold of it forms one component with it, so
those members need no comparison with each other. The rest is joined
recursively, members of different components only: growing numbers of further
pivots against the members within the triangle-inequality windows around the
first pivot, until every open pair has been compared or excluded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import few, sendable, stored
from .graph import components, extended

#: Pivots of a cell in the first round, 16 times as many in the next; after ROUNDS of them, or with no more than FEW_PAIRS open pairs, all members are pivots.
PIVOTS, ROUNDS, FEW_PAIRS = 8, 2, 200_000
#: Sketches of more longs are compared in a loop: written out, 16 of them make 5,300 bytes of code, which a join of few pairs runs uncompiled.
INLINE = 8
#: Of such sketches this many longs are compared first, written out; they exclude most pairs.
HEAD = 6
#: Cells of a node that tell where it has met another before.
MET = 32


def without(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` whose ``col`` isn't in ``ids(node)``; nulls stay."""
    ids = stored(ids.select(F.col("node").cast("long").alias("_node")).distinct(), "ids")
    return df.join(sendable(ids), F.col(col).cast("long") == F.col("_node"), "left_anti")


def _ones(a: str, b: str, longs: int) -> Column:
    if longs > INLINE:
        bits = F.zip_with(f"{a}sketch", f"{b}sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        return F.aggregate(bits, F.lit(0), lambda s, n: s + n).cast("long")
    ones = F.lit(0)
    for i in range(longs):
        ones = ones + F.bit_count(F.get(f"{a}sketch", F.lit(i)).bitwiseXOR(F.get(f"{b}sketch", F.lit(i))))
    return ones.cast("long")


def _apart(a: str, b: str, longs: int) -> Column:
    """A lower bound of the symmetric difference of the sets in the columns ``a…size, a…sketch`` and ``b…``."""
    return F.greatest(_ones(a, b, longs), F.abs(F.col(f"{a}size") - F.col(f"{b}size")).cast("long"))


def _possible(a: str, b: str, share: int, longs: int) -> Column:
    """Whether sizes and sketches allow a Jaccard similarity of ``share`` percent.

    The similarity is (total - apart) / (total + apart). Each bound stands in
    the condition once: one that is much longer isn't compiled by the JVM.
    """
    most = (F.col(f"{a}size") + F.col(f"{b}size")) * (100 - share)
    near = F.abs(F.col(f"{a}size") - F.col(f"{b}size")) * (100 + share) <= most
    if longs > INLINE:
        near = near & (_ones(a, b, HEAD) * (100 + share) <= most)
    return near & (_ones(a, b, longs) * (100 + share) <= most) if longs else near


def with_met(rows: DataFrame) -> DataFrame:
    """``rows(cell, node, …)`` with ``met``: those of the node's :data:`MET` smallest cells that are smaller than ``cell``.

    Two nodes whose ``met`` overlap share a smaller cell. A pair that is only made in cells where
    they don't is still made in the smallest cell that it shares, and mostly in no other.
    """
    least = rows.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("cell")), 1, MET).alias("_least"))  # of one node
    return rows.join(least, "node").withColumn("met", F.filter("_least", lambda c: c < F.col("cell"))).drop("_least")


def in_company(rows: DataFrame, common: Column | None = None) -> DataFrame:
    """Cells of two or more members, each set of members once: ``cell, node, size, sketch``.

    ``rows(cell, node, size, sketch)`` are distinct; without a sketch the result has none. Near copies share dozens of cells
    with the same members; such cells are one, named by a hash of the members.
    Cells for which ``common`` holds may have very many members: they are
    counted by aggregation with map-side combining; the others by a window.
    """
    name = F.xxhash64("_n", "_sign")
    member = [c for c in ("node", "size", "sketch") if c in rows.columns]
    by = Window.partitionBy("cell")
    rare = rows if common is None else rows.where(~common)
    rare = rare.withColumn("_n", F.count("*").over(by)).where("_n > 1").withColumn("_sign", F.bit_xor(F.xxhash64("node")).over(by))
    out = rare.select(name.alias("cell"), *member)
    if common is not None:
        wide = rows.where(common)
        count = wide.groupBy("cell").agg(F.count("*").alias("_n"), F.bit_xor(F.xxhash64("node")).alias("_sign")).where("_n > 1")
        out = out.union(wide.join(count, "cell").select(name.alias("cell"), *member))
    return out.distinct()


def link_cells(
    cells: DataFrame, judge: Callable[[DataFrame, int], DataFrame], *, share: int = 80, longs: int = 1,
    sketches: tuple[int, Callable[[DataFrame], DataFrame]] | None = None,
) -> DataFrame:
    """``(node, component)``, the components that all links together would give, for the nodes that have a link.

    ``cells(cell, node, size, sketch)``: distinct rows, ``sketch`` an array of
    ``longs`` longs; two nodes can only be linked if they share a cell. ``judge`` takes distinct pairs ``(a, b)`` and their number,
    and returns ``(a, b, lo, hi, linked)``: bounds of their Jaccard distance, and whether
    they are linked. ``sketches`` makes longer sketches for the nodes ``(node)`` that
    need them: their number of longs, and a function that returns ``(node, sketch)``.
    No pair of different components is left out but by the
    sizes, by the sketches or by the triangle inequality, so the components are exact for
    whatever shares a cell.
    """
    theta = 1 - share / 100 + 1e-9
    n_rows = cells.count()
    judged_pairs = lambda pairs, most: _judged(pairs, judge, most)
    pivots = cells.groupBy("cell").agg(F.count("*").alias("n"), F.min(F.struct("node", "size", "sketch")).alias("p"))
    pivots = pivots.select("cell", "n", F.col("p.node").alias("p"), F.col("p.size").alias("p_size"), F.col("p.sketch").alias("p_sketch"))
    spoke = stored(few(cells.join(pivots, "cell").where("node <> p"), n_rows), "spokes")
    able = spoke.where(_possible("", "p_", share, longs))
    # first each node meets the pivot of its largest cell only: near copies share many cells, and one of them settles most
    nearest = able.groupBy("node").agg(F.max(F.struct("n", "p"))["p"].alias("a")).select("a", F.col("node").alias("b"))
    links = lambda judged: judged.where("linked").select("a", "b")
    judged = judged_pairs(nearest, n_rows)
    label = components(links(judged), rows=n_rows)
    held = sendable(label)
    of = lambda c: held.select(F.col("node").alias(c), F.col("component").alias(f"{c}_comp"))
    apart = able.join(of("node"), "node", "left").join(of("p"), "p", "left")
    apart = apart.where(F.coalesce("node_comp", "node") != F.coalesce("p_comp", "p")).select(F.col("p").alias("a"), F.col("node").alias("b")).distinct()
    more = judged_pairs(apart.join(judged, ["a", "b"], "left_anti"), n_rows)
    judged = judged.union(more)
    around = judged.select(F.col("a").alias("p"), F.col("b").alias("node"), "lo", "hi")
    far = 2 * _apart("", "p_", longs) / (F.col("size") + F.col("p_size") + _apart("", "p_", longs))
    rest = spoke.join(around, ["p", "node"], "left")
    rest = rest.select("cell", "node", "size", "sketch", F.coalesce("lo", far).alias("lo"), F.coalesce("hi", F.lit(1.0)).alias("hi"))
    turn, k = 0, PIVOTS
    while True:
        label = extended(label, links(more), rows=n_rows)
        named = rest.join(sendable(label), "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        named = stored(few(named, n_rows), "named")
        groups = named.groupBy("cell", "comp").agg(F.count("*").alias("n"))
        total = groups.groupBy("cell").agg(F.sum("n").alias("members"), F.sum(F.col("n") * F.col("n")).alias("same"), F.count("*").alias("comps")).where("comps > 1")
        total = stored(few(total, n_rows), "open")
        open_pairs, n_open = total.agg(F.sum((F.col("members") * F.col("members") - F.col("same")) / 2), F.count("*")).first()
        if not n_open:
            return label
        live = named.join(sendable(total.select("cell", "members")), "cell")
        if sketches and not turn:
            longs = sketches[0]
            live = live.drop("sketch").join(sketches[1](live.select("node").distinct()), "node")
        live = stored(few(live, n_rows), "live")
        # about k pivots of each cell, the same nodes in all their cells, meet the members of other components; all are pivots once few pairs are left
        last = open_pairs <= FEW_PAIRS or turn == ROUNDS
        is_pivot = F.lit(True) if last else F.pmod(F.xxhash64(F.lit(turn), "node"), F.col("members")) < k
        # near copies share dozens of cells, and each pair is wanted once
        again = last and open_pairs > FEW_PAIRS
        here = stored(few(with_met(live), n_rows), "met") if again else live
        side = lambda df, c: df.select("cell", *[F.col(n).alias(f"{c}{n}") for n in ("node", "size", "sketch", "comp", "lo", "hi", *["met"] * again)])  # noqa: E731, B023
        near = side(here.where(is_pivot), "x_").join(side(here, "y_"), "cell").where("x_comp <> y_comp")
        if last:
            near = near.where("x_node < y_node")
        # the windows first: sketches cost more
        near = near.where((F.col("x_lo") - F.col("y_hi") <= theta) & (F.col("y_lo") - F.col("x_hi") <= theta)).where(_possible("x_", "y_", share, longs))
        if again:
            near = near.where(~F.arrays_overlap("x_met", "y_met"))
        pairs = near.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
        more = judged_pairs(pairs, n_rows)
        if last:
            return extended(label, links(more), rows=n_rows)
        rest = live.where(~is_pivot).select("cell", "node", "size", "sketch", "lo", "hi")
        turn, k = turn + 1, k * 16


def _judged(pairs: DataFrame, judge: Callable[[DataFrame, int], DataFrame], most: int) -> DataFrame:
    pairs = stored(few(pairs, most), "pairs")
    n = pairs.count()
    return stored(few(judge(few(pairs, n), n), n, 20_000), "judged")
