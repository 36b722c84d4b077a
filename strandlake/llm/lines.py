"""Fuzzy line dedup by MinHash, in DataFrame functions only.

A line's shingles are its windows of eight characters (UTF-16 code units) at
every position; a shorter line is its own one shingle. Equal lines are folded
first, so a line is shingled once however often it stands in the corpus.
Signatures band the distinct lines; pairs that share a band are verified by the
exact Jaccard similarity of their shingle sets; distributed union-find makes the
components, and the first line of each stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import in_company, link_cells
from .common import MAX_IDS, few, once, row_key, sendable, settled, stored, table

#: Characters in a shingle.
WIDTH = 8
#: At a similarity of just 0.8 a band of three minima meets in 51 % of the cases, one of seven bands in 99.3 %.
BANDS, ROWS = 7, 3
#: Lines under SHORT shingles are banded by permutations, those from LONG on by classes of the hashes; sizes in between by both,
#: so that any two lines whose sizes allow the similarity share a scheme.
SHORT, LONG = 20, 16
SHARE = 80
#: Longs of a sketch that excludes pairs in large cells.
LONGS = 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value made once. A binary column read within a lambda would be copied at each step."""
    return F.transform(F.array(value), body)[0]


def windows(line: Column) -> Column:
    """Hashes of the windows at every position, in order, repeats included.

    A UTF-16 unit has two bytes, so a window is a slice of bytes that is found
    without scanning what is before it: linear in the line.
    """
    width = 2 * WIDTH
    starts = lambda b: F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(b) - width + 1), F.lit(2))
    cut = lambda b: F.transform(starts(b), lambda i: F.xxhash64(F.substring(b, i, F.lit(width))))
    return _let(F.encode(line, "UTF-16BE"), cut)


def with_sets(lines: DataFrame, line: str, into: str) -> DataFrame:
    """``lines`` with the array of the distinct shingle hashes of a column; in two steps, so that nothing is made twice."""
    return lines.withColumn(into, windows(F.col(line))).withColumn(into, F.array_distinct(into))


#: Marks that cut the hash range into classes.
MARKS = [-(1 << 63) + ((1 << 64) // BANDS) * j for j in range(BANDS)]
#: One seed for each permutation of short sets: three minima of five are less often common than three of many, so ten bands.
SEEDS = range(1, 11)


def _marks() -> Column:
    return F.array(*[F.lit(m).cast("long") for m in MARKS])


def with_marks(h: Column) -> Column:
    """The distinct hashes of ``h`` and the marks, sorted."""
    return F.sort_array(F.concat(F.array_distinct(h), _marks()))


def marks_at(marked: Column) -> Column:
    """Places of the marks in ``marked``, from 1; the first mark is the least long."""
    return F.array(F.lit(1), *[F.array_position(marked, F.lit(m).cast("long")).cast("int") for m in MARKS[1:]])


def band_keys(marked: Column, n: Column, at: Column | None = None) -> Column:
    """Band keys of the ``n`` distinct shingle hashes in ``marked``, a column made by :func:`with_marks`.

    ``at`` is a column made by :func:`marks_at`; without it every band looks for its marks again.

    Long sets: ``BANDS`` marks cut the hash range into classes; a band is the
    ``ROWS`` smallest hashes of a class, which are those many minima of one hash
    function. The marks are sorted in with the hashes, so a class is a slice
    behind its mark and nothing is filtered. Short sets: hashed again with a
    seed of each of ten independent bands; a band is the ``ROWS`` smallest. Sets of under four are alike
    only if equal. The key of a class without hashes is null.
    """
    # a lambda of two parameters would get the index as its second
    again = lambda seed: lambda x: F.xxhash64(F.lit(seed), x)
    h = F.array_except(marked, _marks())  # sorted; only short sets ask for it
    at = marks_at(marked) if at is None else at
    place = lambda j: F.get(at, F.lit(j))

    def band(j):
        end = F.size(marked) + 1 if j == BANDS - 1 else place(j + 1)
        return F.when(place(j) + 1 < end, F.xxhash64(F.lit(j), F.slice(marked, place(j) + 1, ROWS)))

    long = [band(j) for j in range(BANDS)]  # no band of an empty class
    short = [F.xxhash64(F.lit(100 + seed), F.slice(F.sort_array(F.transform(h, again(seed))), 1, ROWS)) for seed in SEEDS]
    none = F.array().cast("array<long>")
    return F.when(n < 4, F.array(F.xxhash64(F.lit(99), h))).otherwise(
        F.concat(F.when(n >= LONG, F.array(*long)).otherwise(none), F.when(n < SHORT, F.array(*short)).otherwise(none))
    )


def _lines(docs: DataFrame, place: tuple[str, ...] = ()) -> DataFrame:
    line = docs.where("text IS NOT NULL").select(*place, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return line.select(*place, "line_no", F.trim("line").alias("line")).where("line <> ''")


def _node(line: str) -> Column:
    return F.xxhash64(line).alias("node")


def line_bands(lines: DataFrame) -> DataFrame:
    """``node, size, keys`` of distinct ``lines(line)``: the number of distinct shingles and the band keys."""
    prepared = lines.select(_node("line"), windows(F.col("line")).alias("h"))
    # columns of their own, or every band would sort and look for its marks again
    prepared = prepared.select("node", with_marks(F.col("h")).alias("marked"))
    prepared = prepared.select("node", (F.size("marked") - BANDS).alias("size"), "marked", marks_at(F.col("marked")).alias("at"))
    return prepared.select("node", "size", band_keys(F.col("marked"), F.col("size"), F.col("at")).alias("keys"))


def _judge(text: DataFrame) -> Callable[[DataFrame, int], DataFrame]:
    """Exact similarities of pairs of lines of ``text(node, size, line)``, for :func:`link_cells`."""

    def judge(pairs: DataFrame, n: int) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        nodes = F.broadcast(nodes) if 2 * n <= MAX_IDS else nodes
        asked = stored(few(text.join(nodes, "node", "left_semi"), 2 * n, 20_000), "asked")
        side = lambda c: asked.select(F.col("node").alias(c), F.col("line").alias(f"l{c}"), F.col("size").alias(f"n{c}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        both = both.withColumn("sa", windows(F.col("la"))).withColumn("sb", windows(F.col("lb")))
        # what a has alone takes one hash table, an intersection two
        shared = F.col("na") - F.size(F.array_except("sa", "sb"))
        sizes = both.select("a", "b", shared.alias("i"), (F.col("na") + F.col("nb")).alias("total"))
        distance = 1 - F.col("i") / (F.col("total") - F.col("i"))
        linked = F.col("i") * 100 >= (F.col("total") - F.col("i")) * SHARE
        return sizes.select("a", "b", distance.alias("lo"), distance.alias("hi"), linked.alias("linked"))

    return judge


def _sketches(text: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Parity sketches of :data:`LONGS` longs of the shingle sets of lines, for :func:`link_cells`."""

    def sketch(nodes: DataFrame) -> DataFrame:
        x = with_sets(text.join(nodes, "node", "left_semi"), "line", "h")
        x = x.select("node", F.explode_outer("h").alias("h"))  # no set is empty; a plain explode makes them all once more to see that
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(63).cast("int"))
        word = F.shiftright("h", 6).bitwiseAND(LONGS - 1)
        x = x.select("node", bit.alias("bit"), word.alias("word"))
        parts = [F.coalesce(F.bit_xor(F.when(F.col("word") == i, F.col("bit"))), F.lit(0).cast("long")).alias(f"s{i}") for i in range(LONGS)]
        return x.groupBy("node").agg(*parts).select("node", F.array(*[f"s{i}" for i in range(LONGS)]).alias("sketch"))

    return sketch


def line_classes(docs: DataFrame, place: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each line that isn't blank: ``doc_id, line_no, n_shingles, component_id, kept``.

    The columns of ``place`` name a document, and come in place of ``doc_id``.

    Lines whose shingle sets have a Jaccard similarity of 0.8 or more are
    linked; of each component the line with the smallest (doc_id, line_no) is
    kept. A component is named by the hash of one of its lines. Lines are
    compared without the spaces around them, case as it is. Blank lines and null
    texts have no row; rows with the same id and line number are one place and
    share their fate; a null doc_id sorts first; other columns are ignored; an
    empty table gives an empty table. Lines and shingles stand for themselves by
    64-bit hashes. A task holds some thirty bytes for each character of one line.
    """
    places = stored(_lines(docs, place).select(*place, "line_no", _node("line")), "places")
    sets = stored(line_bands(_lines(docs).select("line").distinct()), "sets")
    banded = sets.select(F.explode("keys").alias("cell"), "node", "size").where("cell IS NOT NULL")
    no_sketch = F.array().cast("array<long>").alias("sketch")  # sketches of 64 bits exclude no pair of lines of usual length
    shared = stored(in_company(banded).select("cell", "node", "size", no_sketch), "cells")
    nodes = stored(shared.select("node", "size").distinct(), "nodes")
    text = stored(_lines(docs).select(_node("line"), "line").join(sendable(nodes), "node").dropDuplicates(["node"]), "texts")
    label = link_cells(shared, _judge(text), share=SHARE, longs=0, sketches=(LONGS, _sketches(text)))
    at, held = F.struct(*place, "line_no"), sendable(label)
    # the first place of each line, and of those that are linked the first of the component
    first = places.groupBy("node").agg(F.min(at).alias("own_first"))
    linked = stored(places.join(held, "node").groupBy("component").agg(F.min(at).alias("first")), "firsts")
    of_node = sets.select("node", F.col("size").alias("n_shingles")).join(first, "node").join(held, "node", "left").join(sendable(linked), "component", "left")
    of_node = of_node.select("node", "n_shingles", F.coalesce("component", "node").alias("component_id"), F.coalesce("first", "own_first").alias("first"))
    return places.join(of_node, "node").select(*place, "line_no", "n_shingles", "component_id", at.eqNullSafe(F.col("first")).alias("kept"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that :func:`line_classes` doesn't keep.

    A document is a pair of id and text here: ids may be null or repeated, and
    equal rows are one document. ``n_chars`` follows the text where there is
    such a column. A document that loses all its lines goes; one that had none
    stays as it is. Other columns stay, whatever their names.
    """
    keyed = once(docs.select(row_key().alias("_key"), F.struct(*docs.columns).alias("_row")), "_key")
    named = docs.select("doc_id", row_key().alias("_key"), "text")
    gone = settled(docs.sparkSession, lambda: line_classes(named, ("doc_id", "_key")).where("NOT kept").select("_key", "line_no"), "gone")
    gone = gone.groupBy("_key").agg(F.collect_set("line_no").alias("_gone"))  # no more than the document has lines
    out = keyed.join(gone, "_key", "left").withColumn("_lines", F.split("_row.text", "\n"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    left = F.array_join(F.transform(stays, lambda i: F.get("_lines", i)), "\n")
    out = out.withColumn("_left", F.when(F.col("_gone").isNotNull(), left))
    out = out.where(F.col("_gone").isNull() | (F.trim(F.regexp_replace("_left", r"\s+", " ")) != ""))
    new = {"text": F.coalesce("_left", "_row.text"), "n_chars": F.when(F.col("_gone").isNull(), F.col("_row.n_chars")).otherwise(F.length("_left").cast("long")) if "n_chars" in docs.columns else None}
    return out.select(*[new[c].alias(c) if c in new else F.col("_row")[c].alias(c) for c in docs.columns])


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents"))
