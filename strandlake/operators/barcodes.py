"""Barcodes: slicing them out of read 2, correcting, tallying, plates and grids."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from ..functions.columns import UNKNOWN, number_of, well_number
from ..functions.sequences import byte_matrix
from .counting import ranked

#: Tail motifs that tell the molecule type, first match wins. Fixed values.
MOTIFS = (("TGCA", "rna"), ("GGCC", "dna"))


def admissible(seq: Column, *, lumi: int = 10, lbc: int = 8, lsn: int = 4, lln: int = 30, max_n: int = 3) -> Column:
    """Long enough for all parts, and not too many unknown bases."""
    return (F.length(seq) >= lumi + 2 * lbc + 2 * lln + lsn) & (number_of(seq, "N") <= max_n)


def known_umi(umi: Column) -> Column:
    """The umi, null where its first base is unknown: bases were skipped or not read."""
    return F.when(~umi.startswith("N"), umi)


def molecule_type(tail: Column, motifs=MOTIFS, otherwise: str = "unk") -> Column:
    out = F.lit(otherwise)
    for motif, kind in reversed(motifs):
        out = F.when(tail.contains(motif), F.lit(kind)).otherwise(out)
    return out


def _anchor(linker1: str, linker2: str, lumi: int, lbc: int, max_mismatch: int | None):
    """Arrow function that gives linker 1's place in each read by the mismatches of both linkers, or null.

    A batch is a byte matrix; all offsets of all reads are compared at once, a linker base at a time.
    """
    lln = len(linker1)
    first, second = np.arange(lbc, lumi + lbc + 6), np.arange(lbc + lln, lumi + 2 * lbc + 6 + lln)
    width = int(second[-1]) + len(linker2)

    def mismatches(data: np.ndarray, at: np.ndarray, linker: str) -> np.ndarray:
        out = np.zeros((len(data), len(at)), np.int16)
        for j, base in enumerate(linker.encode()):
            out += data[:, at + j] != base  # what lies behind a read's end is a mismatch
        return out

    @pandas_udf("int")
    def anchors(seq: pd.Series) -> pd.Series:
        out = pd.Series(pd.NA, seq.index, "Int32")
        have = seq.notna()
        if have.any():
            data, _ = byte_matrix([x[:width] for x in seq[have]], width)
            m1 = mismatches(data, first, linker1)
            one = first[m1.argmin(1)]
            m2 = np.where(second >= one[:, None] + lln, mismatches(data, second, linker2), 10_000)
            two = second[m2.argmin(1)]
            m1, m2 = m1.min(1), m2.min(1)
            off = two - (one + lln + lbc)
            # a barcode lies between the linkers; if linker 2 fits better, it tells where linker 1 is
            fits = (off == 0) | ((off < 0) & (-off < lbc) & (m2 < m1))
            place = one + off
            if max_mismatch is not None:
                fits &= np.maximum(m1, m2) <= max_mismatch
            out[have] = pd.arrays.IntegerArray(place.astype(np.int32), ~(fits & (place >= lbc)))
        return out

    return anchors


def extract_barcodes(
    reads: DataFrame, linker1: str, linker2: str, *, seq: str = "seq", qual: str | None = None, lumi: int = 10, lbc: int = 8, lsn: int = 4, spacer: int = 1, site: int = 8, max_mismatch: int | None = None
) -> DataFrame:
    """``reads`` with ``umi, bc1, bc2, sbc, res, tail`` cut out of ``seq``, and ``tail_qual`` out of ``qual`` if that is named; null where the linkers don't fit.

    Layout: umi, bc1, a gap of up to 5 bases, linker 1, bc2, linker 2, a spacer,
    sample barcode, restriction site, tail. A linker that begins too early shows that bases
    were skipped: they count as the umi's, which is padded with N on the left. ``res``
    holds the spacer and the site; in a read that ends before its sample barcode it is N and ``sbc`` null.

    One pass: exact linkers are found by built-ins, and only the other reads'
    sequences go to the Arrow function that scores mismatches.
    """
    lln = len(linker1)
    s = F.col(seq)
    l1 = F.instr(s, linker1) - 1
    second = F.substring(s, l1 + lln + lbc + 1, F.lit(len(linker2)))
    exact = F.coalesce((l1 >= lbc) & (l1 <= lumi + lbc + 5) & (second == linker2), F.lit(False))
    at = F.coalesce(F.when(exact, l1), _anchor(linker1, linker2, lumi, lbc, max_mismatch)(F.when(~exact, s)))
    out = reads.withColumn("_at", at.cast("int"))
    at = F.col("_at")
    part = lambda start, n, of=s: F.substring(of, (start + 1).cast("int"), F.lit(n))
    skipped = at < lumi + lbc
    missing = F.least(F.lit(lumi), lumi + lbc - at)
    umi = F.when(skipped, F.concat(F.repeat(F.lit("N"), missing), F.substring(s, F.lit(1), lumi - missing))).otherwise(part(F.lit(0), lumi))
    bc1 = F.when(skipped, part(at - lbc, lbc)).otherwise(part(F.lit(lumi), lbc))
    end = at + lln + lbc + len(linker2)  # of linker 2
    whole = end + spacer < F.length(s)
    sbc = part(end + spacer, lsn)
    res = F.when(whole, F.concat(part(end, spacer), part(end + spacer + lsn, site))).otherwise("N" * (spacer + site))
    rest = lambda of: F.when(whole, F.substring(of, (end + spacer + lsn + site + 1).cast("int"), F.length(of))).otherwise("")
    cut = {"umi": umi, "bc1": bc1, "bc2": part(at + lln, lbc), "sbc": F.when(whole & (F.length(sbc) == lsn), sbc), "res": res, "tail": rest(s)}
    if qual:
        cut["tail_qual"] = rest(F.col(qual))
    return out.withColumns({c: F.when(at.isNotNull(), x) for c, x in cut.items()}).drop("_at")


def neighbourhood(whitelist: DataFrame) -> DataFrame:
    """``variant, name``: every string within one substitution of a whitelist entry.

    An exact entry wins over a neighbour, then the lowest rank. The table has
    4 * length + 1 rows for each entry, so its size follows the whitelist alone.
    """
    exact = whitelist.select(F.col("seq").alias("variant"), "name", F.lit(0).alias("d"), "rank")
    at = whitelist.select("name", "rank", "seq", F.explode(F.sequence(F.lit(1), F.length("seq"))).alias("i"))
    at = at.withColumn("base", F.explode(F.array(*[F.lit(b) for b in "ACGTN"])))
    near = at.select(F.expr("concat(substring(seq, 1, i - 1), base, substring(seq, i + 1))").alias("variant"), "name", F.lit(1).alias("d"), "rank")
    return exact.union(near).groupBy("variant").agg(F.min_by("name", F.struct("d", "rank")).alias("name"))


def correct(reads: DataFrame, whitelist: DataFrame, column: str, into: str) -> DataFrame:
    """``reads`` with ``into``: the whitelist name within one mismatch of ``column``, else null.

    An equi-join with the neighbourhood; Spark broadcasts it if it is small.
    """
    near = neighbourhood(whitelist).withColumnRenamed("name", into).withColumnRenamed("variant", "_variant")
    return reads.join(near, F.col(column) == F.col("_variant"), "left").drop("_variant")


def read_name(read_id: Column, parsed: Column, raw: Column, number: Column, longest: int = 100) -> Column:
    """``name|parsed|raw``; a name that gets too long becomes the read's number."""
    full = F.concat_ws("|", read_id, parsed, raw)
    return F.when(F.length(full) > longest, F.concat_ws("|", F.concat(F.lit("read"), number.cast("string")), parsed, raw)).otherwise(full)


def tally_cells(decoded: DataFrame) -> DataFrame:
    """Reads by sample and cell; undecoded umis or samples under ``*, *``, undecoded wells under ``sample, *``."""
    lost = F.col("umi").isNull() | F.col("sample").isNull()
    sample = F.when(lost, UNKNOWN).otherwise(F.col("sample"))
    wells = F.when(lost | F.col("bc1").isNull() | F.col("bc2").isNull(), UNKNOWN).otherwise(F.concat_ws(":", "bc1", "bc2"))
    return decoded.groupBy(sample.alias("sample"), wells.alias("cell")).agg(F.count("*").alias("reads"))


def tally_types(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy(F.coalesce("sample", F.lit(UNKNOWN)).alias("sample"), "seqtype").agg(F.count("*").alias("reads"))


def assignment_summary(tally: DataFrame) -> DataFrame:
    """Reads by assignment with their share: unassigned, without wells, assigned."""
    kind = F.when(F.col("sample") == UNKNOWN, "unassigned").when(F.col("cell") == UNKNOWN, "no_wells").otherwise("assigned")
    by = tally.groupBy(kind.alias("assignment")).agg(F.sum("reads").alias("reads"))
    return by.withColumn("share", F.col("reads") / F.sum("reads").over(Window.partitionBy()))


def assignment_by_sample(positions: DataFrame) -> DataFrame:
    """Reads and cells of each sample by assignment and by whether both wells are on a plate: ``sample, assignment, valid, reads, cells``."""
    kind = F.when((F.col("sample") == UNKNOWN) | (F.col("cell") == UNKNOWN), "unassigned").otherwise("assigned")
    valid = (F.col("well1") != -1) & (F.col("well2") != -1)
    return positions.groupBy("sample", kind.alias("assignment"), valid.alias("valid")).agg(F.sum("reads").alias("reads"), F.count("*").alias("cells"))


def plate_map(positions: DataFrame, *, least: int = 2500) -> DataFrame:
    """For each pair of wells of placed cells: reads, those of the best cell and its share, cells of ``least`` reads or more."""
    placed = positions.where(F.col("well1").between(1, 998) & F.col("well2").between(1, 998))
    by = placed.groupBy("well1", "well2").agg(F.sum("reads").alias("reads"), F.max("reads").alias("best_cell"), F.count_if(F.col("reads") >= least).alias("covered"))
    return by.withColumn("best_share", 100 * (1 + F.col("best_cell")) / (1 + F.col("reads")))


def plate_positions(tally: DataFrame, layout: DataFrame) -> DataFrame:
    """Cells with their plate position on both splits and well numbers: 999 without barcode, -1 if not on a plate."""
    out = tally.withColumn("_bc1", F.split_part("cell", F.lit(":"), F.lit(1))).withColumn("_bc2", F.split_part("cell", F.lit(":"), F.lit(2)))
    for split in (1, 2):
        side = layout.where(F.col("split") == split).select(
            F.col("barcode").alias(f"_bc{split}"), F.col("plate_index").alias(f"_p{split}"),
            F.col("plate_row").alias(f"row{split}"), F.col("plate_col").alias(f"col{split}"),
        )
        out = out.join(side, f"_bc{split}", "left")
        well = well_number(F.col(f"_p{split}"), F.col(f"row{split}"), F.col(f"col{split}"))
        out = out.withColumn(f"well{split}", F.when(F.col("cell") == UNKNOWN, 999).otherwise(F.coalesce(well, F.lit(-1))).cast("int"))
    return out.drop("_bc1", "_bc2", "_p1", "_p2")


def plate_heatmap(positions: DataFrame, split: int) -> DataFrame:
    """Reads by plate row and column of a split with their share of the plate, long form."""
    by = positions.where(F.col(f"well{split}").between(1, 998)).groupBy(F.col(f"row{split}").alias("plate_row"), F.col(f"col{split}").alias("plate_col"))
    out = by.agg(F.sum("reads").alias("reads"), F.max("reads").alias("best_cell"))
    return out.withColumn("share", F.col("reads") / F.sum("reads").over(Window.partitionBy()))


def threshold_curve(cells: DataFrame, *, lowest: int = 250, highest: int = 2000, step: int = 50, strict: bool = False, count: str = "reads") -> DataFrame:
    """Cells at or above each threshold, by sample: one row for each threshold and sample.

    A cell adds to every threshold up to its own count, so counts are bucketed
    once and summed from above; nothing is crossed with the cells.
    """
    steps = (highest - lowest) // step
    level = F.floor((F.col(count) - (1 if strict else 0) - lowest) / step)
    level = F.when(level > steps, steps).otherwise(level)
    by = cells.where(level >= 0).groupBy("sample", level.cast("int").alias("k")).agg(F.count("*").alias("n"))
    grid = cells.select("sample").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    down = Window.partitionBy("sample").orderBy(F.desc("k"))
    out = grid.join(by, ["sample", "k"], "left").withColumn("cells", F.sum(F.coalesce("n", F.lit(0))).over(down))
    return out.select("sample", (F.col("k") * step + lowest).cast("int").alias("threshold"), F.col("cells").cast("long").alias("cells"))


def depth_threshold(tally: DataFrame, *, per: float = 2500.0, depth: float = 60e6) -> DataFrame:
    """The threshold that the number of reads calls for: ``total, threshold``."""
    return tally.agg(F.sum("reads").alias("total")).withColumn("threshold", F.floor(0.5 + F.col("total") * per / depth).cast("long"))


def closest_threshold(curve: DataFrame, threshold: DataFrame) -> DataFrame:
    """The point of each sample's curve that is nearest to the threshold, the lower of two; ``threshold`` has one row."""
    near = F.struct(F.abs(F.col("threshold") - F.col("_t")), F.col("threshold"))
    x = curve.crossJoin(F.broadcast(threshold.select(F.col("threshold").alias("_t"))))
    return x.groupBy("sample").agg(F.min_by("threshold", near).alias("threshold"), F.min_by("cells", near).alias("cells"))


def covered_by_threshold(tally: DataFrame, threshold: DataFrame, *, least: int = 10) -> DataFrame:
    """Well covered and under-covered cells by sample; ``threshold`` has one row."""
    cells = tally.where(F.col("cell") != UNKNOWN).crossJoin(F.broadcast(threshold))
    return cells.groupBy("sample").agg(
        F.count_if(F.col("reads") >= F.col("threshold")).alias("well_covered"),
        F.count_if((F.col("reads") >= least) & (F.col("reads") < F.col("threshold"))).alias("under_covered"),
    )


def cells_per_sample(decoded: DataFrame) -> DataFrame:
    """Distinct cells and umis by sample over fully decoded reads."""
    whole = decoded.dropna(subset=["sample", "bc1", "bc2", "umi"])
    per_cell = whole.groupBy("sample", "bc1", "bc2").agg(F.count("*").alias("reads"), F.count_distinct("umi").alias("umis"))
    return per_cell.groupBy("sample").agg(F.count("*").alias("cells"), F.sum("reads").alias("reads"), F.sum("umis").alias("umis"))


def block_groups(cells: DataFrame, *, per_group: int = 25_000, groups: int | None = None) -> DataFrame:
    """Cells of a barcode grid dealt in order into groups of equal size: ``group`` from 0."""
    total = cells.agg(F.count("*").alias("_n"))
    n_groups = F.lit(groups) if groups else (1 + F.floor(F.col("_n") / per_group))
    out = ranked(cells, cells.columns, "_i").crossJoin(F.broadcast(total))  # one row
    return out.withColumn("group", F.floor(F.col("_i") / F.ceil(F.col("_n") / n_groups)).cast("int")).drop("_i", "_n")


def barcode_grid(samples: DataFrame, wells: DataFrame) -> DataFrame:
    """All samples x wells x wells; the size follows the whitelists alone."""
    return samples.select(F.col("name").alias("sample")).crossJoin(wells.select(F.col("name").alias("bc1"))).crossJoin(wells.select(F.col("name").alias("bc2")))


def reference_sequences(samples: DataFrame, wells: DataFrame, linker1: str = "", linker2: str = "", prefix: str = "") -> DataFrame:
    """Every ``well1:well2:sample`` and the sequence that it makes."""
    s = samples.select(F.col("name").alias("s"), F.col("seq").alias("s_seq"))
    a = wells.select(F.col("name").alias("a"), F.col("seq").alias("a_seq"))
    b = wells.select(F.col("name").alias("b"), F.col("seq").alias("b_seq"))
    seq = F.concat(F.lit(prefix), "a_seq", F.lit(linker1), "b_seq", F.lit(linker2), "s_seq")
    return a.crossJoin(b).crossJoin(s).select(F.concat_ws(":", "a", "b", "s").alias("name"), seq.alias("seq"))


def best_offset(seq: Column, template: str, offsets: int = 3) -> Column:
    """The window among the first offsets that is nearest to the template: ``struct(d, offset)``."""
    from ..functions.columns import mismatches

    tries = [F.struct(mismatches(F.substring(seq, i + 1, len(template)), F.lit(template)).alias("d"), F.lit(i).alias("offset")) for i in range(offsets)]
    return F.array_min(F.filter(F.array(*tries), lambda x: x["d"].isNotNull()))


def position_weights(windows: DataFrame, seq: str) -> DataFrame:
    """Base shares and information content by position; N counts a quarter for each base."""
    one = windows.select(F.posexplode(F.split(seq, "")).alias("pos", "base")).where("base <> ''")
    share = {b: F.sum(F.when(F.col("base") == b, 1.0).when(F.col("base") == "N", 0.25).otherwise(0.0)) / F.count("*") for b in "ACGT"}
    out = one.groupBy("pos").agg(*[x.alias(b) for b, x in share.items()])
    bits = sum((F.when(F.col(b) > 0, F.col(b) * F.log2(b)).otherwise(0.0) for b in "ACGT"), F.lit(2.0))
    return out.withColumn("information", bits)
