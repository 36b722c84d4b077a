"""Read-level operators: names and tags, mapping predicates, trimming, pairing, merging."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from ..functions.columns import UNKNOWN, any_of, strip_suffixes
from ..functions.sequences import byte_matrix, edits
from .counting import ranked


def decode_name(name: Column, *, library: Column | None = None, antibody: Column | None = None) -> dict[str, Column]:
    """Tags of an annotated read name ``read|umi:bc1:bc2:sample:type|raw umi:…``.

    ``MI`` is unset for an unknown umi; ``CB`` joins library, antibody, sample
    and wells, leaving missing ones out, and is ``*`` for an undecoded read.
    """
    parts = F.split(name, r"[|]")
    parsed, raw = F.split(F.get(parts, F.lit(1)), ":"), F.split(F.get(parts, F.lit(2)), ":")
    field = lambda a, i: F.get(a, F.lit(i))
    known = any_of([field(parsed, i) == UNKNOWN for i in (1, 2, 3)])
    lead = [F.when(c != "", c) for c in (library, antibody) if c is not None]
    return {
        "read_id": field(parts, 0),
        "MI": F.when(field(parsed, 0) != UNKNOWN, field(parsed, 0)),
        "BC": field(raw, 3),
        "CR": F.concat_ws(":", field(raw, 1), field(raw, 2)),
        "CB": F.when(F.coalesce(known, F.lit(True)), UNKNOWN).otherwise(F.concat_ws(":", *lead, field(parsed, 3), field(parsed, 1), field(parsed, 2))),
        "seqtype": field(parsed, 4),
    }


def decode_well_name(reads: DataFrame, digest: DataFrame, name: str = "name") -> DataFrame:
    """Names ending in ``:bc2:bc1:well:umi``, with the digest's columns by zero-padded ``well``."""
    last = F.slice(F.split(name, ":"), -4, 4)
    out = reads.withColumns({
        "bc2": F.get(last, F.lit(0)), "bc1": F.get(last, F.lit(1)), "well": F.lpad(F.get(last, F.lit(2)), 2, "0"), "umi": F.get(last, F.lit(3)),
    })
    return out.join(digest, "well", "left")


def read_groups(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Read groups: the distinct keys in order, named ``key__key__i``."""
    groups = reads.select(*keys).distinct()
    i = F.row_number().over(Window.orderBy(*keys)) - 1
    return groups.withColumn("read_group", F.concat_ws("__", *keys, i.cast("string")))


def tag_fallback(tag: Column, name: Column, i: int) -> Column:
    """The tag, or else the i-th field of the name's parsed part."""
    return F.coalesce(tag, F.get(F.split(F.get(F.split(name, r"[|]"), F.lit(1)), ":"), F.lit(i)))


def file_fields(path: Column) -> dict[str, Column]:
    """``sequence_id, assay, antibody, sample, part`` out of ``seq__assay__antibody__sample__n``."""
    parts = F.split(strip_suffixes(path), "__")
    return {c: F.get(parts, F.lit(i)) for i, c in enumerate(("sequence_id", "assay", "antibody", "sample", "part"))}


def standard_contig(contig: Column, *, autosomes: int = 22, others: tuple[str, ...] = ("X",)) -> Column:
    names = [f"chr{i}" for i in range(1, autosomes + 1)] + [f"chr{x}" for x in others]
    return contig.isin(names)


def usable_alignment(*, min_mapq: int = 30, min_length: int = 20, max_template: int | None = None) -> Column:
    """Mapped, good enough, long enough, primary; optionally paired with a template in (0, max)."""
    ok = F.col("is_mapped") & (F.col("mapq") >= min_mapq) & (F.col("end_pos") - F.col("pos") >= min_length)
    if max_template is not None:
        ok = ok & F.col("is_paired") & (F.col("tlen") > 0) & (F.col("tlen") < max_template)
    return ok


def good_pair(mapped: Column, mapq: Column, mate_mapped: Column | None = None, mate_mapq: Column | None = None, same_contig: Column | None = None, least: int = 30) -> Column:
    """Either mate mapped well, and on one contig if both are; single end: the read itself."""
    one = mapped & (mapq >= least)
    if mate_mapped is None:
        return one
    two = mate_mapped & (mate_mapq >= least)
    return (one | two) & F.when(one & two, same_contig).otherwise(True)


def mapping_quality(*ends: tuple[Column, Column]) -> Column:
    """Sum over the ends of the quality, -10 for an unmapped end."""
    total = F.lit(0)
    for mapped, mapq in ends:
        total = total + F.when(mapped, mapq).otherwise(-10)
    return total


def compare_mapping(a: Column, b: Column) -> Column:
    return F.when(a > b, "first").when(a < b, "second").otherwise("equal")


def clip(df: DataFrame, n: int, seq: str = "seq", qual: str = "qual") -> DataFrame:
    return df.withColumns({c: F.substring(c, 1, n) for c in (seq, qual)})


def repair(df: DataFrame, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Empty sequences become N, short qualities are padded with ``!``, long ones cut."""
    s = F.when(F.coalesce(F.length(seq), F.lit(0)) == 0, "N").otherwise(F.col(seq))
    return df.withColumn(seq, s).withColumn(qual, F.rpad(F.coalesce(qual, F.lit("")), F.length(seq), F.lit("!")))


def _quality_ends(quals: list[str], cutoff: int) -> np.ndarray:
    """Where each read ends once its tail of low quality is cut: the lowest running sum from the end, before it rises above 0."""
    if not quals:
        return np.zeros(0, np.int64)
    back, size = byte_matrix([x[::-1] for x in quals])
    inside = np.arange(back.shape[1]) < size[:, None]
    total = np.cumsum(np.where(inside, back.astype(np.int64) - 33 - cutoff, 0), axis=1)
    alive = inside & ~np.logical_or.accumulate(total > 0, axis=1)
    total = np.where(alive, total, 1)
    last = total.shape[1] - 1 - total[:, ::-1].argmin(1)  # of equal sums the one that cuts more
    return np.where(total.min(1) <= 0, size - 1 - last, size)


def _adapter_starts(seqs: list[str], adapters: list[str], min_overlap: int, error: float) -> np.ndarray:
    """Where the first adapter begins in each read, else the read's length.

    Reads and adapters are matched backwards, so a match's end is where the
    adapter begins. Of the places with at most ``error`` edits a base the leftmost is
    taken, or a better one within as many bases of it as edits are allowed: a
    match can be stretched to the left by that much. At the read's end the
    adapter's beginning alone, ``min_overlap`` bases or more, can stand.
    """
    if not seqs:
        return np.zeros(0, np.int64)
    data, size = byte_matrix([x[::-1] for x in seqs])
    best = size.copy()
    for adapter in adapters:
        for p in range(min_overlap, len(adapter) + 1):
            most = int(error * p)
            whole = p == len(adapter)
            cost = edits(data, size, adapter[:p][::-1], anchored=not whole, columns=None if whole else p + most)
            places = np.arange(cost.shape[1])
            fits = (cost <= most) & (places <= size[:, None])
            last = np.where(fits, places, -1).max(1)  # the leftmost place in the read
            near = fits & (places >= last[:, None] - most) & (places <= last[:, None])
            least = np.where(near, cost, 10_000).min(1)
            at = np.where(near & (cost == least[:, None]), places, -1).max(1)
            best = np.where(last >= 0, np.minimum(best, size - at), best)
    return best


def trim_reads(df: DataFrame, adapters: list[str], *, five: tuple[str, ...] = (), quality: int = 20, min_length: int = 20, min_overlap: int = 5, error: float = 0.1, passes: int = 2, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Cut low-quality ends and adapters, then drop reads that got too short.

    A read's end is cut where the running sum of (quality - cutoff) from the
    end is lowest. A 3' adapter is cut from its leftmost place with at most
    ``error`` edits a base (substitutions, insertions, deletions), also when only its beginning
    (``min_overlap`` bases or more) stands at the read's end; 5' adapters are cut with what is before them.
    """

    @pandas_udf("struct<s string, q string>")
    def cut(s: pd.Series, q: pd.Series) -> pd.DataFrame:
        s, q = s.fillna("").tolist(), q.fillna("").tolist()
        ends = _quality_ends([b[: len(a)] for a, b in zip(s, q, strict=True)], quality)
        ends = [e if b else len(a) for e, a, b in zip(ends, s, q, strict=True)]
        s, q = [a[:e] for a, e in zip(s, ends, strict=True)], [b[:e] for b, e in zip(q, ends, strict=True)]
        for _ in range(passes):
            for adapter in five:
                at = [x.find(adapter) for x in s]
                first = [i + len(adapter) if i >= 0 else 0 for i in at]
                s, q = [a[i:] for a, i in zip(s, first, strict=True)], [b[i:] for b, i in zip(q, first, strict=True)]
            ends = _adapter_starts(s, adapters, min_overlap, error)
            s, q = [a[:e] for a, e in zip(s, ends, strict=True)], [b[:e] for b, e in zip(q, ends, strict=True)]
        return pd.DataFrame({"s": s, "q": q})

    out = df.withColumn("_cut", cut(seq, qual)).withColumn(seq, F.col("_cut.s")).withColumn(qual, F.col("_cut.q"))
    return out.drop("_cut").where(F.length(seq) >= min_length)


def looks_paired(df: DataFrame, *, first: int = 100, top: int = 10, least: float = 120.0, ordinal: str = "ordinal", length: str = "query_len") -> DataFrame:
    """One row: the mean length of the longest ``top`` of the first reads, and whether that means pairs."""
    longest = df.where(F.col(ordinal) < first).orderBy(F.desc(length), ordinal).limit(top)
    return longest.agg(F.avg(length).alias("mean_length")).withColumn("paired", F.col("mean_length") >= least)


def join_by_place(a: DataFrame, b: DataFrame, *, keys: tuple[str, ...] = ("pair_id", "ordinal"), name: str = "name") -> DataFrame:
    """Two scans of the same reads, record by record; a name that differs fails the job."""
    b = b.withColumnRenamed(name, "_name")
    same = F.assert_true(F.col(name).eqNullSafe(F.col("_name")), F.lit("the two files hold different reads"))
    return a.join(b, list(keys)).where(F.coalesce(same.cast("boolean"), F.lit(True))).drop("_name")


def number_reads(df: DataFrame, order: list[str], into: str = "XX", within: list[str] | None = None) -> DataFrame:
    """Zero-padded numbers from 0 in the given order, within each group."""
    return ranked(df, order, "_n", within).withColumn(into, F.lpad(F.col("_n").cast("string"), 9, "0")).drop("_n")


def merge_tags(a: DataFrame, b: DataFrame, *, key: str = "read_id", rename: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Tags of two annotations of the same reads, those of ``b`` renamed first."""
    for old, new in (rename or {}).items():
        b = b.withColumnRenamed(old, new)
    return a.join(b, key, "full").drop(*drop)


def keep_sampled(df: DataFrame, n: int, *, ordinal: str = "ordinal", within: str = "path") -> DataFrame:
    """The first ``n`` records of each file, by their number."""
    return df.where(F.col(ordinal) < n)


def contig_order(df: DataFrame, contigs: DataFrame, *, start: str = "pos", end: str = "end_pos") -> DataFrame:
    """Coordinate order: contigs by their rank in the reference, then start, then length."""
    ranked = df.join(contigs.select("contig", F.col("rank").alias("_rank")), "contig")
    return ranked.orderBy("_rank", start, F.col(end) - F.col(start)).drop("_rank")
