"""Column builders that the operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "*"


def cell_id(*parts: str) -> Column:
    """The cell of a read: its parts joined by colons, null parts left out."""
    return F.concat_ws(":", *(parts or ("library", "sample", "bc1", "bc2")))


def good_read(min_mapq: int = 30, *, mapped: str = "is_mapped", mapq: str = "mapq") -> Column:
    return F.col(mapped) & (F.col(mapq) >= min_mapq)


def safe_div(a: Column, b: Column, otherwise: float = 0.0) -> Column:
    """``a / b``, or ``otherwise`` where ``b`` is zero or null."""
    return F.when(F.coalesce(b, F.lit(0)) == 0, F.lit(float(otherwise))).otherwise(a / b)


def percentage(share: Column) -> Column:
    """A share as per cent with one decimal, half to even."""
    return F.bround(share * 1000, 0) / 10


def number_of(seq: Column, letter: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def mismatches(a: Column, b: Column) -> Column:
    """Hamming distance of two strings of equal length; null if the lengths differ."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 0).otherwise(1))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def uniform(key: Column) -> Column:
    """A number in [0, 1) fixed by the key: 28 bits of its md5."""
    return F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("long") / F.lit(float(1 << 28))


def well_number(plate: Column, row: Column, col: Column) -> Column:
    """Wells of 8 x 12 plates, from 1 on."""
    return (plate - 1) * 96 + (row - 1) * 12 + (col - 1) + 1


def strip_suffixes(name: Column) -> Column:
    """A FASTQ file's base name: without folder, endings and mate number."""
    name = F.regexp_replace(name, r"^.*/", "")
    for ending in (r"\.gz$", r"\.(fastq|fq)$", r"(_R?[12])$"):
        name = F.regexp_replace(name, ending, "")
    return name


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)
