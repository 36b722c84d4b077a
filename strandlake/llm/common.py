"""What the operators of this package share: tables, shared storage, words."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shared import drop_stored, settled, stored  # noqa: F401  the operators take them from here

#: Every word is a maximal run of characters outside this class.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def bound_batches(spark: SparkSession, rows: int = 500) -> None:
    """Fewer rows than Spark's default in an Arrow batch: long texts would make it hundreds of MB."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    # a driver that found this package by sys.path alone tells its workers where it is
    found = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if (root := str(Path(__file__).parents[2])) not in found:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*found, root]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few(df: DataFrame, rows: int, per: int = 100_000) -> DataFrame:
    """``df`` of about ``rows`` rows in no more partitions than those call for."""
    return df.coalesce(max(1, -(-rows // per)))


#: Ids of 8 bytes that may be sent to every task; beyond that many the other side is shuffled instead.
MAX_IDS = 1_000_000


def row_key() -> Column:
    """The name of a document whatever its id: a hash of id and text; equal rows share it."""
    return F.xxhash64("doc_id", "text")


def sendable(ids: DataFrame) -> DataFrame:
    """``ids``, one long each, marked for broadcast if they are no more than :data:`MAX_IDS`."""
    return F.broadcast(ids) if ids.limit(MAX_IDS + 1).count() <= MAX_IDS else ids


def once(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with one row of those that share a ``key``, chosen by what it holds; only rows of repeated keys are shuffled whole."""
    repeated = stored(docs.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), "repeated")
    repeated = sendable(repeated)
    alone = docs.join(repeated, key, "left_anti")
    row = F.struct(*docs.columns)
    first = docs.join(repeated, key, "left_semi").groupBy(key).agg(F.min_by(row, F.struct(F.xxhash64(F.to_json(row)), F.sha2(F.to_json(row), 256))).alias("_first"))
    return alone.unionByName(first.select("_first.*"))


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def n_words(col: str | Column = "text") -> Column:
    """Number of words; null counts as empty."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")
