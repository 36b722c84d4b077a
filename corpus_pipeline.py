"""A training corpus from ``documents``, in five stages.

Each stage takes the rows that the one before kept, written as Parquet and read
again, so a lost executor costs no more than the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.llm import decontaminate as leaks
from strandlake.llm import toxicity as toxic
from strandlake.llm.common import stored, table
from strandlake.llm.lines import drop_repeated_lines
from strandlake.llm.mixing import mixed_documents
from strandlake.llm.ngram_join import keep_one

# Ids may be null or repeated: every stage judges rows by what they hold, and extra columns pass through whatever their names.


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier rejects go."""
    return toxic.reject_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are alike one stays; documents that lose all their lines go, and so do rows that repeat another's id and text."""
    return drop_repeated_lines(docs)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; of copies that share it, the same one on every run."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a test item go."""
    return leaks.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix draws, with their shard and place in it; what is drawn again comes again.

    Rows are placed by a hash of what they hold, so ties are equal rows, which
    stand next to each other; without rows or words nothing is drawn.
    """
    return mixed_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", jaccard),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: A trained classifier, MinHash and the seeded draw are beyond SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
