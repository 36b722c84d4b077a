"""Primary and spike-in genome: which one a barcode belongs to, and where its reads go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LADDER = (0, 50, 100, 200, 500)


def dual_mapping(primary: DataFrame, spike: DataFrame, *, key: str = "read_id") -> DataFrame:
    """Both alignments of each read with ``good`` flags: ``key, barcode, good_primary, good_spike``."""
    a = primary.select(key, "barcode", F.col("good").alias("good_primary"))
    return a.join(spike.select(key, F.col("good").alias("good_spike")), key)


def barcode_probability(both: DataFrame, *, prior: float = 0.05) -> DataFrame:
    """Reads that are good in exactly one genome, and the probability of the primary one, by barcode."""
    only = F.col("good_primary") & ~F.col("good_spike"), F.col("good_spike") & ~F.col("good_primary")
    t = both.groupBy("barcode").agg(F.count_if(only[0]).alias("primary"), F.count_if(only[1]).alias("spikein"))
    t = t.withColumn("p", F.col("primary") / (prior + F.col("primary") + F.col("spikein")))
    return t.withColumn("pct_primary", F.when(F.col("primary") + F.col("spikein") > 0, 100 * F.col("primary") / (F.col("primary") + F.col("spikein"))).otherwise(0.0))


def route(both: DataFrame, probability: DataFrame, *, high: float = 0.7, low: float = 0.3, duplicate_reads: bool = False) -> DataFrame:
    """One row for each read and genome that it goes to, ``ambig`` where its barcode leaves both open.

    Barcodes without evidence go to both, as do all reads with ``duplicate_reads``.
    """
    p = F.when(F.col("primary") + F.col("spikein") > 0, F.col("p"))
    known = both.join(probability.select("barcode", "p", "primary", "spikein"), "barcode", "left").withColumn("_p", p)
    two = F.array(F.lit("primary"), F.lit("spikein"))
    to = F.when(F.lit(duplicate_reads) | F.col("_p").isNull(), two).when(F.col("_p") >= high, F.array(F.lit("primary"))).when(F.col("_p") <= low, F.array(F.lit("spikein"))).otherwise(two)
    ambig = F.coalesce((F.col("_p") > low) & (F.col("_p") < high), F.lit(False))
    return known.withColumn("ambig", ambig).withColumn("destination", F.explode(to)).drop("_p", "p", "primary", "spikein")


def ladder(probability: DataFrame, *, thresholds=LADDER, high: float = 0.8, low: float = 0.2) -> DataFrame:
    """Barcodes and reads by class for each least number of reads."""
    rungs = F.explode(F.array(*[F.lit(t) for t in thresholds]))
    n = F.col("primary") + F.col("spikein")
    x = probability.withColumn("_n", n).withColumn("count_threshold", rungs).where(F.col("_n") >= F.col("count_threshold"))
    is_p, is_s = F.col("p") > high, F.col("p") < low
    return x.groupBy("count_threshold").agg(
        F.count("*").alias("barcodes"), F.sum("_n").alias("reads"),
        F.count_if(is_p).alias("primary_barcodes"), F.coalesce(F.sum(F.when(is_p, F.col("_n"))), F.lit(0)).alias("primary_reads"),
        F.count_if(is_s).alias("spikein_barcodes"), F.coalesce(F.sum(F.when(is_s, F.col("_n"))), F.lit(0)).alias("spikein_reads"),
        F.count_if(~is_p & ~is_s).alias("ambiguous_barcodes"),
    )
