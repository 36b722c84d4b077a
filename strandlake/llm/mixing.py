"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source is a stream: its documents in a fixed pseudo-random order, repeated up
to ``max_repeat`` times and cut to the source's target number of words. The
stream is cut into blocks of ``block_words`` words. The exact block quotas of
all sources stand at the root of a binary tree over the output shards; each
node splits its quotas between its halves by one multivariate-hypergeometric
draw, so every shard ends with an exact quota of each source and the quotas add
up. A shard then draws its disjoint run of the source's permuted blocks and
orders its draws by a hash within itself.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored, table, text_or_empty

#: The tree's root is sent to the tasks that walk it. At 24 bytes a source this
#: many take 24 MB; more raise an error and have to be grouped first.
MAX_SOURCES = 1_000_000
#: A draw of the tree is made from fewer than twice as many blocks; mixes of more have longer blocks.
MAX_BLOCKS = 500_000_000
ROWS_PER_BUCKET = 4_000


def source_targets(sizes: DataFrame, *, weights=(5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """Targets in words for each source of ``sizes(source, size)``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    the words of all. No target passes ``max_repeat`` times the source's own
    words; what is above goes to the others by weight until none is above.

    That end is a water level w: target = least(cap, w * weight). In the order
    of cap / weight, w is the first level that leaves the next source uncapped,
    which running sums over the sources (one row each) give at once.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    per = (
        per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int") + 1))
        .withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    per = (
        per.withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("caps", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("free", F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight"))
        .withColumn("level", (F.col("total") - F.col("caps")) / F.col("free"))
        .withColumn("order", F.row_number().over(Window.orderBy("ratio", F.col("source").asc_nulls_last())))
        .withColumn("water", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("order", "level"))).over(every)["level"])
    )
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def _split(seed: int, quotas: np.ndarray, shard: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Walk from the root to ``shard``: where its run starts in each source's blocks, and how many it has."""
    start = np.zeros_like(quotas)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        draw = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        nsample = int(quotas.sum()) * (mid - lo) // (hi - lo)
        left = draw.multivariate_hypergeometric(quotas, nsample, method="marginals") if len(quotas) > 1 else np.array([nsample])
        if shard < mid:
            quotas, hi = left, mid
        else:
            start, quotas, lo = start + left, quotas - left, mid
    return start, quotas


def shard_quotas(quotas: list[tuple[int, int]], shards: int, seed: int, spark) -> DataFrame:
    """``(shard, slot, start, n)``: each shard's run in the permuted blocks of the source in ``slot``.

    Each task walks the tree for its own shards; a node's draw depends only on
    the seed and the node, so all tasks agree without talking to each other.
    """
    slots, blocks = (np.array(x, dtype=np.int64) for x in zip(*quotas, strict=True))

    def walk(batches):
        for batch in batches:
            for shard in batch["id"]:
                start, n = _split(seed, blocks, int(shard), 0, shards)
                has = n > 0
                yield pd.DataFrame({"shard": int(shard), "slot": slots[has], "start": start[has], "n": n[has]})

    return spark.range(shards, numPartitions=max(1, min(shards, 200))).mapInPandas(walk, "shard long, slot long, start long, n long")


def _permuted(places: DataFrame, seed: int) -> DataFrame:
    """``slot, pos, blocks`` to the ``block`` at that place of the permutation of the source's blocks, other columns kept.

    The places fill a table row by row, about as wide as high; each row is
    turned by a hash of its own and the table read column by column, three
    times over. Every step is a bijection, also of a table whose last row is
    short. Steps are columns of their own, or each would repeat those before it.
    """
    width, own = F.col("_width"), places.columns
    x = places.withColumn("_width", F.ceil(F.sqrt(F.col("blocks").cast("double"))).cast("long"))
    x = x.withColumn("_full", F.floor(F.col("blocks") / width)).withColumn("_rest", F.col("blocks") % width).withColumnRenamed("pos", "_pos")
    for turn in range(3):
        x = x.withColumn("_row", F.floor(F.col("_pos") / width))
        x = x.withColumn("_size", F.when(F.col("_row") < F.col("_full"), width).otherwise(F.col("_rest")))
        x = x.withColumn("_col", F.pmod(F.col("_pos") % width + F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), "slot", "_row"), F.col("_size")), F.col("_size")))
        x = x.withColumn("_pos", F.col("_col") * F.col("_full") + F.least("_col", "_rest") + F.col("_row"))
    return x.select(*[c for c in own if c not in ("pos", "blocks")], F.col("_pos").alias("block"))


def mix_sources(
    docs: DataFrame, *, weights=(5, 2, 1), max_repeat: int = 3, block_words: int = 1024,
    shard_words: int = 1 << 20, seed: int = 8,
    row_id: str | None = None, max_blocks: int = MAX_BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """Draw the mix. Returns ``(sized, draws)``.

    ``sized``: row_id and all columns of the plan for each row of ``docs``:
    ``(row_id, doc_id, source, size, source_size, target)``; ``row_id`` names a
    column of unique numbers, if there is one. ``draws``:
    ``(row_id, shard, place, word_from, word_to)``; a shard takes those words
    of the row, in the order of ``place``.

    Null text is empty (size 0, never drawn); a null source is a source of its
    own; the order of a source follows ids and texts alone, so reruns agree;
    equal rows stand next to each other and are drawn apart; an empty table gives empty results. Where
    ``max_blocks`` blocks are not enough, several consecutive ones are drawn as one. The
    running word offsets are made in two steps (buckets of a source by hash,
    then rows within a bucket), so a source with a third of all rows is spread
    over as many tasks as its rows need.
    """
    spark = docs.sparkSession
    sized = stored(
        docs.select(
            (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"),
            F.col("doc_id"),
            F.col("source"),
            n_words("text").alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"),
        ),
        "sizes",
    )
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    plan = source_targets(sized, weights=weights, max_repeat=max_repeat)
    plan = plan.withColumn("key", key).withColumn(
        "quota", F.least(F.round("target").cast("long"), F.col("source_size") * max_repeat)
    )
    words = plan.agg(F.sum("quota")).first()[0] or 0
    block_words *= max(1, math.ceil(words / block_words / max_blocks))
    plan = plan.withColumn("blocks", F.ceil(F.col("quota") / block_words).cast("long"))
    plan = stored(plan.withColumn("slot", F.row_number().over(Window.orderBy("key")).cast("long") - 1), "plan")
    quotas = [tuple(r) for r in plan.where("blocks > 0").select("slot", "blocks").orderBy("slot").limit(MAX_SOURCES + 1).collect()]
    if len(quotas) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources have words: group them first")
    shards = max(1, math.ceil(words / shard_words))
    n_rows = sized.count()
    buckets = max(1, math.ceil(n_rows / ROWS_PER_BUCKET))

    joined = sized.withColumn("key", key).join(plan.drop("source"), "key")
    sized_out = joined.select("row_id", "doc_id", "source", "size", "source_size", "target")
    live = joined.where("size > 0 AND quota > 0")
    live = live.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    before = Window.partitionBy("slot").orderBy("bucket")
    starts = live.groupBy("slot", "bucket").agg(F.sum("size").alias("in_bucket"))
    starts = starts.withColumn("offset", F.sum("in_bucket").over(before) - F.col("in_bucket")).drop("in_bucket")
    within = Window.partitionBy("slot", "bucket").orderBy("h", "row_id")
    live = live.withColumn("at", F.sum("size").over(within) - F.col("size")).join(starts, ["slot", "bucket"])
    live = live.withColumn("at", F.col("at") + F.col("offset"))
    # the passes that reach the document, and of each the words below the quota
    passes = live.select(
        "row_id", "slot", "size", "quota", "source_size", "at",
        F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(max_repeat - 1).cast("long"), F.floor((F.col("quota") - 1) / F.col("source_size"))))).alias("turn"),
    )
    passes = passes.withColumn("lo", F.col("turn") * F.col("source_size") + F.col("at"))
    passes = passes.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("quota"))).where("lo < hi")
    pieces = passes.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words)))
    )
    first = F.greatest("lo", F.col("block") * block_words)
    last = F.least("hi", (F.col("block") + 1) * block_words)
    pieces = pieces.select(
        "row_id", "slot", "block", "turn", (first - F.col("lo")).alias("word_from"), (last - F.col("lo")).alias("word_to")
    )
    if not quotas:
        none = F.lit(None).cast("long")
        return sized_out, pieces.select("row_id", none.alias("shard"), none.alias("place"), "word_from", "word_to").limit(0)
    runs = shard_quotas(quotas, shards, seed, spark)
    runs = runs.join(plan.select("slot", "blocks"), "slot")
    drawn = _permuted(runs.select("shard", "slot", "blocks", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos")), seed)
    # stored, as a filter on the block that the join below pushes down would repeat the permutation's steps in each other
    drawn = stored(drawn, "drawn")
    draws = pieces.join(drawn, ["slot", "block"])
    place = F.xxhash64(F.lit(seed), "shard", "slot", "block", "turn", "row_id", "word_from")
    return sized_out, draws.select("row_id", "shard", place.alias("place"), "word_from", "word_to")


def _by_row(draws: DataFrame) -> DataFrame:
    shards = F.array_sort(F.collect_set("shard")).alias("shards")  # of one document: no more than its blocks and repeats
    return draws.groupBy("row_id").agg(F.sum(F.col("word_to") - F.col("word_from")).cast("long").alias("taken"), F.count("*").alias("n_draws"), shards)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs``: what the mix takes of it, repeats counted, and the shards that take it."""
    sized, draws = mix_sources(docs, **options)
    return sized.join(_by_row(draws), "row_id", "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        F.coalesce("n_draws", F.lit(0).cast("long")).alias("n_draws"),
        F.coalesce("shards", F.array().cast("array<long>")).alias("shards"),
    )


MIXED = ("shard", "place", "word_from", "word_to", "size", "source_size", "target")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each draw, its words in ``text``, repeats as rows of their own.

    The columns of ``docs`` (``n_chars`` follows the text) and
    ``shard, place, word_from, word_to, size, source_size, target``; columns of
    ``docs`` by these names give way. A shard is its rows in the order of
    ``place``. Rows may lack an id or share one; null and empty texts are never
    drawn; an empty table gives an empty table.
    """
    own = [c for c in docs.columns if c not in MIXED]
    keyed = stored(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*own).alias("_doc")), "numbered")
    sized, draws = mix_sources(keyed.select("_row", "_doc.doc_id", "_doc.source", "_doc.text"), row_id="_row", **options)
    # the draws of one document, no more than its blocks and repeats, so its words are told apart once
    draw = F.struct("shard", "place", "word_from", "word_to")
    of_row = draws.groupBy(F.col("row_id").alias("_row")).agg(F.collect_list(draw).alias("_draws"))
    figures = sized.select(F.col("row_id").alias("_row"), "size", "source_size", "target")
    words = F.regexp_extract_all(text_or_empty("_doc.text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    out = keyed.join(of_row.join(figures, "_row"), "_row").withColumn("_words", words)
    cut = lambda d: F.array_join(F.slice("_words", (d["word_from"] + 1).cast("int"), (d["word_to"] - d["word_from"]).cast("int")), " ")
    out = out.withColumn("_cut", F.transform("_draws", lambda d: F.struct(d["shard"], d["place"], d["word_from"], d["word_to"], cut(d).alias("text"))))
    out = out.select("_doc", "size", "source_size", "target", F.inline("_cut"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col("_doc")[c].alias(c) for c in own], *MIXED)


def write_mix(docs: DataFrame, path: str, **options) -> None:
    """Write the drawn words, one folder for each shard, in each shard's own order."""
    mixed = mixed_documents(docs, **options)
    mixed.repartition("shard").sortWithinPartitions("shard", "place").write.partitionBy("shard").parquet(path)


def op8_mix(spark, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))
